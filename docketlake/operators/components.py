"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketlake.session import ship, written


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over one batch of links: a link from every node to the smallest node it reaches within the batch."""
    for batch in batches:
        parent: dict[int, int] = {}

        def find(x: int, parent: dict[int, int] = parent) -> int:
            root = x
            while parent.setdefault(root, root) != root:
                root = parent[root]
            while parent[x] != root:
                parent[x], x = root, parent[x]
            return root

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        links = [(x, find(x)) for x in list(parent)]
        links = [x for x in links if x[0] != x[1]]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], ["u", "v"])


def _size(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node in ``links`` (two long columns); component is the smallest node that it reaches.

    Each round is two aggregations and joins, and its links go to a table in the shared folder, so a lost executor costs no earlier round
    and nothing but a count and a checksum comes to the driver. Null ends and links to oneself are dropped. No links, no rows.
    """
    ship(links.sparkSession)
    a, b = links.columns[:2]
    given = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    now = written(given.mapInArrow(_forest, "u long, v long").distinct(), "links")
    size = _size(now)
    for _ in range(max_rounds):
        if not size[0]:
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, size, now = size, _size(after), after
        if size == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
