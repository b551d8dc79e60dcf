"""Hard-negative mining with exact integer scores by the method of the Four Russians.

Vectors are whole numbers. Eight dimensions of an anchor have 256 subset sums; they stand in a table. A candidate's numbers are held as bit planes
in two's complement, eight dimensions a byte, so a byte of a plane is an index into the table of its eight dimensions. A plane's lookups add up to the anchor's
product with that bit of all dimensions; from the sign plane down, shifting and adding the planes gives the full inner product, without error.

Anchors and candidates are dealt into blocks of bounded size, by a hash of the id, and every cell of the grid of blocks is scored in a task of its own.
A cell returns what it knows best: the first positives of each anchor, then, with all positives known, the first negatives of each positive. Each cell's
few are ranked against those of the other cells by Spark. A hot label or vector is spread over all blocks like any other.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketlake.session import ship, written

#: Anchors whose tables are held at once: 256 sums of each for every eight dimensions.
TABLES = 64


@dataclass(frozen=True)
class Settings:
    """Positives an anchor; negatives a positive; bounds of a negative's score in percent of the positive's; what components are multiplied by before they
    are rounded down; anchors and candidates a block."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    scale: int = 256
    anchors: int = 1024
    candidates: int = 2048


def subset_sums(anchors: np.ndarray, dtype=np.int64) -> np.ndarray:
    """(group of eight dimensions, byte, anchor): the sum of the anchor's components whose bits the byte has. Dimensions must be a multiple of eight."""
    n, d = anchors.shape
    parts = anchors.astype(dtype).reshape(n, d // 8, 8)
    sums = np.zeros((d // 8, 256, n), dtype=dtype)
    for bit in range(8):
        sums[:, 1 << bit : 2 << bit] = sums[:, : 1 << bit] + parts[:, :, bit].T[:, None, :]
    return sums


def bit_planes(vectors: np.ndarray) -> np.ndarray:
    """(plane, group of eight dimensions, row): bytes of the bit planes in two's complement, the sign plane last."""
    most = max(int(vectors.max(initial=0)), -1 - int(vectors.min(initial=0)))
    return np.stack([np.packbits((vectors >> p & 1).astype(np.uint8), axis=1, bitorder="little").T for p in range(most.bit_length() + 1)])


def scores(sums: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(row, anchor): inner products by lookups, from the sign plane down. Whole numbers wrap around, so what fits the type at the end is right."""
    n, a = planes.shape[2], sums.shape[2]
    total, found = np.zeros((n, a), dtype=sums.dtype), np.empty((n, a), dtype=sums.dtype)
    for k, plane in enumerate(planes[::-1]):
        total <<= 1
        for group, at in zip(sums, plane.astype(np.intp), strict=True):
            np.take(group, at, axis=0, out=found, mode="clip")
            total = np.subtract(total, found, out=total) if k == 0 else np.add(total, found, out=total)
    return total


def _matrix(lists: pa.ChunkedArray, d: int) -> np.ndarray:
    """A row a list, padded with zeros to d columns."""
    lists = lists.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), d), dtype=np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = lists.flatten().to_numpy()
    return out


def _longest(*tables: pa.Table) -> int:
    return -(-max((int(np.diff(t["x"].combine_chunks().offsets.to_numpy()).max(initial=0)) for t in tables), default=0) // 8) * 8


def _scored(anchors: pa.Table, candidates: pa.Table):
    """Candidates by id, and for every anchor its place and the scores of all of them."""
    candidates = candidates.sort_by("vec_id")
    d = _longest(anchors, candidates)
    a, c = _matrix(anchors["x"], d), _matrix(candidates["x"], d)
    planes = bit_planes(c)
    small = d * (int(np.abs(a).max(initial=0)) + 1) << len(planes) < 1 << 31
    for at in range(0, len(a), TABLES):
        found = scores(subset_sums(a[at : at + TABLES], np.int32 if small else np.int64), planes).T
        for k, row in enumerate(np.ascontiguousarray(found)):
            yield at + k, row.astype(np.int64)


def _positives(s: Settings):
    """The first rows of each anchor's label in a cell."""

    def run(key, anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        got = []
        if anchors.num_rows and candidates.num_rows:
            candidates = candidates.sort_by("vec_id")
            ids, labels = (candidates[c].to_numpy() for c in ("vec_id", "label"))
            own, own_label = (anchors[c].to_numpy() for c in ("vec_id", "label"))
            for k, row in _scored(anchors, candidates):
                like = np.flatnonzero((labels == own_label[k]) & (ids != own[k]))
                like = like[np.argsort(-row[like], kind="stable")[: s.positives]]
                got.append((np.full(len(like), own[k]), ids[like], row[like]))
        columns = [np.concatenate(c) if got else np.empty(0, np.int64) for c in (zip(*got, strict=True) if got else ((), (), ()))]
        return pa.table(dict(zip(("anchor_id", "positive_id", "score"), columns, strict=True)))

    return run


def _negatives(s: Settings):
    """The first rows of other labels in a cell, for each anchor and positive, whose scores are in the positive's bounds."""

    def run(key, anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        got = []
        if anchors.num_rows and candidates.num_rows:
            candidates = candidates.sort_by("vec_id")
            ids, labels = (candidates[c].to_numpy() for c in ("vec_id", "label"))
            own, own_label, positives = anchors["vec_id"].to_numpy(), anchors["label"].to_numpy(), anchors["positives"].to_pylist()
            for k, row in _scored(anchors, candidates):
                bounds = [(p["positive_id"], p["score"], -(-s.low * p["score"] // 100), s.high * p["score"] // 100) for p in positives[k]]
                other = np.flatnonzero((labels != own_label[k]) & (row >= min(b[2] for b in bounds)) & (row <= max(b[3] for b in bounds)))
                other = other[np.argsort(-row[other], kind="stable")]
                falling = -row[other]
                for positive, score, low, high in bounds:
                    first = np.searchsorted(falling, -high)
                    take = other[first : min(first + s.negatives, np.searchsorted(falling, -low, side="right"))]
                    got += [(own[k], positive, score, ids[i], row[i]) for i in take]
        columns = [np.array(c, dtype=np.int64) for c in (zip(*got, strict=True) if got else ((),) * 5)]
        return pa.table(dict(zip(("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"), columns, strict=True)))

    return run


def _over(anchors: DataFrame, candidates: DataFrame, run, schema: str, rows: int, columns: int) -> DataFrame:
    """``run`` over every cell of the grid of blocks of anchors and of candidates."""
    block = lambda n: F.pmod(F.xxhash64("vec_id", F.lit(n)), F.lit(n))
    of = lambda df, own, other, r, c: df.withColumn("_own", block(own)).withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(other - 1)))).withColumn("cell", F.col(r) * columns + F.col(c)).drop("_own", "_other")
    return of(anchors, rows, columns, "_own", "_other").groupBy("cell").cogroup(of(candidates, columns, rows, "_other", "_own").groupBy("cell")).applyInArrow(run, schema)


def mine(vectors: DataFrame, anchors: Column, *, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", settings: Settings | None = None) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score; ``anchors`` says which rows are anchors.

    An anchor's positives are its first other rows of the same label; negatives are the first rows of other labels whose score is within the bounds of the
    positive's. Higher scores come first, ties by smaller id. Rows with a null id, label or vector, or a null or non-finite component take no part;
    of rows that share an id, the one with the least label, then the least components, does. Vectors of other lengths count as if zeros followed them. An
    anchor without positives, or a positive without negatives in its bounds, gives no rows; an empty table gives none. Scores are longs: where a
    product does not fit one, it wraps around. Other columns are left out, whatever their names.
    """
    s = settings or Settings()
    ship(vectors.sparkSession)
    x = F.col(vector_col)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    whole = F.transform(x, lambda v: F.floor(F.lit(s.scale) * v.cast("double")))
    given = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull() & finite)
    given = given.select(F.col(id_col).cast("long").alias("vec_id"), F.struct(F.col(label_col).cast("long").alias("label"), whole.alias("x"), F.coalesce(anchors, F.lit(False)).alias("anchor")).alias("row"))
    known = written(given.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.x", "row.anchor"), "vectors")
    counts = known.agg(F.count("*"), F.count(F.when(F.col("anchor"), 1))).first()
    rows, columns = -(-max(counts[1], 1) // s.anchors), -(-max(counts[0], 1) // s.candidates)
    candidates, wanted = known.drop("anchor"), known.where("anchor").drop("anchor")
    ranked = lambda df, by, most, score, name: df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(score), name))).where(F.col("rank") <= most)
    first = ranked(_over(wanted, candidates, _positives(s), "anchor_id long, positive_id long, score long", rows, columns), ["anchor_id"], s.positives, "score", "positive_id")
    lists = first.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("positive_id", "score")).alias("positives"))
    with_lists = written(wanted.join(lists, "vec_id"), "anchors")
    found = _over(with_lists, candidates, _negatives(s), "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long", rows, columns)
    return ranked(found, ["anchor_id", "positive_id"], s.negatives, "negative_score", "negative_id").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def oracle_sql() -> str:
    """The rows of ``op12_negatives`` as SQL."""
    return """
    WITH v AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
      FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id AS other_id,
             CAST(list_sum(list_transform(list_zip(a.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
    p AS (
      SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
    SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
           other_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) <= 3
    """
