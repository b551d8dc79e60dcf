"""Near-duplicate grouping by SuperMinHash signatures, banding, verification on full sets, and union-find.

SuperMinHash: every element draws a random number and, step by step, a random permutation of the places; at step j it offers
j plus its number to the place that the permutation names, and each place keeps its least. Places are correlated, so the
signature has lower variance than independent minima, and a document is done once its largest place is below the next step.

Documents with equal sets become one. The others meet in band buckets. In each bucket the smallest id is compared with all other
members. Buckets whose members are then in more than one component stay open. There, shingles that only one document has are counted: they
are in no intersection, so a document with too many of them can link with none and leaves. Of the rest the one with the fewest,
the likest to what the bucket has in common, is compared with all others. What even then is apart from its bucket's component meets members of
other components by an exact prefix join: with shingles in order of rising document frequency, a pair that links shares one among the
first few of both sets, early enough for the rest to suffice. So a link can only be missed where no band is shared, and comparisons
follow the rows of a bucket, not its pairs. All comparisons are on the full sets of 64-bit shingle hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketlake.llm import filters
from docketlake.llm.memory import mapped
from docketlake.llm.words import mix, shingles, word_hashes
from docketlake.operators.components import connected_components
from docketlake.session import ship, written

_GOLD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """Words a shingle; the least Jaccard similarity in percent; bands of rows: at similarity 0.8 a pair shares no band
    with probability (1 - 0.8**4)**24, about 3 in a million."""

    words: int = 5
    percent: int = 80
    bands: int = 24
    rows: int = 4


def super_minhash(sets: list[np.ndarray], places: int) -> np.ndarray:
    """A row a set: its SuperMinHash as integers (step * 2**48 + number); at most 255 places. An empty set keeps the largest value."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    best = np.full(len(sets) * places, np.iinfo(np.uint64).max, dtype=np.uint64)
    x = np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
    own = np.repeat(np.arange(len(sets)) * places, sizes)
    swapped, order = None, None
    for j in range(places):
        if not len(x):
            break
        drawn = mix(x + np.uint64((j + 1) * int(_GOLD) & 0xFFFFFFFFFFFFFFFF))
        k = j + ((drawn & np.uint64(0xFFFF)).astype(np.int64) % (places - j))
        if j == 0:
            at = swapped = k
        elif j == 1:
            at = np.where(k == swapped, 0, k)
        else:
            if order is None:  # the permutations so far, for the few elements that go on
                order = np.tile(np.arange(places, dtype=np.uint8), (len(x), 1))
                rows = np.arange(len(x))
                order[rows, swapped], order[:, 0] = 0, swapped
                order[rows, first], order[rows, 1] = order[rows, 1].copy(), order[rows, first].copy()  # noqa: F821
            rows = np.arange(len(x))
            at = order[rows, k].astype(np.int64)
            order[rows, k], order[rows, j] = order[rows, j].copy(), at.astype(np.uint8)
        if j == 1:
            first = k
        np.minimum.at(best, own + at, (np.uint64(j) << np.uint64(48)) | (drawn >> np.uint64(16)))
        done = best.reshape(len(sets), places).max(axis=1) < (np.uint64(j + 1) << np.uint64(48))
        going = ~done[own // places]
        if not going.all():
            x, own, swapped = x[going], own[going], swapped[going]
            if j >= 1:
                first = first[going]
            order = order[going] if order is not None else None
    return best.reshape(len(sets), places)


def _sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    hashes, bounds, _, _ = word_hashes(texts)
    return [np.unique(shingles(hashes[a:b], n)) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _signed(s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = mix(np.arange(70, 70 + s.rows, dtype=np.uint64) * _GOLD) | np.uint64(1)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                sets = _sets(part.column(1).to_pylist(), s.words)
                sig = super_minhash(sets, s.bands * s.rows).reshape(len(sets), s.bands, s.rows)
                bands = mix((sig * factors).sum(axis=2, dtype=np.uint64) + np.arange(s.bands, dtype=np.uint64) * _GOLD).view(np.int64)
                keys = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(sets) * s.bands + 1, s.bands), pa.int32()), pa.array(bands.reshape(-1), pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array(keys, pa.binary()), lists], ["doc_id", "n_shingles", "key", "bands"])

    return run


def _chosen_sets(s: Settings, shared):
    """(doc_id, set) of the documents that the filter may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            rows = np.flatnonzero(filters.holds(shared.value, ids.view(np.uint64)))
            for at in range(0, len(rows), 256):
                part = rows[at : at + 256]
                texts = batch.column(1).take(pa.array(part)).to_pylist()
                found = [x.view(np.int64) for x in _sets(texts, s.words)]
                yield pa.RecordBatch.from_arrays([pa.array(ids[part], pa.int64()), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "grams"])

    return run


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    one = sets.select(F.col("doc_id").alias("a"), F.col("grams").alias("x"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("grams").alias("y"))
    met = pairs.join(one, "a").join(two, "b")
    common = F.size(F.array_intersect("x", "y"))
    return met.where(100 * common >= percent * (F.size("x") + F.size("y") - common)).select("a", "b")


def _near(n: str, m: str, percent: int):
    """Sizes that a similar enough pair can have."""
    return (100 * F.least(n, m) >= percent * F.greatest(n, m))


def _open(members: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of the buckets (bucket, rep, n, ..) whose members are in more than one component, with component, main (that of the
    bucket's smallest id) and least_n (the smallest set's size)."""
    placed = members.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    placed = written(placed, "placed")
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("n").alias("least_n"), F.min(F.struct("rep", "component")).alias("first")).where("low <> high")
    return written(placed.join(mixed.select("bucket", "least_n", F.col("first.component").alias("main")), "bucket"), "open")


def _alive(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Open rows that may still link, with u, the number of the set's shingles that no other open document has.

    A link needs an intersection of percent / (100 + percent) of both sizes together, and u shingles are in none."""
    ids = open_.select(F.col("rep").alias("doc_id")).distinct()
    grams = sets.join(ids, "doc_id", "left_semi").select("doc_id", F.explode("grams").alias("gram"))
    single = grams.groupBy("gram").agg(F.count("*").alias("k"), F.min("doc_id").alias("rep")).where("k = 1").groupBy("rep").agg(F.count("*").alias("u"))
    told = open_.join(single, "rep", "left").withColumn("u", F.coalesce("u", F.lit(0).cast("long")))
    return written(told.where((100 + percent) * (F.col("n") - F.col("u")) >= percent * (F.col("n") + F.greatest(F.col("least_n"), F.col("n") * percent / 100))), "alive")


def _late(rows: DataFrame, other: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the rows of a bucket and ``other`` rows of it in another component."""
    may = lambda n, u: (100 + percent) * (F.col(n) - F.col(u)) >= percent * (F.col("n") + F.col("n2"))
    met = rows.join(other, "bucket").where((F.col("component") != F.col("component2")) & _near("n", "n2", percent) & may("n", "u") & may("n2", "u2"))
    pairs = written(met.select(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b")).distinct(), "pairs")
    return written(_linked(pairs, sets, percent), "links")


def _last(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of documents apart from the component of an open bucket with open documents of other components, by prefix join.

    A link needs an intersection of a = percent / (100 + percent) of both sizes together. With n - a + 1 shingles, the rarest
    first, both prefixes hold the first common one; at places i and j of sets of n and m it leaves 1 + min(n - i, m - j)."""
    docs = rest.groupBy("rep").agg(F.first("n").alias("n"), F.first("component").alias("component"), F.min("least_n").alias("least_n"), F.max(F.col("component") != F.col("main")).alias("apart"))
    docs = written(docs, "apart")
    grams = sets.join(docs.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").select(F.col("doc_id").alias("rep"), F.explode("grams").alias("gram"))
    common = grams.groupBy("gram").agg(F.count("*").alias("df"))
    ordered = grams.join(common, "gram").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("g")).join(docs, "rep")
    need = F.ceil(percent * (F.col("n") + F.greatest(F.col("least_n"), F.ceil(F.col("n") * percent / 100))) / (100 + percent))
    first = F.slice("g", 1, F.greatest(F.col("n") - need + 1, F.lit(0)).cast("int"))
    rows = written(ordered.select("rep", "n", "component", "apart", F.posexplode(first).alias("i", "x")).select("rep", "n", "component", "apart", (F.col("i") + 1).alias("i"), "x.gram"), "prefixes")
    other = rows.select("gram", *(F.col(c).alias(f"{c}2") for c in ("rep", "n", "component", "i")))
    room = (100 + percent) * (1 + F.least(F.col("n") - F.col("i"), F.col("n2") - F.col("i2"))) >= percent * (F.col("n") + F.col("n2"))
    met = rows.where("apart").join(other, "gram").where((F.col("component") != F.col("component2")) & _near("n", "n2", percent) & room)
    pairs = written(met.select(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b")).distinct(), "pairs")
    return written(_linked(pairs, sets, percent), "links")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", settings: Settings | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable over links, itself included), kept (doc_id = component_id).

    A null or empty text has an empty set and is linked with nothing; a text with fewer words than a shingle is one shingle.
    Repeated rows share their id and so their component. Rows with a null id have a null component and are kept. An empty table
    gives no rows. Other columns are left out, whatever their names.
    """
    s = settings or Settings()
    spark = docs.sparkSession
    ship(spark)
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = written(given.transform(mapped, _signed(s), "doc_id long, n_shingles long, key binary, bands array<long>"), "signed")
    usable = signed.where("key is not null and doc_id is not null")
    reps = written(usable.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "reps")
    rows = reps.select(F.explode("bands").alias("bucket"), "rep", "n")
    shared = rows.groupBy("bucket").agg(F.min(F.struct("rep", "n")).alias("leader"), F.count("*").alias("size")).where("size > 1")
    members = written(rows.join(shared.select("bucket", F.col("leader.rep").alias("leader"), F.col("leader.n").alias("leader_n")), "bucket"), "members")
    pairs = written(members.where((F.col("rep") != F.col("leader")) & _near("n", "leader_n", s.percent)).select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")
    involved = members.select("rep").distinct()
    chosen = filters.shared(involved)
    sets = written(given.where("doc_id is not null").transform(mapped, _chosen_sets(s, chosen), "doc_id long, grams array<long>").dropDuplicates(["doc_id"]), "sets")
    links = written(_linked(pairs, sets, s.percent), "links")
    found = written(connected_components(links), "components")
    open_ = _open(members.drop("leader_n"), found)
    final = found
    if open_.limit(1).count():
        stars = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        alive = _alive(open_, sets, s.percent)
        centre = alive.groupBy("bucket").agg(F.min(F.struct("u", "rep", "n", "component")).alias("c"), F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
        centre = centre.select("bucket", *(F.col(f"c.{x}").alias(f"{x}2") for x in ("rep", "n", "u", "component")))
        late = _late(alive, centre, sets, s.percent)
        found = written(connected_components(stars.unionByName(late)), "components")
        rest = _open(alive.drop("component", "main", "least_n"), found)
        last = _last(rest, sets, s.percent)
        final = connected_components(stars.unionByName(late).unionByName(last)) if last.limit(1).count() else found
    grouped = reps.select("key", "rep").join(final.withColumnRenamed("node", "rep"), "rep", "left").select("key", F.coalesce("component", "rep").alias("component"))
    out = signed.select("doc_id", "n_shingles", "key").join(grouped, "key", "left")
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", settings: Settings | None = None) -> DataFrame:
    """``docs`` with one document, the one with the smallest id, of each near-duplicate group; all columns stay.

    Only rows that a filter of the dropped ids may hold are joined with these; the others go on where they are. Rows that share the kept
    id all stay, as do rows with a null id or without words. An empty table stays empty. Helper columns have names that the table has not.
    """
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, settings=settings)
    gone, may = filters.names(docs, "gone", "may")
    dropped = written(found.where("not kept").select(F.col("doc_id").alias(gone)).distinct(), "dropped")
    marked = docs.withColumn(may, filters.may_hold(F.col(id_col), filters.shared(dropped)))
    rest = marked.where(F.col(may)).join(dropped, F.col(id_col).cast("long") == F.col(gone), "left_anti")
    return marked.where(~F.col(may)).unionByName(rest).select(*(F.col(f"`{c}`") for c in docs.columns))
