"""Incremental runs with Structured Streaming: statistics, harvest, tagging and search feed from a stream of documents.

A week may get documents at any later time, so statistics have no watermark: they are tables in hash buckets, of which a batch rewrites those of its keys. A harvest
looks up the ids it has met in what it has written, back to its high-water date. A batch that runs again after a failure replaces its own work. Rows that
bear their run's flag are left out, and the ids of what a batch has done are kept beside its result, for ``processed`` to flag.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docketlake.functions.text import truthy
from docketlake.operators import entities, stats, views
from docketlake.session import intermediate, written
from docketlake.sources import feed, sinks
from docketlake.streaming.store import BucketStore


def _version(folder: str, batch: int) -> str:
    return f"{folder}/batch={batch}"


def _folder(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _batches(spark: SparkSession, folder: str) -> list[int]:
    path, store = _folder(spark, folder)
    if not store.exists(path):
        return []
    return sorted(int(f.getPath().getName().split("=")[1]) for f in store.listStatus(path) if f.getPath().getName().startswith("batch="))


def _previous(spark: SparkSession, folder: str, batch: int) -> DataFrame | None:
    """The stored table before this batch: that of the latest earlier batch."""
    earlier = [b for b in _batches(spark, folder) if b < batch]
    return spark.read.parquet(_version(folder, earlier[-1])) if earlier else None


def pending(docs: DataFrame, flag: str) -> DataFrame:
    """Documents without the flag (a boolean, or the time of the last run)."""
    return docs.where(~truthy(flag, dict(docs.dtypes)[flag])) if flag in docs.columns else docs


def _flag_batch(batch: DataFrame, batch_id: int, target: str) -> None:
    batch.select("doc_id").write.mode("overwrite").parquet(_version(f"{target}-processed", batch_id))


def processed(docs: DataFrame, target: str, flag: str) -> DataFrame:
    """``docs`` with the flag set on what the batches of ``target`` have done."""
    spark = docs.sparkSession
    found = _batches(spark, f"{target}-processed")
    done = spark.read.parquet(*(_version(f"{target}-processed", b) for b in found)) if found else docs.limit(0)
    return views.mark(docs, done, flag)


def stored(spark: SparkSession, folder: str) -> DataFrame:
    """The latest version of a stored table, in buckets or whole."""
    found = BucketStore(spark, folder).read()
    return _previous(spark, folder, 1 << 62) if found is None else found


def merge_into(
    folder: str, delta: Callable[[DataFrame], DataFrame], merge: Callable[[DataFrame, DataFrame], DataFrame], flag: str = "in_aggregates", key: str = "docket_id", buckets: int = 64
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: the partial result of a batch's unflagged rows, merged into the stored table's buckets of their keys."""

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = pending(batch, flag)
        BucketStore(batch.sparkSession, folder, key, buckets).merge(batch_id, delta(rows), merge)
        if "doc_id" in batch.columns:
            _flag_batch(rows, batch_id, folder)

    return run


def _merged(docs: DataFrame, checkpoint: str, run: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Runs until what is there is done."""
    return docs.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_histogram(docs: DataFrame, folder: str, checkpoint: str, key: str = "docket_id") -> StreamingQuery:
    """Weekly counts of each key, merged batch by batch."""
    return _merged(docs, checkpoint, merge_into(folder, lambda d: stats.weeks(d, key), stats.merge_histograms, key=key))


def stream_scalars(docs: DataFrame, folder: str, checkpoint: str, key: str = "docket_id") -> StreamingQuery:
    return _merged(docs, checkpoint, merge_into(folder, lambda d: stats.scalars(d, key), lambda a, b: stats.merge_scalars(a, b, key), key=key))


def stream_recent(docs: DataFrame, folder: str, checkpoint: str, k: int, types: tuple[str, ...] | None = None, key: str = "docket_id") -> StreamingQuery:
    """The k latest documents of each key: k rows a key are stored, whatever has come."""
    return _merged(docs, checkpoint, merge_into(folder, lambda d: stats.recent_rows(d, key, k, types), lambda a, b: stats.merge_recent(a, b, key, k), key=key))


def stream_new(harvest: DataFrame, target: str, checkpoint: str, known: Callable[[SparkSession], DataFrame] | None = None, days: int = 1) -> StreamingQuery:
    """A harvest: each id once, whatever files it comes in, unless it is withdrawn, stored already (``known``: doc_id, date_posted) or dated more than ``days``
    before the high-water date: the latest one stored when the run starts, or met in an earlier batch.

    What has been met is what was written: a batch reads of it the ids and dates that are not older than the high-water date allows, for an older row would be late anyway. Undated
    rows are never late, and their ids stay known. A feed without dates has no high-water date. Of an id's rows in a batch the first by date, then by the
    other columns, counts. A batch that runs again replaces its own rows.
    """
    spark = harvest.sparkSession
    usable = harvest.where(F.coalesce("status", F.lit("")) != "Withdrawn")
    dated = "date_posted" in harvest.columns
    if known:
        there = known(spark)
        usable = usable.join(there.select("doc_id").distinct(), "doc_id", "left_anti")
        high = there.agg(F.date_sub(F.max("date_posted"), days)).first()[0] if dated else None
        usable = usable.where(F.col("date_posted").isNull() | (F.col("date_posted") >= F.lit(high))) if high else usable
    tops = f"{target}-high"

    def run(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        earlier = [b for b in _batches(session, target) if b < batch_id]
        marks = [b for b in _batches(session, tops) if b < batch_id]
        top = session.read.parquet(_version(tops, marks[-1])).first()[0] if marks else None
        oldest = F.lit(top) - F.expr(f"interval {days} days") if top is not None else None

        def in_time(rows: DataFrame) -> DataFrame:
            posted = F.col("date_posted")
            return rows.where(posted.isNull() | (posted.cast("timestamp") >= oldest)) if oldest is not None else rows

        order = [x for c in ("date_posted", *(c for c in batch.columns if c not in ("doc_id", "date_posted"))) if c in batch.columns for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]
        posted = F.max(F.col("date_posted").cast("timestamp")) if dated else F.lit(None).cast("timestamp")
        with intermediate(session):
            first = written(in_time(batch).groupBy("doc_id").agg(F.min(F.struct(*order)).alias("r"), posted.alias("top")), "first")
            rows = first.select("doc_id", *(F.col(f"r.{c}") for c in batch.columns if c != "doc_id"), "top").select(*batch.columns)
            if earlier:
                met = in_time(session.read.parquet(*(_version(target, b) for b in earlier)))
                rows = rows.join(met.select(F.col("doc_id").alias("met")).distinct(), F.col("doc_id").eqNullSafe(F.col("met")), "left_anti")
            rows.write.mode("overwrite").parquet(_version(target, batch_id))
            if dated:
                highest = first.agg(F.greatest(F.max("top"), F.lit(top).cast("timestamp")).alias("top"))
                highest.write.mode("overwrite").parquet(_version(tops, batch_id))  # one row

    return usable.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_matches(texts: DataFrame, aliases: DataFrame, target: str, checkpoint: str, flag: str = "entities_last_extracted") -> StreamingQuery:
    """Tagging: each batch's texts that were not tagged yet, matched with the alias table."""

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = pending(batch, flag)
        entities.match(rows, aliases).write.mode("overwrite").parquet(_version(target, batch_id))
        _flag_batch(rows, batch_id, target)

    return texts.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_feed(records: DataFrame, kind: str, target: str, checkpoint: str, flag: str = "in_search_index") -> StreamingQuery:
    """Search feed: the records that are not in the index, as lines, and the ids of all that were looked at, by a sink that commits both once a batch."""
    feed.register(records.sparkSession)
    rows = pending(records, flag).drop(flag)
    line = sinks.search_line(rows, kind)
    fed = F.when(F.coalesce("in_feed", F.lit(False)), line) if "in_feed" in rows.columns else line
    key = F.col("doc_id" if kind == "document" else "docket_id").alias("doc_id")
    return rows.select(key, fed.alias("value")).writeStream.format("search_feed").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
