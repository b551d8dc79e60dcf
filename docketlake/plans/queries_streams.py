"""Registered queries that run as streams over the supplied tables, to the same results as full runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.plans import bindings as b
from docketlake.plans.queries_similarity import ALIASES, TOKENS, _aliases
from docketlake.plans.queries_stats import WITH, _recent_sql, text_dates
from docketlake.plans.registry import register
from docketlake.session import scratch, table
from docketlake.streaming import incremental


def _stream(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The rows as a stream, from a table in the shared folder, all at once."""
    path = scratch(spark, "feed")
    rows.write.parquet(path)
    return spark.readStream.schema(rows.schema).parquet(path)


def _batches(spark: SparkSession, rows: DataFrame, sized_by: DataFrame, least: int, per_file: int) -> DataFrame:
    """The rows as a stream of two batches, in files by doc_id: one for every ``per_file`` rows of ``sized_by``, so that no task's share grows with the input, and
    ``least`` at least."""
    path, n = scratch(spark, "feed"), max(least, -(-sized_by.count() // per_file))
    rows.repartition(n, "doc_id").write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", -(-n // 2)).parquet(path)


def _places(spark: SparkSession) -> tuple[str, str]:
    return scratch(spark, "target"), scratch(spark, "checkpoint")


@register(f"{WITH} select docket_id, 'week' as metric, cast(cast(date_trunc('week', date_posted) as date) as varchar) as bucket, count(*) as n from docs group by all")
def t1_stream_weeks(spark, sf_dir):
    """Weekly counts in buckets, by several batches."""
    target, checkpoint = _places(spark)
    incremental.stream_histogram(_batches(spark, b.docs(spark, sf_dir), table(spark, sf_dir, "orders"), 6, 500_000), target, checkpoint).awaitTermination()
    return incremental.stored(spark, target)


@register(_recent_sql("'public_submission'", 5, "comment_on_id"))
def t1_stream_recent(spark, sf_dir):
    """The recent comments of each document, five rows stored a document, by several batches."""
    target, checkpoint = _places(spark)
    docs = _batches(spark, b.docs(spark, sf_dir), table(spark, sf_dir, "orders"), 6, 500_000)
    incremental.stream_recent(docs, target, checkpoint, 5, ("public_submission",), key="comment_on_id").awaitTermination()
    return text_dates(incremental.stored(spark, target))


@register("""with f as (select doc_id, date '2024-01-01' + cast(doc_id % 365 as int) as d, doc_id % 23 = 0 as gone from documents), known as (select doc_id, d from f where doc_id % 3 = 0 and d <= date '2024-06-01')
  select doc_id, cast(d as varchar) as date_posted from f where not gone and doc_id not in (select doc_id from known) and d >= (select max(d) from known) - 1""")
def t2_stream_new(spark, sf_dir):
    """A harvest in which every row comes twice, against stored documents."""
    feed = b.texts(spark, sf_dir).select("doc_id", "date_posted", F.when(F.col("doc_id") % 23 == 0, "Withdrawn").otherwise("Posted").alias("status"))
    known = feed.where("doc_id % 3 = 0 and date_posted <= date '2024-06-01'")
    target, checkpoint = _places(spark)
    incremental.stream_new(_stream(spark, feed.unionByName(feed)), target, checkpoint, known=lambda s: known).awaitTermination()
    return spark.read.parquet(target).select("doc_id", F.col("date_posted").cast("string").alias("date_posted"))


@register(f"with {TOKENS}, {ALIASES} select distinct d.doc_id, a.entity_id from tokens d join aliases a on contains(' ' || array_to_string(d.t, ' ') || ' ', ' ' || a.alias || ' ') where a.alias <> ''")
def t3_stream_matches(spark, sf_dir):
    """Texts tagged as they come, by several batches."""
    target, checkpoint = _places(spark)
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    incremental.stream_matches(_batches(spark, texts, texts, 4, 20_000), _aliases(spark, sf_dir), target, checkpoint).awaitTermination()
    return spark.read.parquet(target).select("doc_id", "entity_id")


@register("select doc_id, source as docket_id from documents where doc_id % 9 <> 0")
def t4_stream_feed(spark, sf_dir):
    """The search feed by its sink, read back from its files."""
    target, checkpoint = _places(spark)
    records = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("docket_id"), "text", (F.col("doc_id") % 9 != 0).alias("in_feed"))
    incremental.stream_feed(_stream(spark, records), "document", target, checkpoint).awaitTermination()
    lines = spark.read.text(f"{target}/batch=*/*.txt").where(F.startswith("value", F.lit('{"index":')))
    return lines.select(F.get_json_object("value", "$.index._id").cast("long").alias("doc_id"), F.get_json_object("value", "$.index._parent").alias("docket_id"))
