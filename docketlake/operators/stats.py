"""Rollup statistics in long form: one aggregation a grain, null buckets kept, mergeable partial results.

Histograms are rows (grain id, metric, key, count), never maps: a null month or week is a bucket of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from docketlake.functions.text import expanded_count
from docketlake.session import written


def week_start(date: Column | str) -> Column:
    """The Monday of a date's ISO week; null for null."""
    return F.date_trunc("week", date).cast("date")


def month(date: Column | str) -> Column:
    return F.date_format(date, "yyyy-MM")


def with_expanded(docs: DataFrame) -> DataFrame:
    return docs.withColumn("expanded", expanded_count("type", "dup_count"))


def scalars(docs: DataFrame, *keys: str) -> DataFrame:
    """Count, expanded comment count and date range of each key; null keys are left out."""
    given = with_expanded(docs)
    for k in keys:
        given = given.where(F.col(k).isNotNull())
    return given.groupBy(*keys).agg(F.count("*").alias("n_docs"), F.sum("expanded").alias("n_comments"), F.min("date_posted").alias("first_date"), F.max("date_posted").alias("last_date"))


def histogram(docs: DataFrame, key: str, bucket: Column, metric: str) -> DataFrame:
    """(key, metric, bucket, count); a null bucket is a bucket."""
    return docs.where(F.col(key).isNotNull()).groupBy(F.col(key), F.lit(metric).alias("metric"), bucket.cast("string").alias("bucket")).agg(F.count("*").alias("n"))


def type_breakdown(docs: DataFrame, key: str) -> DataFrame:
    return histogram(docs, key, F.coalesce("type", F.lit("None")), "type")


def weeks(docs: DataFrame, key: str) -> DataFrame:
    return histogram(docs, key, week_start("date_posted"), "week")


def months(docs: DataFrame, key: str) -> DataFrame:
    return histogram(docs, key, month("date_posted"), "month")


def recent(docs: DataFrame, key: str, k: int, types: tuple[str, ...] | None = None) -> DataFrame:
    """The k latest documents of each key, null dates last, ties by id; with their rank."""
    given = docs.where(F.col(key).isNotNull())
    given = given.where(F.col("type").isin(*types)) if types else given
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.col("date_posted").desc_nulls_last(), "doc_id"))
    return given.withColumn("rank", rank).where(F.col("rank") <= k)


def fr_docs(docs: DataFrame, key: str, types: tuple[str, ...] = ("notice", "rule", "proposed_rule")) -> DataFrame:
    """All rule-making documents of each key with their place by date, latest first. They are sorted over range partitions, and where a key's
    places begin in each comes from counts, so no task ranks all of a large key."""
    order = [F.col(key), F.col("date_posted").desc_nulls_last(), F.col("doc_id")]
    given = docs.where(F.col(key).isNotNull() & F.col("type").isin(*types))
    at = F.monotonically_increasing_id()
    placed = written(given.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at).withColumn("_part", F.shiftright("_at", 33)), "placed")
    parts = placed.groupBy(key, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))  # a row a key and partition
    bases = parts.select(key, "_part", (F.coalesce(before, F.lit(0)) - F.col("_first") + 1).alias("_base"))
    return placed.join(bases, [key, "_part"]).withColumn("rank", (F.col("_at") + F.col("_base")).cast("int")).drop("_at", "_part", "_base")


def commented_docs(docs: DataFrame) -> DataFrame:
    """Public submissions that comment on a document, keyed by that document."""
    return docs.where("type = 'public_submission' and comment_on_id is not null")


def entity_documents(docs: DataFrame, entities: DataFrame) -> DataFrame:
    """A row a document, entity and kind of mention: an entity counts once a document, wherever it stands."""
    return entities.select("doc_id", "entity_id", "mention").distinct().join(docs, "doc_id")


def entity_scalars(mentions: DataFrame) -> DataFrame:
    return mentions.groupBy("entity_id", "mention").agg(F.count("*").alias("n_docs"), F.min("date_posted").alias("first_date"), F.max("date_posted").alias("last_date"))


def entity_totals(mentions: DataFrame) -> DataFrame:
    """Documents by text and by submitter, and both together; entities without any are not there."""
    text, by = F.count(F.when(F.col("mention") == "text", 1)), F.count(F.when(F.col("mention") == "submitter", 1))
    return mentions.groupBy("entity_id").agg(text.alias("n_text"), by.alias("n_submitter"), F.count("*").alias("n_total"))


def entity_matrix(mentions: DataFrame) -> DataFrame:
    """Documents by entity, mention, agency and month."""
    return mentions.groupBy("entity_id", "mention", "agency", month("date_posted").alias("month")).agg(F.count("*").alias("n"))


def merge_histograms(stored: DataFrame, delta: DataFrame) -> DataFrame:
    """Stored counts and new ones, added; both (key.., count n)."""
    keys = [c for c in stored.columns if c != "n"]
    return stored.unionByName(delta).groupBy(*keys).agg(F.sum("n").alias("n"))


def merge_scalars(stored: DataFrame, delta: DataFrame, *keys: str) -> DataFrame:
    both = stored.unionByName(delta)
    return both.groupBy(*keys).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_comments").alias("n_comments"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"))


def recent_rows(docs: DataFrame, key: str, k: int, types: tuple[str, ...] | None = None) -> DataFrame:
    """What ``merge_recent`` needs to know of the k latest documents: (key, doc_id, date_posted, rank)."""
    return recent(docs, key, k, types).select(key, "doc_id", "date_posted", "rank")


def merge_recent(stored: DataFrame, delta: DataFrame, key: str, k: int) -> DataFrame:
    """The k latest of the two lists' rows, each of k rows a key at most; a document that is in both counts as in ``delta``."""
    both = stored.drop("rank").withColumn("_new", F.lit(0)).unionByName(delta.drop("rank").withColumn("_new", F.lit(1)))
    rest = [c for c in both.columns if c not in (key, "doc_id", "_new")]
    one = both.groupBy(key, "doc_id").agg(F.max_by(F.struct(*rest), "_new").alias("r")).select(key, "doc_id", "r.*")
    return recent(one, key, k).select(*stored.columns)


def observed_counters(rows: DataFrame, column: str, values: tuple[str, ...], name: str = "counters") -> tuple[DataFrame, Observation]:
    """``rows`` that, wherever they are written next, are counted on the way by the values of a column: no second scan. The counts (``other`` for other values, null
    included) are in the observation once that run has ended."""
    told = Observation(name)
    counts = [F.count(F.when(F.col(column) == v, 1)).alias(v) for v in values]
    return rows.observe(told, *counts, F.count(F.when(~F.coalesce(F.col(column).isin(*values), F.lit(False)), 1)).alias("other")), told


def upsert(target: DataFrame, new: DataFrame, key: str, *, clear_missing: bool) -> DataFrame:
    """``target`` with the columns of ``new`` by key; null and empty keys are skipped. clear_missing (a full run): rows that
    ``new`` has not lose the old values; else they keep them."""
    fields = [c for c in new.columns if c != key]
    given = new.where(F.col(key).isNotNull() & (F.col(key).cast("string") != "")).withColumn("_new", F.lit(True))
    joined = target.alias("t").join(given.alias("n"), key, "full_outer")

    def value(c: str) -> Column:
        if c not in fields:
            return F.col(f"t.{c}")
        return F.when(F.col("n._new"), F.col(f"n.{c}")).otherwise(F.lit(None) if clear_missing or c not in target.columns else F.col(f"t.{c}"))

    return joined.select(key, *(value(c).alias(c) for c in dict.fromkeys([*target.columns, *fields]) if c != key))


def derive_dockets(docs: DataFrame) -> DataFrame:
    """Each docket with its agency: the only one, else the one that begins the docket's id, else the first by name."""
    by = docs.where(F.col("docket_id").isNotNull()).groupBy("docket_id").agg(F.collect_set("agency").alias("agencies"))
    begins = F.filter(F.sort_array("agencies"), lambda a: F.startswith(F.col("docket_id").cast("string"), a))
    return by.select("docket_id", F.coalesce(F.get(begins, F.lit(0)), F.get(F.sort_array("agencies"), F.lit(0))).alias("agency"), F.size("agencies").alias("n_agencies"))


def high_water_date(docs: DataFrame, *by: str) -> DataFrame:
    return docs.groupBy(*by).agg(F.max("date_posted").alias("high_water"))


def last_days(docs: DataFrame, key: str, days: int = 7) -> DataFrame:
    """Documents later than their key's last date less ``days``."""
    last = docs.groupBy(key).agg(F.max("date_posted").alias("last_date"))
    return docs.join(last, key).where(F.col("date_posted") > F.date_sub("last_date", days))


def run_counters(actions: DataFrame, column: str = "action") -> DataFrame:
    return actions.groupBy(column).agg(F.count("*").alias("n"))


def name_dockets(docs: DataFrame) -> DataFrame:
    """The title of each docket: of its earliest rule, proposed rule or notice; else of its earliest "other"; else its id."""
    order = F.when(F.col("type").isin("rule", "proposed_rule", "notice"), 0).when(F.col("type") == "other", 1)
    ranked = docs.withColumn("order", order).withColumn("r", F.row_number().over(Window.partitionBy("docket_id").orderBy(F.col("order").asc_nulls_last(), F.col("date_posted").asc_nulls_last(), "doc_id")))
    return ranked.where("r = 1").select("docket_id", F.when(F.col("order").isNotNull(), F.col("title")).otherwise(F.col("docket_id").cast("string")).alias("title"))


def entity_report(mentions: DataFrame, key: str) -> DataFrame:
    """For each key and kind of mention: "entity: count; ..." by falling count."""
    counted = mentions.groupBy(key, "mention", "entity_id").agg(F.count("*").alias("n"))
    return counted.groupBy(key, "mention").agg(F.expr("listagg(concat(entity_id, ': ', n), '; ') within group (order by n desc, entity_id)").alias("entities"), F.count("*").alias("n_entities"))


def name_entity_counts(counts: DataFrame, entities: DataFrame) -> DataFrame:
    """Counts with each entity's name, its first alias."""
    return counts.join(entities.select("entity_id", F.get("aliases", F.lit(0)).alias("name")), "entity_id")


def longest_text_bytes(views: DataFrame) -> DataFrame:
    """Sum, over a document's own views and each attachment, of the longest text in bytes. Columns: doc_id, attachment (null: own), text."""
    longest = views.groupBy("doc_id", "attachment").agg(F.max(F.octet_length("text")).alias("n"))
    return longest.groupBy("doc_id").agg(F.sum("n").alias("n_bytes"))
