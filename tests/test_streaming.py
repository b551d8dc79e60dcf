"""Streams over restarts: buckets that a batch rewrites, keyed state of a harvest, recent documents."""

from pyspark.sql import functions as F

from docketlake.operators import stats
from docketlake.streaming import incremental
from docketlake.streaming.store import BucketStore


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(folder):
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def counts(spark, *pairs):
    return spark.createDataFrame(list(pairs), "docket_id long, n long")


def test_a_batch_rewrites_the_buckets_of_its_keys_only(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path / "t"), buckets=8)
    assert store.read() is None
    assert len(store.merge(0, counts(spark, *((k, 1) for k in range(40))), stats.merge_histograms)) == 8
    before = files(tmp_path / "t")
    touched = store.merge(1, counts(spark, (7, 5)), stats.merge_histograms)
    after = files(tmp_path / "t")
    assert len(touched) == 1 and before.items() <= after.items()
    assert {f.split("/")[0] for f in after.keys() - before.keys()} == {f"in_bucket={touched[0]}"}
    assert rows(store.read()) == sorted(((k, 6 if k == 7 else 1) for k in range(40)), key=str)
    # a batch without rows is done and changes nothing
    assert store.merge(2, counts(spark, (1, 1)).limit(0), stats.merge_histograms) == [] and files(tmp_path / "t") == after and store.done() == [1, 2]


def test_a_batch_that_failed_half_way_leaves_nothing_and_runs_again(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path / "t"), buckets=4)
    store.merge(0, counts(spark, *((k, 1) for k in range(20))), stats.merge_histograms)
    # files of a batch that never got to its mark
    half = counts(spark, *((k, 100) for k in range(10))).withColumn("in_bucket", store.bucket()).withColumn("by_batch", F.lit(1).cast("long"))
    half.write.partitionBy("in_bucket", "by_batch").mode("append").parquet(str(tmp_path / "t"))
    assert store.read().agg(F.sum("n")).first()[0] == 20
    for _ in range(2):
        store.merge(1, counts(spark, *((k, 2) for k in range(10))), stats.merge_histograms)
        assert store.read().agg(F.sum("n")).first()[0] == 40
    assert all(len(v) <= 2 for v in store.versions().values())


def test_recent_documents_by_stream_equal_a_full_run(spark, tmp_path):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), (F.col("id") % 7).alias("docket_id"), F.when(F.col("id") % 10 > 0, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") * 37 % 90).cast("int"))).alias("date_posted"), F.when(F.col("id") % 3 > 0, "other").otherwise("rule").alias("type"))
    for k in range(3):
        docs.where(F.col("doc_id") * 7 % 3 == k).write.mode("append").parquet(str(tmp_path / "in"))
        feed = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
        incremental.stream_recent(feed, str(tmp_path / "recent"), str(tmp_path / "cp"), 5, ("other",)).awaitTermination()
    got = incremental.stored(spark, str(tmp_path / "recent"))
    assert rows(got) == rows(stats.recent_rows(docs, "docket_id", 5, ("other",)))
    moved = spark.createDataFrame([(1, 1, "2030-01-01")], "docket_id long, doc_id long, d string").select("docket_id", "doc_id", F.col("d").cast("date").alias("date_posted"), F.lit(1).alias("rank"))
    again = stats.merge_recent(got, moved, "docket_id", 5).where("docket_id = 1").orderBy("rank").collect()
    assert [r["doc_id"] for r in again].count(1) == 1 and again[0]["doc_id"] == 1 and len(again) == 5


def test_harvest_keeps_ids_as_state_until_the_high_water_date_has_passed(spark, tmp_path):
    kind = "doc_id long, date_posted date, status string, title string"

    def feed(*given):
        df = spark.createDataFrame([(i, d, s, t) for i, d, s, t in given], "doc_id long, d string, status string, title string")
        df.select("doc_id", F.col("d").cast("date").alias("date_posted"), "status", "title").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(kind).parquet(str(tmp_path / "in"))
        incremental.stream_new(stream, str(tmp_path / "new"), str(tmp_path / "cp"), days=1).awaitTermination()
        return rows(spark.read.parquet(str(tmp_path / "new")).select("doc_id", "title"))

    assert feed((1, "2024-03-01", None, "a"), (1, "2024-03-01", None, "b"), (2, None, None, "u"), (3, "2024-03-01", "Withdrawn", "w")) == [(1, "a"), (2, "u")]
    # a repeat after a restart, a withdrawn one that comes back, a row a day before the latest date
    assert feed((1, "2024-03-01", None, "c"), (3, "2024-03-02", None, "x"), (4, "2024-02-29", None, "y")) == [(1, "a"), (2, "u"), (3, "x"), (4, "y")]
    assert feed((5, "2024-03-20", None, "z")) == [(1, "a"), (2, "u"), (3, "x"), (4, "y"), (5, "z")]
    # the high-water date is now 2024-03-19: older rows are late, undated ones never, and ids with dates after it are still known
    assert feed((6, "2024-03-10", None, "late"), (1, "2024-03-01", None, "late"), (2, None, None, "v"), (7, None, None, "q"), (5, "2024-03-20", None, "again"), (8, "2024-03-19", None, "r")) == [(1, "a"), (2, "u"), (3, "x"), (4, "y"), (5, "z"), (7, "q"), (8, "r")]


def test_harvest_calls_no_python_for_an_id(spark, tmp_path):
    """Ids are met by joins and aggregation; a batch that runs again replaces its rows; without dates nothing is late."""
    ids = spark.range(2000).select((F.col("id") % 1000).alias("doc_id"), F.lit(None).cast("string").alias("status"), F.col("id").alias("n"))
    for k in range(2):
        ids.write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(ids.schema).parquet(str(tmp_path / "in"))
        query = incremental.stream_new(stream, str(tmp_path / "new"), str(tmp_path / "cp"))
        query.awaitTermination()
        assert not any(p["stateOperators"] for p in query.recentProgress)
    got = spark.read.parquet(str(tmp_path / "new"))
    assert rows(got.select("doc_id", "n")) == sorted(((i, i) for i in range(1000)), key=str)


def test_counters_come_with_the_write(spark, tmp_path):
    df = spark.createDataFrame([("insert",), ("insert",), ("update",), (None,), ("odd",)], "action string")
    counted, told = stats.observed_counters(df, "action", ("insert", "update", "delete"))
    counted.write.parquet(str(tmp_path / "out"))
    assert told.get == {"insert": 2, "update": 1, "delete": 0, "other": 2}
