"""The data source of search dumps and the sink of the search feed, over batches, streams and failures."""

import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docketlake.operators import reconcile
from docketlake.sources import dumps, feed, readers
from docketlake.sources.collection import scan_docs, write_collection
from docketlake.streaming import incremental


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def page(folder, scope, position, *ids, old=False):
    found = [{"documentId": i, "title": f"T {i}", "attachmentCount": 2} for i in ids]
    body = {"searchresult": {"documents": {"document": found[0] if len(found) == 1 else found}}} if old else {"documents": found}
    folder.mkdir(exist_ok=True)
    (folder / f"dump_{scope}_{position}.json").write_text(json.dumps(body))


def test_dumps_are_read_by_scope_in_both_forms(spark, tmp_path):
    dumps.register(spark)
    folder = tmp_path / "in"
    page(folder, "all", 0, "a", "b")
    page(folder, "all", 1000, "c", old=True)
    page(folder, "agency_EPA", 0, "d", "e", old=True)
    (folder / "other.json").write_text("{}")
    given = spark.read.format("search_dumps").load(str(folder))
    assert rows(given.select("scope", "position", "documentId")) == [("agency_EPA", 0, "d"), ("agency_EPA", 0, "e"), ("all", 0, "a"), ("all", 0, "b"), ("all", 1000, "c")]
    names = [c for c in given.columns if c not in ("scope", "position")]
    assert rows(given.where("scope = 'all'").select(*names)) == rows(readers.search_dumps(spark, str(folder), "all").select(*names))
    # the filter reaches the listing: a broken file of another scope is not opened
    (folder / "dump_docket_X_0.json").write_text("broken")
    assert given.where("scope = 'all' and position > 0").count() == 1
    assert spark.read.format("search_dumps").option("scope", "agency_EPA").load(str(folder)).count() == 2
    assert spark.read.format("search_dumps").option("scope", "agency_EPA").load(str(folder)).where("scope = 'all'").count() == 0
    with pytest.raises(Exception, match="no dump_nowhere"):
        spark.read.format("search_dumps").option("scope", "nowhere").load(str(folder)).count()


def test_a_stream_of_dumps_goes_on_behind_each_scope_position(spark, tmp_path):
    dumps.register(spark)
    folder = tmp_path / "in"

    def run():
        stream = spark.readStream.format("search_dumps").load(str(folder)).select("scope", "documentId")
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
        return rows(spark.read.parquet(str(tmp_path / "out")))

    page(folder, "all", 0, "a")
    page(folder, "all", 9000, "b")
    assert run() == [("all", "a"), ("all", "b")]
    page(folder, "all", 10000, "c")
    page(folder, "agency_EPA", 0, "d")
    assert run() == [("agency_EPA", "d"), ("all", "a"), ("all", "b"), ("all", "c")]
    assert len(run()) == 4


def test_a_feed_is_written_once_a_batch_with_its_ids(spark, tmp_path):
    target = str(tmp_path / "feed")
    lines = lambda *ids: [pa.RecordBatch.from_pydict({"doc_id": list(ids), "value": [f"{i}\n{{}}" if i % 2 else None for i in ids]}, pa.schema([("doc_id", pa.int64()), ("value", pa.string())]))]
    one = feed._Writer(target, 2)
    one.commit([one.write(lines(1, 2, 3, 5)), one.write(iter(())), None], 0)
    files = sorted((tmp_path / "feed" / "batch=0").glob("*.txt"))
    assert sorted(f.read_text() for f in files) == ["1\n{}\n3\n{}\n", "5\n{}\n"]
    assert rows(spark.read.parquet(f"{target}-processed/batch=0")) == [(1,), (2,), (3,), (5,)]
    # the same batch again, after its commit was lost: nothing changes
    again = feed._Writer(target, 2)
    again.commit([again.write(lines(1, 2, 3, 5))], 0)
    assert sorted((tmp_path / "feed" / "batch=0").glob("*.txt")) == files
    # an attempt that fails leaves nothing, neither by its task nor by its abort
    broken = feed._Writer(target, 1)

    def rows_then_error():
        yield from lines(7, 9)
        raise OSError("gone")

    told = broken.write(lines(11))
    with pytest.raises(OSError):
        broken.write(rows_then_error())
    broken.abort([told, None], 1)
    assert not (tmp_path / "feed" / "batch=1").exists() and not (tmp_path / "feed" / "_pending").exists()


def test_a_stream_feeds_what_is_new_over_restarts(spark, tmp_path):
    def run(first, last):
        spark.range(first, last).select(F.col("id").alias("doc_id"), F.lit("k").alias("docket_id"), (F.col("id") % 9 > 0).alias("in_feed")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("doc_id long, docket_id string, in_feed boolean").parquet(str(tmp_path / "in"))
        incremental.stream_feed(stream, "document", str(tmp_path / "feed"), str(tmp_path / "cp")).awaitTermination()
        return sum(f.read_text().count('"_parent":"k"') for f in (tmp_path / "feed").glob("batch=*/*.txt"))

    assert run(0, 100) == 88 and run(100, 150) == 133
    docs = spark.range(200).select(F.col("id").alias("doc_id"))
    assert incremental.processed(docs, str(tmp_path / "feed"), "in_search_index").where("in_search_index").count() == 150


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def collection(spark, tmp_path):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "EPA").otherwise("FCC").alias("agency"), F.concat(F.lit("k"), F.col("id") % 5).alias("docket_id"), F.lit("s").alias("source"), F.lit("rule").alias("type"), F.when(F.col("id") % 11 == 0, True).alias("deleted"), F.struct(F.col("id").cast("string").alias("org"), F.lit("x" * 50).alias("text")).alias("details"),
        F.lit("yes").alias("scraped"), F.lit("2024-01-01").cast("date").alias("last_seen"), F.lit(1).alias("n_attachments"), F.lit(False).alias("failed_download"))
    write_collection(docs, "docs_of_test", path=str(tmp_path / "docs"), buckets=8)
    yield docs
    spark.sql("drop table docs_of_test")


def test_scans_by_scope_prune_files_and_columns(spark, collection):
    got = scan_docs(spark, "docs_of_test", agency="EPA", docket="k2", columns=("doc_id", "details.org"))
    assert rows(got) == sorted(((i, str(i)) for i in range(200) if i % 3 == 0 and i % 5 == 2 and i % 11), key=str)
    text = plan(got)
    assert "agency" in text.split("PartitionFilters:")[1].split("]")[0] and "EqualTo(docket_id,k2)" in text
    read = text.split("ReadSchema:")[1].split("\n")[0]
    assert "details:struct<org:string>" in read and "source" not in read and "type" not in read
    assert scan_docs(spark, "docs_of_test", deleted=True).count() == 200 and scan_docs(spark, "docs_of_test", agency="none").count() == 0


def test_joins_by_id_do_not_move_the_store(spark, collection):
    """Reconciling and inserting what is absent: the only exchange is that of the rows that come in."""
    dump = spark.range(100, 300).select(F.col("id").alias("doc_id"), F.lit("Posted").alias("status"), F.lit(1).alias("n_attachments"))
    store = scan_docs(spark, "docs_of_test", deleted=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = reconcile.reconcile(store, dump, F.lit("2024-06-01").cast("date"))
        assert plan(got).count("Exchange") == 1
        assert rows(got) == rows(reconcile.reconcile(collection, dump, F.lit("2024-06-01").cast("date")))
        fresh = dump.join(store.select("doc_id"), "doc_id", "left_anti")
        assert plan(fresh).count("Exchange") == 1 and fresh.count() == 100
        parent = store.select("doc_id", "agency").join(dump.select("doc_id", "status"), "doc_id", "left")
        assert plan(parent).count("Exchange") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_spreadsheets_of_several_files_have_their_own_headers(spark, tmp_path):
    def sheet(name, *lines):
        cells = lambda line: "".join(f"<Cell><Data>{x}</Data></Cell>" if x is not None else "<Cell></Cell>" for x in line)
        (tmp_path / name).write_text("<Table>" + "".join(f"<Row>{cells(line)}</Row>" for line in lines) + "</Table>")

    sheet("a.xml", ("First Name", "Zip"), ("Ann", "1"), (None, "2"))
    sheet("b.xml", ("Zip", " First  Name ", "Note"), ("3", "Bob", "x"), (None, None, None))
    got = readers.spreadsheet(spark, str(tmp_path)).collect()
    by_row = {}
    for r in got:
        by_row.setdefault(r["row_no"], {})[r["field"]] = r["value"]
    assert sorted(by_row.values(), key=str) == sorted([{"first_name": "Ann", "zip": "1"}, {"zip": "2"}, {"zip": "3", "first_name": "Bob", "note": "x"}], key=str)
