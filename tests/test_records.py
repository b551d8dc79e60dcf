"""Reconciling, views, normalising, sources, sinks and streams on small tables."""

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from docketlake.operators import entities, normalize, reconcile, resolve, stats, views
from docketlake.operators.components import connected_components
from docketlake.sources import readers, sinks
from docketlake.streaming import incremental


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_components_of_a_path_a_star_and_nothing(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, k) for k in range(101, 110)] + [(7, 7), (None, 3)]
    got = dict(rows(connected_components(spark.createDataFrame(links, "a long, b long"))))
    assert {got[i] for i in range(21)} == {0}
    assert {got[i] for i in range(100, 110)} == {100}
    assert rows(connected_components(spark.createDataFrame([], "a long, b long"))) == []


def test_reconcile(spark):
    store = spark.createDataFrame([("a", "yes", False, 1, 0, False), ("b", "failed", False, 1, 0, False), ("c", "yes", False, 1, 2, False), ("d", "yes", True, 1, 0, False), ("e", "yes", False, 1, 0, False), ("f", "yes", False, 9, 0, False)], "doc_id string, scraped string, deleted boolean, last_seen int, n_attachments int, failed_download boolean")
    dump = spark.createDataFrame([("a", None, None), ("b", None, 0), ("c", None, 1), ("d", None, 0), ("g", None, 0), ("h", "Withdrawn", 0), ("f", None, 5)], "doc_id string, status string, n_attachments int")
    got = rows(reconcile.reconcile(store, dump, F.lit(5)))
    assert got == [("a", "updated", False), ("b", "repaired", False), ("c", "repaired", False), ("d", "new", True), ("e", "deleted", False), ("g", "new", False)]


def test_merge_records_and_upserts(spark):
    r = spark.createDataFrame([(1, 1, "a", None), (1, 2, None, "y"), (2, 1, "b", "z")], "k int, o int, x string, y string")
    assert rows(reconcile.merge_records(r, "k", "o")) == [(1, "a", "y"), (2, "b", "z")]
    target = spark.createDataFrame([(1, "a", [1]), (2, "b", [1, 2])], "k int, scraped string, xs array<int>")
    new = spark.createDataFrame([(2, "no", [9]), (3, "no", [3])], "k int, scraped string, xs array<int>")
    assert rows(reconcile.insert_if_absent(target, new, "k", ("scraped", "xs"))) == [(1, "a", [1]), (2, "no", [9]), (3, "no", [3])]


def test_views(spark):
    kind = "doc_id int, views array<struct<url:string,type:string,downloaded:string,extracted:string>>"
    docs = spark.createDataFrame([(1, [("u", "pdf", "failed", "no"), ("v", "html", "yes", "failed_extraction")]), (2, [])], kind)
    assert rows(views.find_views(docs, lambda v: v["downloaded"] == "failed").select("doc_id", "view.url")) == [(1, "u")]
    new = spark.createDataFrame([(1, ("u", "pdf", "yes", "yes"))], "doc_id int, view struct<url:string,type:string,downloaded:string,extracted:string>")
    assert [v["url"] for v in views.replace_views(docs, new).where("doc_id = 1").first()["views"]] == ["v", "u"]
    assert [v["extracted"] for v in views.reset_failed(docs, "extracted").where("doc_id = 1").first()["views"]] == ["no", "no"]
    tries = spark.createDataFrame([("f", 1, False, None, "e1"), ("f", 2, True, "t", None), ("g", 1, False, None, "e"), ("g", 2, False, None, "last")], "file string, priority int, ok boolean, text string, error string")
    assert rows(views.first_successful(tries).select("file", "extracted", "text", "error")) == [("f", "yes", "t", None), ("g", "failed_extraction", None, "last")]


def test_entities(spark):
    texts = spark.createDataFrame([(1, "Acme Corp. and the Big Bank"), (2, "acme  CORPORATION"), (3, None)], "doc_id int, text string")
    aliases = spark.createDataFrame([("Acme Corp", "e1"), ("big bank", "e2"), ("the", "e3"), ("", "e4")], "alias string, entity_id string")
    black = spark.createDataFrame([("The",)], "alias string")
    assert rows(entities.match(texts, aliases, blacklist=black)) == [(1, "e1"), (1, "e2")]
    assert rows(entities.match(spark.createDataFrame([(1, "x " + " ".join("abcdefghijklmn"))], "doc_id int, text string"), spark.createDataFrame([(" ".join("abcdefghijklmn"), "e")], "alias string, entity_id string"))) == [(1, "e")]


def test_page_header_and_suppression(spark):
    lines = spark.createDataFrame([(1, 0, "12345"), (1, 1, "Federal Register / Vol. 77"), (1, 2, "999"), (2, 0, "Federal Register / Vol. 76")], "doc_id int, line_no int, line string")
    assert rows(resolve.page_header_citation(lines)) == [(1, "77 FR 12345")]
    docs = spark.createDataFrame([("a", "s", "rule", "2012-01"), ("b", "t", "rule", "2012-1")], "doc_id string, source string, type string, number string")
    got = resolve.apply_suppression(docs, resolve.suppressed_pairs(docs, "s", "t"))
    assert rows(got.select("doc_id", "replaces", "replaced_by")) == [("a", ["b"], []), ("b", [], ["a"])]
    assert rows(resolve.exclude_suppressed(got).select("doc_id")) == [("a",)]


def test_normalize_both_forms(spark):
    v3 = {"documentId": {"label": "ID", "value": "EPA-2012-0001-0002"}, "title": {"label": "Title", "value": "T"}, "docketId": "EPA-2012-0001", "documentType": "PS", "Posted": {"label": "Posted Date", "value": "2012-01-05"}, "comment": "hello", "commentOnDoc": {"documentId": "EPA-2012-0001-0001", "title": "R"}, "odd": {"label": "x"}}
    got = normalize.normalize_v3(spark.createDataFrame([(json.dumps(v3),)], "json string")).first()
    assert (got["doc_id"], got["title"], got["type"], got["comment_on"]["agency"]) == ("EPA-2012-0001-0002", "T", "public_submission", "EPA")
    assert got["details"]["Date_Posted"] == "2012-01-05"
    assert [v["content"] for v in got["views"]] == ["hello"]
    v1 = {"documentId": "D", "title": "T", "docketId": "K", "documentType": "Rule", "metadata": {"entry": {"@name": "RIN no.", "$": "5"}}}
    got = normalize.normalize_v1(spark.createDataFrame([(json.dumps(v1),)], "json string")).first()
    assert (got["type"], got["details"]) == ("rule", {"RIN_no_": "5"})


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "dump_all_0.json").write_text(json.dumps({"documents": [{"documentId": "a", "attachmentCount": 2}]}))
    (tmp_path / "dump_all_1.json").write_text(json.dumps({"searchresult": {"documents": {"document": {"documentId": "b"}}}}))
    assert rows(readers.search_dumps(spark, str(tmp_path)).select("documentId", "attachmentCount")) == [("a", 2), ("b", None)]
    (tmp_path / "c.csv").write_text('First Name,File Name,Comment Text\nA,,"one two three four\nfive six seven"\nB,x.pdf,\nC,NULL,short\n')
    (tmp_path / "side").mkdir()
    (tmp_path / "side" / "x.txt").write_text("l1 a b c\nl2 d e f\n")
    got = readers.attach_sidecars(readers.comment_csv(spark, str(tmp_path / "c.csv")), readers.text_sidecars(spark, str(tmp_path / "side")))
    assert rows(got.select("First Name", "text")) == [("A", "one two three four\nfive six seven"), ("B", "l1 a b c\n l2 d e f\n"), ("C", "")]
    (tmp_path / "words").write_text("apple\nParis\n")
    (tmp_path / "names").write_text("# note\n\nANNA\n")
    found = {r[0] for r in readers.word_list(spark, str(tmp_path / "words"), str(tmp_path / "names")).collect()}
    assert {"apple", "anna", "a", "z"} <= found and "Paris" not in found
    pages = spark.createDataFrame([(1, "<table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>2 &amp; 3</td></tr></table>"), (2, None)], "page_id long, html string")
    assert readers.html_tables(pages).first()["cells"] == {"A": "1", "B": "2 & 3"}
    sinks.write_csv(spark.createDataFrame([("a", None)], "x string, y string"), str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).first()["y"] == "\\N"
    with pytest.raises(Exception, match="null in document_id"):
        sinks.checked(spark.createDataFrame([(None, "e")], "document_id string, entity_id string"), sinks.SCHEMAS["submitter_matches"]).collect()


def test_streamed_statistics_equal_a_batch_run(spark, tmp_path):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), (F.col("id") % 7).alias("docket_id"), F.when(F.col("id") % 10 > 0, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int"))).alias("date_posted"), F.lit("notice").alias("type"), F.lit(None).cast("string").alias("dup_count"))
    for k in range(3):
        docs.where(F.col("doc_id") % 3 == k).write.mode("append").parquet(str(tmp_path / "in"))
        feed = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        incremental.stream_histogram(feed, str(tmp_path / "weeks"), str(tmp_path / "cp")).awaitTermination()
    assert rows(incremental.stored(spark, str(tmp_path / "weeks"))) == rows(stats.weeks(docs, "docket_id"))
    feed = spark.readStream.schema("doc_id long, docket_id long, status string").parquet(str(tmp_path / "in"))
    incremental.stream_new(feed, str(tmp_path / "new"), str(tmp_path / "cp2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "new")).count() == 100


def test_statistics_leave_out_flagged_rows_and_keep_two_versions(spark, tmp_path):
    kind = "doc_id long, docket_id long, date_posted date, type string, in_aggregates boolean"
    for k in range(4):
        spark.range(10).select((F.col("id") + 10 * k).alias("doc_id"), (F.col("id") % 3).alias("docket_id"), F.lit("2024-01-01").cast("date").alias("date_posted"), F.lit("notice").alias("type"), (F.col("id") == 0).alias("in_aggregates")).write.mode("append").parquet(str(tmp_path / "in"))
        feed = spark.readStream.schema(kind).parquet(str(tmp_path / "in"))
        incremental.stream_histogram(feed, str(tmp_path / "weeks"), str(tmp_path / "cp")).awaitTermination()
    assert incremental.stored(spark, str(tmp_path / "weeks")).agg(F.sum("n")).first()[0] == 36
    versions = [p.parent.name for p in (tmp_path / "weeks").glob("in_bucket=*/by_batch=*")]
    assert versions and all(versions.count(b) == 2 for b in versions)
    docs = spark.range(50).select(F.col("id").alias("doc_id"), (F.col("id") == 0).alias("in_aggregates"))
    flagged = incremental.processed(docs, str(tmp_path / "weeks"), "in_aggregates").where("in_aggregates")
    assert {r["doc_id"] for r in flagged.collect()} == {i for i in range(40) if i % 10} | {0}


def test_a_batch_that_runs_again_replaces_its_own_work(spark, tmp_path):
    run = incremental.merge_into(str(tmp_path / "t"), lambda d: stats.weeks(d, "docket_id"), stats.merge_histograms)
    one = spark.createDataFrame([(1, 7, "notice")], "doc_id long, docket_id long, type string").withColumn("date_posted", F.lit("2024-01-01").cast("date"))
    run(one, 0)
    run(one, 1)
    run(one, 1)
    assert incremental.stored(spark, str(tmp_path / "t")).agg(F.sum("n")).first()[0] == 2


def test_harvest_against_a_store(spark, tmp_path):
    store = spark.createDataFrame([(1, "2024-03-10"), (2, "2024-03-01")], "doc_id long, d string").select("doc_id", F.col("d").cast("date").alias("date_posted"))
    first = [(1, "2024-03-10", None), (3, "2024-03-09", None), (3, "2024-03-09", None), (4, "2024-03-08", None), (5, "2024-03-12", "Withdrawn"), (6, None, None)]
    kind = "doc_id long, date_posted date, status string"
    for rows_ in (first, [(3, "2024-03-09", None), (7, "2024-03-11", None)]):
        spark.createDataFrame(rows_, "doc_id long, d string, status string").select("doc_id", F.col("d").cast("date").alias("date_posted"), "status").write.mode("append").parquet(str(tmp_path / "in"))
        feed = spark.readStream.schema(kind).parquet(str(tmp_path / "in"))
        incremental.stream_new(feed, str(tmp_path / "new"), str(tmp_path / "cp"), known=lambda s: store).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "new")).select("doc_id")) == [(3,), (6,), (7,)]


def test_tagging_and_feed_of_what_is_not_done(spark, tmp_path):
    aliases = spark.createDataFrame([("Acme Corp", "e1")], "alias string, entity_id string")
    texts = spark.createDataFrame([(1, "Acme Corp.", None), (2, "acme corp", "2024-01-01"), (3, "else", None)], "doc_id long, text string, t string").select("doc_id", "text", F.col("t").cast("timestamp").alias("entities_last_extracted"))
    texts.write.parquet(str(tmp_path / "in"))
    incremental.stream_matches(spark.readStream.schema(texts.schema).parquet(str(tmp_path / "in")), aliases, str(tmp_path / "tags"), str(tmp_path / "cp")).awaitTermination()
    assert rows(incremental.stored(spark, str(tmp_path / "tags"))) == [(1, "e1")]
    assert {r["doc_id"] for r in incremental.processed(texts.select("doc_id"), str(tmp_path / "tags"), "done").where("done").collect()} == {1, 3}
    records = spark.range(450).select(F.col("id").cast("string").alias("doc_id"), F.lit("k").alias("docket_id"), (F.col("id") % 9 > 0).alias("in_feed"), (F.col("id") >= 440).alias("in_search_index")).coalesce(1)
    records.write.parquet(str(tmp_path / "records"))
    feed = spark.readStream.schema(records.schema).parquet(str(tmp_path / "records"))
    incremental.stream_feed(feed, "document", str(tmp_path / "feed"), str(tmp_path / "cp2")).awaitTermination()
    files = list((tmp_path / "feed" / "batch=0").glob("*.txt"))
    assert len(files) == 2 and sum(f.read_text().count('"_parent":"k"') for f in files) == 391
    assert incremental.processed(records, str(tmp_path / "feed"), "in_search_index").where("in_search_index").count() == 450


def test_export_relations(spark, tmp_path):
    docs = spark.createDataFrame([("a", "k", "EPA", None, None, False, {"First_Name": "A", "Last_Name": "B", "Date_Posted": "2024-01-02"}, None), ("b", "k", "EPA", "T", "rule", True, {}, None)], "doc_id string, docket_id string, agency string, title string, type string, deleted boolean, details map<string,string>, comment_on struct<document_id:string,title:string,type:string>")
    got = sinks.checked(normalize.export_metadata(docs), sinks.SCHEMAS["comments_full"]).collect()
    assert [(r["document_id"], r["title"], r["submitter_name"], r["on_id"], str(r["date_posted"]), r["date_due"]) for r in got] == [("a", "", "A B", "", "2024-01-02", None)]
    assert normalize.export_metadata(docs.union(docs), limit=1).count() == 1
    assert normalize.export_metadata(docs, {"x": F.col("title")}).columns == ["x"]
    long = normalize.export_metadata(docs.withColumn("agency", F.lit("NINECHARS")))
    with pytest.raises(Exception, match="over 8 characters in agency"):
        sinks.checked(long, sinks.SCHEMAS["comments_full"]).collect()
    dockets = spark.createDataFrame([("k", "T", "EPA", 2012, "yes"), ("l", "T", "EPA", 2012, "no")], "docket_id string, title string, agency string, year int, scraped string")
    sinks.export_dockets(dockets, str(tmp_path / "dockets"))
    assert [r["docket_id"] for r in spark.read.csv(str(tmp_path / "dockets"), header=True).collect()] == ["k"]
    with pytest.raises(Exception, match="null in document_id"):
        sinks.checked(spark.createDataFrame([(None, "k", "E", None, "t")], "document_id string, docket_id string, agency string, date date, text string"), sinks.SCHEMAS["comments"]).collect()


def test_bulk_text(spark, tmp_path):
    view = "struct<url:string,file_path:string,extracted:string,content:string>"
    docs = spark.createDataFrame([("d1", "k", "EPA", "T", "", [("u1", "/x/a.pdf", "yes", "one"), ("u2", None, "no", None)], [([("u3", "/y/b.c.doc", "yes", "two")],)])], f"doc_id string, docket_id string, agency string, title string, rin string, views array<{view}>, attachments array<struct<views:array<{view}>>>")
    dockets = spark.createDataFrame([("k", "EPA", "D", None)], "docket_id string, agency string, title string, year int")
    sinks.export_bulk_text(docs, dockets, str(tmp_path))
    read = lambda name: spark.read.json(str(tmp_path / name)).collect()
    assert [json.loads(r["metadata"]) for r in read("dockets")] == [{"docket_id": "k", "title": "D", "agency": "EPA"}]
    assert [json.loads(r["metadata"]) for r in read("documents")] == [{"doc_id": "d1", "title": "T", "agency": "EPA", "docket_id": "k", "files": [{"url": "u1", "filename": "view_a_pdf.txt"}, {"url": "u2"}, {"url": "u3", "filename": "attachment_b_c_doc.txt"}]}]
    assert sorted((r["entry"], r["text"]) for r in read("texts")) == [("attachment_b_c_doc.txt", "two"), ("view_a_pdf.txt", "one")]


def test_older_form_views_and_attachments(spark):
    v1 = {"documentId": "D", "title": "T", "docketId": "K", "documentType": "Rule", "commentText": "c", "topics": ["x", ""], "fileFormats": "http://h/a?contentType=pdf", "attachments": {"attachment": {"title": "A", "fileFormats": ["http://h/b?contentType=pdf", "http://h/c?contentType=html"]}}}
    got = normalize.normalize_v1(spark.createDataFrame([(json.dumps(v1),), (json.dumps({"documentId": "E"}),)], "json string")).orderBy("doc_id").collect()
    assert (got[0]["abstract"], got[0]["topics"], [v["url"] for v in got[0]["views"]]) == ("c", ["x"], ["http://h/a?contentType=pdf"])
    assert [(a["title"], a["abstract"], [v["url"] for v in a["views"]]) for a in got[0]["attachments"]] == [("A", "", ["http://h/b?contentType=pdf", "http://h/c?contentType=html"])]
    assert (got[1]["views"], got[1]["attachments"], got[1]["comment_on"]) == ([], [], None)


def test_docket_years_take_the_first_four_digits(spark):
    got = normalize.normalize_docket(spark.createDataFrame([(json.dumps({"docketId": "EPA-2012-1999-0001"}),), (json.dumps({"docketId": {"value": "EPA"}}),)], "json string"))
    assert rows(got.select("docket_id", "year")) == [("EPA", None), ("EPA-2012-1999-0001", 2012)]


def test_spreadsheet_records(spark):
    cells = spark.createDataFrame([(1, "when", "01/02/2013"), (1, "ok", "Y"), (1, "note", "hi"), (1, "file", 'of:=HYPERLINK("http://x/a";"A (1)")'), (2, "note", "N/A")], "row_no long, field string, value string")
    got = {r["row_no"]: r for r in readers.spreadsheet_records(cells).collect()}
    assert str(got[1]["fields"]["when"]["date"]) == "2013-01-02" and got[1]["fields"]["ok"]["flag"] is True and got[1]["fields"]["note"]["text"] == "hi"
    assert [tuple(x) for x in got[1]["documents"]] == [("http://x/a", "A (1)")] and got[2]["documents"] == []
    with pytest.raises(Exception, match="not a link"):
        readers.spreadsheet_records(spark.createDataFrame([(1, "f", "of:=SUM(1)")], "row_no long, field string, value string")).collect()


def test_places_of_rules_in_large_dockets(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), (F.col("id") % 2 + F.when(F.col("id") > 250, 1).otherwise(0)).alias("docket_id"), F.when(F.col("id") % 9 > 0, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 11).cast("int"))).alias("date_posted"), F.lit("rule").alias("type"))
    want = stats.recent(docs, "docket_id", 1 << 30).select("doc_id", "rank")
    assert rows(stats.fr_docs(docs, "docket_id").select("doc_id", "rank")) == rows(want)
    assert rows(stats.fr_docs(docs.limit(0), "docket_id")) == []


def test_articles_without_date_or_agency(spark):
    docs = spark.createDataFrame([(1, "a rule on air and water", "EPA", "2024-01-01"), (2, "a rule on air and water", None, "2024-01-01"), (3, "a rule on air and water", "EPA", None), (4, "a rule on air and water", None, None), (5, "short", None, None)], "doc_id int, title string, agency string, d string")
    articles = spark.createDataFrame([(10, "a rule on air and waters", "EPA", "2024-02-01"), (11, "a rule on air and water", "FCC", "2024-01-20"), (12, "a rule on air and water", "EPA", None), (13, "a rule on air and water", "EPA", "2023-01-01")], "article_id int, title string, agency string, d string")
    dated = lambda df: df.withColumn("date_posted", F.col("d").cast("date"))
    assert rows(resolve.guess_article(dated(docs), dated(articles)).select("doc_id", "article_id", "days_apart")) == [(1, 10, 31), (2, 11, 19), (3, 12, None), (4, 11, None)]


def test_best_articles_are_those_of_all_pairs_and_questions_are_asked_once(spark, monkeypatch):
    kept = {}
    real = resolve.written
    monkeypatch.setattr(resolve, "written", lambda df, label, keep=False: kept.setdefault(label, real(df, label)) if label == "asked" else real(df, label))
    rnd = random.Random(5)
    start = datetime.date(2024, 1, 1)

    def row(i):
        title = " ".join(rnd.choice(["old", "new", "rule", "notice on", "plate"]) for _ in range(rnd.randrange(2, 6)))
        return i, None if rnd.random() < 0.1 else title, rnd.choice(["A", "B", None]), rnd.choice([None, *(start + datetime.timedelta(days=rnd.randrange(300)) for _ in range(4))]), rnd.choice(["x", "y", None])

    docs, articles = [row(i) for i in range(60)], [row(i) for i in range(60)]
    docs += [(100 + i, *r[1:]) for i, r in enumerate(docs)]  # each twice
    kind = "long, title string, agency string, date_posted date, citation string"
    d, a = spark.createDataFrame(docs, f"doc_id {kind}").cache(), spark.createDataFrame(articles, f"article_id {kind}").cache()
    both = d.alias("d").crossJoin(a.select("article_id", F.col("title").alias("t"), F.col("agency").alias("g"), F.col("date_posted").alias("p"), F.col("citation").alias("c")))
    both = both.withColumn("s", resolve.levenshtein_ratio("title", "t")).withColumn("apart", F.abs(F.datediff("date_posted", "p")))
    met = both.where("(agency is null or agency = g) and (date_posted is null or apart <= 90) and length(title) >= 10 and length(t) >= 10 and s > 0.75")
    best = met.groupBy("doc_id").agg(F.min(F.struct("apart", -F.col("s"), "article_id")).alias("m")).collect()
    want = sorted((r["doc_id"], r["m"]["article_id"], -r["m"][1], r["m"]["apart"]) for r in best)
    assert sorted(tuple(r) for r in resolve.guess_article(d, a).collect()) == want
    assert kept["asked"].count() == len({r[1:4] for r in docs if len(r[1] or "") >= 10})
    kept.clear()
    best = both.where("citation = c").groupBy("doc_id").agg(F.min(F.struct(F.col("s").isNull(), -F.col("s"), "article_id")).alias("m")).collect()
    assert sorted(tuple(r) for r in resolve.article_by_citation(d, a).collect()) == sorted((r["doc_id"], r["m"]["article_id"]) for r in best)
    assert kept["asked"].count() == len({(r[1], r[4]) for r in docs if r[4]})


def test_annotating_broadcasts_no_table_that_grows(spark, monkeypatch):
    """Files of repeated titles are small, their rows are not: no join of documents and articles gathers one side in the driver."""
    plans = []
    real = resolve.written
    monkeypatch.setattr(resolve, "written", lambda df, label, keep=False: plans.append(df) or real(df, label))
    day = datetime.date(2024, 1, 1)
    kind = "long, title string, agency string, date_posted date, number string, citation string"
    docs = spark.createDataFrame([(1, "a rule on air", "A", day, "n1", "c1", "c2"), (2, "a rule on air", "A", day, None, "c1", "c2"), (3, "a rule on air", None, None, None, None, "c2"), (4, "a rule on airs", "A", day, "n9", None, None), (5, "a rule on airs", "A", None, None, None, "c9")], f"doc_id {kind}, text_citation string")
    articles = spark.createDataFrame([(10, "a rule on air", "A", day, "n0", "c0"), (11, "other", "B", day, "n1", "c9x"), (12, "a rule on air", "B", day, "n1", "c1"), (13, "a ruling", "B", day, None, "c2")], f"article_id {kind}")
    got = resolve.annotate(docs, articles)
    assert rows(got) == [(1, 11, "number"), (2, 12, "citation"), (3, 13, "text"), (4, 10, "title"), (5, None, "none")]
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in [*plans, got]]
    assert any("SortMergeJoin" in p for p in plans) and not [p for p in plans if "Broadcast" in p]


def test_submitters_do_not_cross_parts(spark):
    docs = spark.createDataFrame([(1, {"Organization_Name": "Acme Corp"}, "x", "s", "other"), (2, {"Organization_Name": "Acme", "Last_Name": "Corp"}, "x", "s", "other"), (3, {}, "Comment from Acme Corp", "s", "rule"), (4, {}, "Acme Corp letter", "s", "other"), (5, {}, "Acme Corp letter", "t", "other"), (6, None, None, None, None)], "doc_id int, details map<string,string>, title string, source string, type string")
    aliases = spark.createDataFrame([("Acme Corp", "e1")], "alias string, entity_id string")
    assert rows(entities.submitter_matches(docs, aliases, title_source="s")) == [(1, "e1"), (3, "e1"), (4, "e1")]


def test_partitions_of_mentions_grow_with_the_rows_not_the_setting(spark, tmp_path):
    from docketlake import session

    spark.range(1000).write.parquet(str(tmp_path / "t"))
    read = spark.read.parquet(str(tmp_path / "t"))
    assert session.spread(read, read, "id", rows=100).rdd.getNumPartitions() == 10
    assert session.spread(read, read, "id").rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
