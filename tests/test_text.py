import pytest
from pyspark.sql import functions as F

from docketlake.functions import text as t
from docketlake.operators import normalize
from docketlake.plans import queries_streams


def value(spark, column, **given):
    names = list(given)
    df = spark.createDataFrame([tuple(given[n] for n in names)], ", ".join(f"{n} string" for n in names))
    return df.select(column).first()[0]


@pytest.mark.parametrize(("raw", "expected"), [("", ""), ("no marker", "no marker"), ("a Comment: hello", "hello"), ("Comment ****** hi\nthere ==== Attachments", "hi\nthere"), ("Comments:x\n===\nrest", "x")])
def test_extract_comment(spark, raw, expected):
    assert value(spark, t.extract_comment("x"), x=raw) == expected


def test_levenshtein_ratio(spark):
    assert value(spark, t.levenshtein_ratio("x", "y"), x="abcd", y="abce") == pytest.approx(7 / 8)
    assert value(spark, t.levenshtein_ratio("x", "y"), x="", y="") == 1.0
    assert value(spark, t.levenshtein_ratio("x", "y"), x=None, y="a") is None


def test_crockford_has_26_letters(spark):
    got = value(spark, t.crockford_hash("x"), x="abc")
    assert len(got) == 26
    assert set(got) <= set(t.CROCKFORD)


def test_dates_and_numbers(spark):
    assert str(value(spark, t.parse_posted_date("x"), x="January 05 2012, at 02:30 PM Eastern Standard Time")) == "2012-01-05 19:30:00"
    assert value(spark, t.parse_posted_date("x"), x="soon") is None
    assert value(spark, t.docket_year("x"), x="EPA-HQ-2009-0001") == 2009
    assert value(spark, t.trim_fr_number("x"), x="2012-00123") == "2012-123"
    assert value(spark, t.bulk_count("x"), x="Comments of 1,234 individuals") == 1234
    assert value(spark, t.is_us_date("x"), x=None) is False


def test_markup(spark):
    assert value(spark, t.html_is_empty("x"), x="<html><body><p>&nbsp;</p></body></html>") is True
    assert value(spark, t.html_is_empty("x"), x="<html><body><p>a</p></body></html>") is False
    assert value(spark, t.html_is_empty("x"), x="no body") is True
    assert value(spark, t.remove_control_chars("x"), x="a\x07\tb\nc\x7f") == "ab\nc"
    assert value(spark, t.ocr_scrub("x"), x="good line\n##%%$$") == "good line"
    assert value(spark, t.ocr_scrub("x"), x="######\n######\nab") is None


def test_names_and_releases(spark):
    assert value(spark, t.normalize_agency_name("x"), x="OFFICE OF R&D  AND THE REST") == "Office of R & D and the Rest"
    m = value(spark, t.parse_release_meta("x"), x="Release Nos. 34-1, 34-2; File No. S7-1 and S7-2")
    assert m == {"Release": ["34-1", "34-2"], "File": ["S7-1", "S7-2"]}
    got = value(spark, t.parse_listing_line("x"), x="Memorandum of a meeting, Mar. 5, 2010 (memo.pdf)")
    assert (got["title"], got["date"], got["attachment"], got["is_meeting"]) == ("Memorandum of a meeting", "Mar. 5, 2010", "memo.pdf", True)
    assert value(spark, t.full_name("x", "y", "z"), x="A", y="", z="B") == "A B"


def test_expanded_count(spark):
    rows = [("public_submission", "3"), ("public_submission", "12.5"), ("public_submission", None), ("notice", "9"), ("public_submission", " 12 ")]
    df = spark.createDataFrame(rows, "k string, n string")
    assert [r[0] for r in df.select(t.expanded_count("k", "n")).collect()] == [3, 1, 1, 0, 12]


def test_held_stops_recomputation(spark):
    df = spark.createDataFrame([("a b c",)], "t string").select(t.held(t.words("t")).alias("w")).where(F.size("w") > 2)
    assert df.first()[0] == ["a", "b", "c"]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_scrubbed_text_is_split_once(spark):
    texts = [" ab c \t\n12\nxy1\r\n\nde fg hi", "1234\nab", "", None, "é é\nab cd ef\x0b", "ab\n" * 3]
    df = spark.createDataFrame([(x,) for x in texts], "x string").select(F.md5(t.ocr_scrub("x")).alias("d"), t.ocr_scrub("x").alias("s"))
    assert [r["s"] for r in df.collect()] == ["ab c\nxy1\nde fg hi", None, None, None, "ab cd ef", "ab\nab\nab"]
    assert _plan(df.select("d")).count("split(") == 1


def test_a_record_is_parsed_once_not_for_every_field(spark):
    raw = '{"documentId":"A-1","a":{"label":"Posted Date","value":"1"},"b":{"label":"Date Posted","value":"2"},"c":{"label":"Title","value":"t"},"d":{"x":1},"e":"f"}'
    df = normalize.normalize_v3(spark.createDataFrame([(raw,)], "json string"))
    assert df.first()["details"] == {"Date_Posted": "2", "Title": "t"}
    assert _plan(df).count("$.label") == 1


def test_a_streams_files_follow_its_rows(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(queries_streams, "scratch", lambda spark, label: str(tmp_path / label))
    rows = spark.range(100).withColumnRenamed("id", "doc_id")
    queries_streams._batches(spark, rows, rows, 4, 10)
    assert len(list((tmp_path / "feed").glob("*.parquet"))) == 10
    assert spark.read.parquet(str(tmp_path / "feed")).distinct().count() == 100
