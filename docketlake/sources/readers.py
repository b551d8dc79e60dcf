"""Readers of the harvest's files. Every schema is given; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.functions.text import coerce_cell

RESULT = "struct<documentId:string,title:string,docketId:string,agencyAcronym:string,documentType:string,documentStatus:string,attachmentCount:int>"


def search_dumps(spark: SparkSession, folder: str, scope: str = "all") -> DataFrame:
    """Results of the page files dump_<scope>_<position>.json, in either form; no such file is an error."""
    raw = spark.read.text(f"{folder}/dump_{scope}_*.json", wholetext=True)
    new = F.from_json(F.get_json_object("value", "$.documents"), f"array<{RESULT}>")
    old = F.get_json_object("value", "$.searchresult.documents.document")
    old = F.from_json(F.when(F.startswith(old, F.lit("[")), old).otherwise(F.concat(F.lit("["), old, F.lit("]"))), f"array<{RESULT}>")
    return raw.select(F.explode(F.coalesce(new, old)).alias("r")).select("r.*")


def comment_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a comment table with a header; quoted fields may hold line breaks."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"')


def text_sidecars(spark: SparkSession, folder: str) -> DataFrame:
    """(stem, text) of one text file an attachment; lines keep their line feed and are joined by a space."""
    raw = spark.read.text(folder, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[^.]*)?$", 1).alias("stem"), "value")
    return raw.select("stem", F.regexp_replace("value", r"\n(?=.)", "\n ").alias("text"))


def attach_sidecars(rows: DataFrame, sidecars: DataFrame, file: str = "File Name", inline: str = "Comment Text") -> DataFrame:
    """Rows with ``text``: the inline text where no file is named (empty or NULL), else the file's; less than six parts by non-word
    characters count as no text."""
    named = F.coalesce(F.col(f"`{file}`"), F.lit(""))
    stem = F.regexp_replace(named, r"\.?pdf$", "")
    joined = rows.withColumn("_stem", F.when(~named.isin("", "NULL"), stem)).join(sidecars.withColumnRenamed("text", "_text"), F.col("_stem") == F.col("stem"), "left")
    text = F.coalesce(F.when(F.col("_stem").isNull(), F.col(f"`{inline}`")).otherwise(F.col("_text")), F.lit(""))
    return joined.withColumn("text", F.when(F.size(F.split(text, r"\W+")) > 5, text).otherwise("")).drop("_stem", "stem", "_text")


def record_map(spark: SparkSession, path: str, record: str) -> DataFrame:
    """(id, fields of the record) of JSON objects from id to record; record: its struct type."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.explode(F.from_json("value", f"map<string,{record}>")).alias("id", "r")).select("id", "r.*")


def record_list(spark: SparkSession, path: str, record: str) -> DataFrame:
    """Records of JSON arrays, with the stem of the file that they stand in."""
    raw = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[^.]*)?$", 1).alias("stem"), "value")
    return raw.select("stem", F.explode(F.from_json("value", f"array<{record}>")).alias("r")).select("stem", "r.*")


def with_optional_records(dockets: DataFrame, records: DataFrame) -> DataFrame:
    """Dockets with the records of their own file; a docket without a file has none."""
    return dockets.join(records, dockets.docket_id == records.stem, "left").drop("stem")


def word_list(spark: SparkSession, dictionary: str, names: str | None = None) -> DataFrame:
    """(word): dictionary entries that begin with a small letter, names without comment lines, and the single letters."""
    words = spark.read.text(dictionary).where(F.col("value").rlike("^[a-z]")).select(F.trim("value").alias("word"))
    if names:
        more = spark.read.text(names).where(~F.startswith("value", F.lit("#")) & (F.trim("value") != "")).select(F.lower(F.trim("value")).alias("word"))
        words = words.unionByName(more)
    letters = spark.range(26).select(F.char(F.col("id") + 97).alias("word"))
    return words.unionByName(letters).distinct()


def spreadsheet(spark: SparkSession, path: str, row_tag: str = "Row") -> DataFrame:
    """(row_no, field, value) of the XML rows of a spreadsheet, or of several: each file's first row names its fields, rows without data are dropped."""
    rows = spark.read.format("xml").option("rowTag", row_tag).schema("Cell array<struct<Data:string,_Formula:string>>").load(path)
    numbered = rows.select("Cell", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row_no"))
    first = numbered.groupBy("file").agg(F.min(F.struct("block", "row_no", "Cell")).alias("top")).select("file", F.col("top.row_no").alias("top"), F.posexplode("top.Cell").alias("pos", "c"))
    names = first.select("file", "top", "pos", F.lower(F.regexp_replace(F.trim("c.Data"), r"\s+", "_")).alias("field"))
    cells = numbered.select("file", "row_no", F.posexplode("Cell").alias("pos", "c")).select("file", "row_no", "pos", F.coalesce("c._Formula", "c.Data").alias("value"))
    given = cells.where("value is not null and trim(value) <> ''").join(names, ["file", "pos"])
    return given.where(F.col("row_no") != F.col("top")).select("row_no", "field", "value")


def spreadsheet_records(cells: DataFrame) -> DataFrame:
    """(row_no, fields, documents) of a spreadsheet's cells: values by field as date, flag or text, and the linked documents (url, title) in the order of
    their fields. A formula that is no link is an error."""
    c = cells.select("row_no", "field", coerce_cell("value").alias("c"), F.col("value").rlike(r"^(?:of:)?=").alias("formula"))
    link = F.when(F.col("c.url").isNotNull(), F.struct("field", "c.url", "c.title")).when(F.col("formula"), F.raise_error(F.concat(F.lit("not a link: "), F.col("c.text"))))
    plain = F.when(~F.col("formula"), F.struct("field", F.struct("c.date", "c.flag", F.when(F.col("c.date").isNull() & F.col("c.flag").isNull(), F.col("c.text")).alias("text")).alias("value")))
    rows = c.select("row_no", link.alias("link"), plain.alias("plain")).groupBy("row_no").agg(F.collect_list("plain").alias("p"), F.sort_array(F.collect_list("link")).alias("l"))
    return rows.select("row_no", F.map_from_entries("p").alias("fields"), F.transform("l", lambda x: F.struct(x["url"].alias("url"), x["title"].alias("title"))).alias("documents"))


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id) of a file with one id a line."""
    return spark.read.text(path).select(F.trim("value").alias("doc_id")).where("doc_id <> ''").distinct()


def html_tables(pages: DataFrame) -> DataFrame:
    """(page_id, table_no, row_no, cells: map from header to cell) of the tables of each page; nested tables are read as text."""
    from collections.abc import Iterator
    from html.parser import HTMLParser

    import pandas as pd

    class Tables(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.tables, self.depth, self.cell = [], 0, None

        def handle_starttag(self, tag, attrs):
            if tag == "table":
                self.depth += 1
                if self.depth == 1:
                    self.tables.append([])
            elif self.depth == 1 and tag == "tr":
                self.tables[-1].append([])
            elif self.depth == 1 and tag in ("td", "th") and self.tables[-1]:
                self.cell = []
                self.tables[-1][-1].append(self.cell)

        def handle_endtag(self, tag):
            if tag == "table" and self.depth:
                self.depth -= 1
            elif self.depth == 1 and tag in ("td", "th", "tr"):
                self.cell = None

        def handle_data(self, data):
            if self.cell is not None:
                self.cell.append(data)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for page_id, html in zip(frame["page_id"], frame["html"], strict=True):
                parser = Tables()
                parser.feed(html or "")
                for t, rows in enumerate(parser.tables):
                    texts = [[" ".join("".join(c).split()) for c in r] for r in rows if r]
                    for k, r in enumerate(texts[1:]):
                        out.append((page_id, t, k, dict(zip(texts[0], r, strict=False))))
            yield pd.DataFrame(out, columns=["page_id", "table_no", "row_no", "cells"])

    return pages.select("page_id", "html").mapInPandas(run, "page_id long, table_no int, row_no int, cells map<string,string>")
