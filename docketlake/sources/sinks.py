"""Sinks: flat export tables, cluster tables, bulk text, and the search feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketlake.functions.text import escape_export
from docketlake.operators.normalize import truthy_json


def _relation(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, T.VarcharType(kind) if isinstance(kind, int) else kind, not required) for name, kind, required in fields])


# The target relations of the export with the longest value of each text column and whether it must be given.
SCHEMAS = {
    "comments": _relation(("document_id", 32, True), ("docket_id", 32, True), ("agency", 8, True), ("date", T.DateType(), False), ("text", T.StringType(), True)),
    "comments_full": _relation(
        ("document_id", 64, True),
        ("docket_id", 64, True),
        ("agency", 8, True),
        ("date_posted", T.DateType(), False),
        ("date_due", T.DateType(), False),
        ("title", 512, True),
        ("type", 32, False),
        ("org_name", 255, True),
        ("submitter_name", 255, True),
        ("on_type", 32, False),
        ("on_id", 64, True),
        ("on_title", 512, True),
    ),
    "dockets": _relation(("docket_id", 64, True), ("title", 512, True), ("agency", 8, True), ("year", T.ShortType(), False)),
    # the relations let every column of a match be null; one without its document or entity is an error here
    "text_matches": _relation(("document_id", 64, True), ("object_id", 32, False), ("file_type", 16, False), ("view_type", 16, False), ("entity_id", T.StringType(), True)),
    "submitter_matches": _relation(("document_id", 64, True), ("entity_id", T.StringType(), True)),
}


def checked(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` cast to the relation's columns; when it is written, a null where a value must be given and a text that is too long are errors."""

    def value(f: T.StructField):
        if isinstance(f.dataType, T.VarcharType):
            c = F.col(f.name).cast("string")
            c = F.when(F.length(c) > f.dataType.length, F.raise_error(F.lit(f"over {f.dataType.length} characters in {f.name}"))).otherwise(c)
        else:
            c = F.col(f.name).cast(f.dataType)
        return (c if f.nullable else F.when(c.isNull(), F.raise_error(F.lit(f"null in {f.name}"))).otherwise(c)).alias(f.name)

    return df.select(*(value(f) for f in schema.fields))


def as_text(df: DataFrame) -> DataFrame:
    """All columns in export form: null as backslash N, times as text, a backslash and dot as a dot."""
    return df.select(*(escape_export(c).alias(c) for c in df.columns))


def write_csv(df: DataFrame, path: str) -> None:
    as_text(df).write.csv(path, header=True, escape='"', mode="overwrite")


def export_tables(metadata: DataFrame, text_matches: DataFrame, submitter_matches: DataFrame, folder: str) -> None:
    for name, df in (("comments_full", metadata), ("text_matches", text_matches), ("submitter_matches", submitter_matches)):
        write_csv(checked(df, SCHEMAS[name]), f"{folder}/{name}")


def export_dockets(dockets: DataFrame, path: str) -> None:
    write_csv(checked(dockets.where("scraped = 'yes'"), SCHEMAS["dockets"]), path)


def cluster_table(ranking: DataFrame, clusters: DataFrame, docs: DataFrame) -> DataFrame:
    """(number, document fields) of the documents of ranked clusters."""
    return clusters.join(ranking.select("cluster_id", "number"), "cluster_id").join(docs, "doc_id").drop("cluster_id")


def doc_table(docs: DataFrame) -> DataFrame:
    """Documents for a flat export, in order of id within range partitions."""
    return docs.select("doc_id", "title", "url", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")


#: Fields of the metadata of dockets and documents in the bulk export; those that are missing or empty are left out.
DOCKET_FIELDS = ("docket_id", "title", "agency", "rin", "details", "year")
DOCUMENT_FIELDS = ("doc_id", "title", "agency", "docket_id", "type", "topics", "details", "comment_on", "rin")


def bulk_parts(docs: DataFrame, dockets: DataFrame) -> dict[str, DataFrame]:
    """The bulk export's tables, each with agency and docket_id: ``dockets`` and ``documents`` with their metadata as JSON, a document's with its files
    (url, and the name where there is text), and ``texts`` with an entry for each extracted view of a document or of its attachments."""
    entry = lambda kind: lambda v: F.struct(F.lit(kind).alias("kind"), v["url"].alias("url"), v["file_path"].alias("file_path"), (v["extracted"] == "yes").alias("extracted"), v["content"].alias("text"))
    views = F.concat(F.transform("views", entry("view")), F.flatten(F.transform(F.coalesce("attachments", F.array()), lambda a: F.transform(a["views"], entry("attachment")))))
    stem = lambda v: F.concat(v["kind"], F.lit("_"), F.translate(F.element_at(F.split(v["file_path"], "/"), -1), ".", "_"), F.lit(".txt"))
    files = F.transform("_views", lambda v: F.struct(v["url"].alias("url"), F.when(v["extracted"], stem(v)).alias("filename")))
    given = docs.withColumn("_views", views).withColumn("files", files)
    known = lambda df, fields: [c for c in fields if c in df.columns]
    texts = given.select("agency", "docket_id", "doc_id", F.explode("_views").alias("v")).where("v.extracted")
    return {
        "dockets": dockets.select("agency", "docket_id", truthy_json(dockets, known(dockets, DOCKET_FIELDS)).alias("metadata")),
        "documents": given.select("agency", "docket_id", "doc_id", truthy_json(given, [*known(given, DOCUMENT_FIELDS), "files"]).alias("metadata")),
        "texts": texts.select("agency", "docket_id", "doc_id", stem(F.col("v")).alias("entry"), F.col("v.text").alias("text")),
    }


def export_bulk_text(docs: DataFrame, dockets: DataFrame, folder: str) -> None:
    """``bulk_parts`` as JSON lines partitioned by agency and docket. Ranges of agency, docket and id are written, so a large docket is split over tasks."""
    for name, df in bulk_parts(docs, dockets).items():
        keys = [c for c in ("agency", "docket_id", "doc_id") if c in df.columns]
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.partitionBy("agency", "docket_id").mode("overwrite").json(f"{folder}/{name}")


def search_line(records: DataFrame, kind: str) -> Column:
    """An index command and a record, a line each."""
    key, parent = ("doc_id", "docket_id") if kind == "document" else ("docket_id", None)
    command = F.to_json(F.struct(F.struct(F.lit(kind).alias("_type"), F.col(key).alias("_id"), *([F.col(parent).alias("_parent")] if parent else [])).alias("index")))
    return F.concat(command, F.lit("\n"), F.to_json(F.struct(*(c for c in records.columns if c != "in_feed"))))


def search_lines(records: DataFrame, kind: str) -> DataFrame:
    """(value): the lines of every record that is fed."""
    fed = records.where("in_feed") if "in_feed" in records.columns else records
    return fed.select(search_line(records, kind).alias("value"))


def write_search_feed(records: DataFrame, kind: str, path: str, batch: int = 200) -> None:
    """The feed in files of at most ``batch`` records; the ids of all ``records``, fed or not, are those to be flagged afterwards."""
    search_lines(records, kind).write.option("maxRecordsPerFile", batch).mode("overwrite").text(path)
