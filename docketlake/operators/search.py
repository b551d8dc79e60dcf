"""Records for a search index: dockets and documents, with the first views only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketlake.functions.text import default_docket_id, or_null


def search_dockets(dockets: DataFrame) -> DataFrame:
    rin = F.when(F.col("rin") != "Not Assigned", or_null("rin"))
    return dockets.select("docket_id", "title", "agency", F.array_compact(F.array("docket_id", rin)).alias("identifiers"))


def search_documents(docs: DataFrame, *, views: int = 5, attachments: int = 10, characters: int = 100_000) -> DataFrame:
    """A record a document that is not renamed: of its first views and of its first attachments' first views those with content,
    cut to the index's limit of characters. ``in_feed`` is false for suppressed documents, which are flagged as done all the same."""
    record = lambda v, title, kind: F.struct(title.alias("title"), v["object_id"].alias("object_id"), F.lit(kind).alias("kind"), F.left(v["content"], F.lit(characters)).alias("text"))
    own = F.transform(F.filter(F.slice("views", 1, views), lambda v: v["content"].isNotNull() & (v["content"] != "")), lambda v: record(v, F.lit(None).cast("string"), "view"))
    part = F.flatten(F.transform(F.slice("attachments", 1, attachments), lambda a: F.transform(F.filter(F.slice(a["views"], 1, views), lambda v: v["content"].isNotNull() & (v["content"] != "")), lambda v: record(v, a["title"], "attachment"))))
    files = F.concat(F.coalesce(own, F.array().cast("array<struct<title:string,object_id:string,kind:string,text:string>>")), F.coalesce(part, F.array().cast("array<struct<title:string,object_id:string,kind:string,text:string>>")))
    return docs.where(~F.coalesce("renamed", F.lit(False))).select("doc_id", F.coalesce("docket_id", default_docket_id("doc_id")).alias("docket_id"), "title", "agency", files.alias("files"), F.array_compact(F.array("doc_id", "fr_number", "rin")).alias("identifiers"), (F.coalesce(F.size("replaced_by"), F.lit(0)) <= 0).alias("in_feed"))
