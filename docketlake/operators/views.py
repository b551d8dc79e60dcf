"""Views of documents and attachments as arrays of structs: finding, replacing and changing state in bulk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketlake.functions.text import html_is_empty


def find_views(docs: DataFrame, where, column: str = "views") -> DataFrame:
    """A row a view on which all conditions hold; where: a function from the view's column to a condition. The document is
    tested first, then each view."""
    return docs.where(F.exists(column, where)).select("doc_id", F.explode(column).alias("view")).where(where(F.col("view")))


def find_attachment_views(docs: DataFrame, where) -> DataFrame:
    """The same for attachments, with the attachment's object id; documents without attachments give nothing."""
    views = F.flatten(F.transform("attachments", lambda a: a["views"]))
    found = docs.where(F.exists(views, where)).select("doc_id", F.explode("attachments").alias("a"))
    return found.select("doc_id", F.col("a.object_id").alias("object_id"), F.explode("a.views").alias("view")).where(where(F.col("view")))


def no_view_in_state(column: str, state: str, views: str = "views") -> Column:
    """Whether no view has the state in the field ``column``."""
    return ~F.exists(views, lambda v: v[column] == state)


def replace_views(docs: DataFrame, new: DataFrame) -> DataFrame:
    """Documents whose views of the urls in ``new`` (doc_id, view) are taken out, and the new ones put at the end, by url order."""
    by_doc = new.groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list(F.struct(F.col("view.url").alias("url"), "view"))), lambda x: x["view"]).alias("_new"))
    joined = docs.join(by_doc, "doc_id", "left")
    urls = F.transform("_new", lambda v: v["url"])
    kept = F.filter("views", lambda v: ~F.array_contains(urls, v["url"]))
    return joined.withColumn("views", F.when(F.col("_new").isNull(), F.col("views")).otherwise(F.concat(kept, "_new"))).drop("_new")


def replace_attachment_views(docs: DataFrame, new: DataFrame) -> DataFrame:
    """The same for attachment views; new: (doc_id, object_id, view)."""
    by_doc = new.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("object_id", F.col("view.url").alias("url"), "view"))).alias("_new"))
    joined = docs.join(by_doc, "doc_id", "left")

    def changed(a: Column) -> Column:
        mine = F.filter("_new", lambda x: x["object_id"] == a["object_id"])
        kept = F.filter(a["views"], lambda v: ~F.exists(mine, lambda x: x["url"] == v["url"]))
        return a.withField("views", F.concat(kept, F.transform(mine, lambda x: x["view"])))

    return joined.withColumn("attachments", F.when(F.col("_new").isNull(), F.col("attachments")).otherwise(F.transform("attachments", changed))).drop("_new")


def reset_failed(docs: DataFrame, field: str) -> DataFrame:
    """Every failed state of the field, however it failed, back to "no"; deleted documents stay."""
    reset = F.transform("views", lambda v: v.withField(field, F.when(F.startswith(v[field], F.lit("failed")), "no").otherwise(v[field])))
    alive = ~F.coalesce(F.col("deleted"), F.lit(False)) if "deleted" in docs.columns else F.lit(True)
    return docs.withColumn("views", F.when(alive, reset).otherwise(F.col("views")))


def repair_views(old: Column, new: Column) -> Column:
    """Old views with the new types added; the first old view of a type that failed to download is pending again."""
    types = F.transform(old, lambda v: v["type"])
    first = lambda v, i: F.array_position(types, v["type"]) == i + 1
    mended = F.transform(old, lambda v, i: v.withField("downloaded", F.when(first(v, i) & (v["downloaded"] == "failed") & F.exists(new, lambda n: n["type"] == v["type"]), "no").otherwise(v["downloaded"])))
    return F.concat(mended, F.filter(new, lambda n: ~F.array_contains(types, n["type"])))


def reset_extractions(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Views of the listed documents that were extracted from pdf as html: pending again, without content."""
    hit = docs.join(ids.select("doc_id").distinct().withColumn("_hit", F.lit(True)), "doc_id", "left")
    bad = lambda v: (v["type"] == "pdf") & (v["extracted"] == "yes")
    reset = F.transform("views", lambda v: F.when(bad(v), v.withField("extracted", F.lit("no"))).otherwise(v))
    return hit.withColumn("views", F.when(F.col("_hit"), reset).otherwise(F.col("views"))).drop("_hit")


def apply_download_results(views: DataFrame, results: DataFrame, min_bytes: int = 512) -> DataFrame:
    """Views (doc_id, url, downloaded, ..) with results (url, path, n_bytes): yes and the path, or failed where there is no path or
    fewer bytes than min_bytes. Views without a result stay."""
    joined = views.join(results.select("url", "path", "n_bytes", F.lit(True).alias("_got")), "url", "left")
    fine = F.col("path").isNotNull() & (F.col("n_bytes") >= min_bytes)
    state = F.when(F.col("_got").isNull(), F.col("downloaded")).when(fine, "yes").otherwise("failed")
    return joined.withColumn("downloaded", state).withColumn("file_path", F.when(F.coalesce(fine, F.lit(False)), F.col("path"))).drop("path", "n_bytes", "_got")


def first_successful(attempts: DataFrame) -> DataFrame:
    """Of each file's attempts (file, priority, ok, text, error): the first that succeeded, else the last error; one row a file."""
    best = attempts.groupBy("file").agg(F.min_by(F.struct("priority", "text"), F.when(F.col("ok"), F.col("priority"))).alias("good"), F.max_by("error", F.when(~F.col("ok"), F.col("priority"))).alias("error"))
    return best.select("file", F.when(F.col("good").isNotNull(), "yes").otherwise("failed_extraction").alias("extracted"), F.col("good.priority").alias("priority"), F.col("good.text").alias("text"), F.when(F.col("good").isNull(), F.coalesce("error", F.lit("no extractor"))).alias("error"))


def apply_extraction_results(views: DataFrame, results: DataFrame, types: tuple[str, ...] = ("pdf", "html", "txt", "doc")) -> DataFrame:
    """Views with results (url, text, mode, ocr): yes; a type without extractor and a failed attempt are told apart."""
    joined = views.join(results.select("url", "text", "mode", "ocr", F.lit(True).alias("_got")), "url", "left")
    state = F.when(~F.col("type").isin(*types), "failed_no_extractor").when(F.col("_got").isNull(), F.col("extracted")).when(F.col("text").isNotNull(), "yes").otherwise("failed_extraction")
    return joined.withColumn("extracted", state).drop("_got")


def preferred_view(views: DataFrame, types: tuple[str, ...] = ("crtext", "msw8", "pdf")) -> DataFrame:
    """Of each document's views, the first with text in the order of types."""
    place = F.array_position(F.array(*map(F.lit, types)), F.col("type"))
    return views.where((place > 0) & F.col("text").isNotNull()).groupBy("doc_id").agg(F.min_by("text", F.struct(place.alias("p"), "url")).alias("text"))


def empty_extractions(views: DataFrame) -> DataFrame:
    """Ids of documents with an extracted pdf view, kept as html, whose body is empty; views without content are not meant."""
    return views.where((F.col("type") == "pdf") & (F.col("extracted") == "yes") & F.col("content").isNotNull() & html_is_empty("content")).select("doc_id").distinct()


def download_plan(views: DataFrame) -> DataFrame:
    """Pending views: (doc_id, url, path), where the path is two hex digits of the url's hash, then object id or hash, and type."""
    name = F.concat(F.coalesce(F.col("object_id"), F.md5("url")), F.lit("."), F.col("type"))
    return views.where("downloaded = 'no'").select("doc_id", "url", F.concat(F.left(F.md5("url"), F.lit(2)), F.lit("/"), name).alias("path"))


def mark(docs: DataFrame, ids: DataFrame, flag: str) -> DataFrame:
    """``docs`` with the flag set on the listed ids, after their processing has succeeded."""
    hit = ids.select("doc_id").distinct().withColumn("_hit", F.lit(True))
    old = F.col(flag) if flag in docs.columns else F.lit(False)
    return docs.join(hit, "doc_id", "left").withColumn(flag, F.coalesce("_hit", old, F.lit(False))).drop("_hit")
