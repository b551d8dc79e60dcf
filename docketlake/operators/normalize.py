"""Normalising source records into the model: documents and dockets of two JSON forms, rule-making records, comments, listings.

Open JSON objects are read as maps of raw values, so fields that nobody foresaw are kept and no schema is inferred.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketlake.functions.text import DOC_TYPES, FR_TYPES, collapse_spaces, crockford_hash, detail_key, docket_year, dotted_key, full_name, held, is_us_date, mapped, or_null, title_with_fallback, truthy, url_type, url_without_fragment


def deep_get(column: str, dtype: str, default: object = None) -> Column:
    """A nested value by dotted path, or the default where it or a step to it is missing, zero, false or empty."""
    return F.when(truthy(column, dtype), F.col(column)).otherwise(F.lit(default))


def export_columns() -> dict[str, Column]:
    """The export's columns by name, in the relation's order; details is a map. Text that is missing is empty, a missing date is null."""
    d = lambda k: F.element_at("details", F.lit(k))
    text = lambda c: F.coalesce(c, F.lit(""))
    on = lambda k: text(F.col(f"comment_on.{k}"))
    return {
        "document_id": F.col("doc_id"),
        "docket_id": text(F.col("docket_id")),
        "agency": text(F.col("agency")),
        "date_posted": F.to_date(d("Date_Posted")),
        "date_due": F.to_date(d("Comment_Due_Date")),
        "title": text(F.col("title")),
        "type": text(F.col("type")),
        "org_name": text(d("Organization_Name")),
        "submitter_name": full_name(d("First_Name"), d("Middle_Initial"), d("Last_Name")),
        "on_type": on("type"),
        "on_id": on("document_id"),
        "on_title": on("title"),
    }


def export_metadata(docs: DataFrame, columns: dict[str, Column] | None = None, limit: int | None = None) -> DataFrame:
    """The export columns (those of ``export_columns`` or others) of undeleted documents; ``limit`` is for test runs."""
    kept = docs.where(~F.coalesce("deleted", F.lit(False)))
    kept = kept if limit is None else kept.limit(limit)
    return kept.select(*(c.alias(name) for name, c in (columns or export_columns()).items()))


def project_search_results(dump: DataFrame, now: Column) -> DataFrame:
    """Rows of a search dump as new documents."""
    kind = mapped("documentType", DOC_TYPES, "other")
    return dump.select(F.col("documentId").alias("doc_id"), "title", F.col("docketId").alias("docket_id"), F.col("agencyAcronym").alias("agency"), kind.alias("type"), kind.isin(*FR_TYPES).alias("fr_doc"), F.lit("no").alias("scraped"), F.lit(False).alias("deleted"), now.alias("last_seen"), now.alias("created"))


#: Details that have other names in the newer form, and those that are dates.
RENAMED = {"Received_Date": "Date_Received", "Posted_Date": "Date_Posted", "Comment_Start_Date": "Comment_Start_Date", "Comment_End_Date": "Comment_Due_Date", "Effective_Date": "Date_Effective", "Postmark_Date": "Date_Postmarked"}


def normalize_v3(records: DataFrame, raw: str = "json", types: dict[str, str] | None = None) -> DataFrame:
    """Documents of the newer form: every top-level field that is an object of label and value becomes a detail by its label; views
    from fileFormats, or a text view where there is a comment and no file; what is commented on has the agency of its id."""
    top = F.from_json(raw, "map<string,string>")
    label = lambda v: F.get_json_object(v, "$.label")
    value = lambda v: F.get_json_object(v, "$.value")
    keys_of = lambda v: F.array_sort(F.json_object_keys(v))
    pairs = F.filter(F.map_entries("_top"), lambda e: F.coalesce(keys_of(e["value"]) == F.array(F.lit("label"), F.lit("value")), F.lit(False)))
    named = F.transform(pairs, lambda e: F.struct(detail_key(label(e["value"])).alias("k"), value(e["value"]).alias("v")))
    renamed = F.transform(named, lambda e: F.struct(mapped(e["k"], RENAMED).alias("n"), e["k"].alias("k"), e["v"].alias("v")))
    last = F.transform(F.array_distinct(F.transform("_named", lambda e: F.coalesce(e["n"], e["k"]))), lambda k: F.struct(k.alias("key"), F.element_at(F.filter("_named", lambda e: F.coalesce(e["n"], e["k"]) == k), -1)["v"].alias("value")))
    # held: a record is parsed once, not for every field, and its fields once, not for every detail
    given = records.withColumn("_top", held(top)).withColumn("_named", held(renamed)).withColumn("details", F.map_from_entries(last))

    def plain(k: str) -> Column:
        v = F.element_at("_top", F.lit(k))
        return F.when(v.startswith("{"), value(v)).otherwise(v)

    urls = F.from_json(F.element_at("_top", F.lit("fileFormats")), "array<string>")
    view = lambda u: F.struct(u.alias("url"), url_type(u).alias("type"), F.lit("no").alias("downloaded"), F.lit("no").alias("extracted"), F.lit(None).cast("string").alias("content"))
    comment = plain("comment")
    text = F.array(F.struct(F.lit(None).cast("string").alias("url"), F.lit("txt").alias("type"), F.lit("yes").alias("downloaded"), F.lit("yes").alias("extracted"), comment.alias("content")))
    on = F.element_at("_top", F.lit("commentOnDoc"))
    on_id = F.get_json_object(on, "$.documentId")
    return given.select(
        plain("documentId").alias("doc_id"),
        plain("title").alias("title"),
        plain("docketId").alias("docket_id"),
        plain("agencyAcronym").alias("agency"),
        mapped(plain("documentType"), types or DOC_TYPES, "other").alias("type"),
        or_null(plain("rin")).alias("rin"),
        "details",
        F.when(F.size(urls) > 0, F.transform(urls, view)).when(or_null(comment).isNotNull(), text).otherwise(F.array().cast("array<struct<url:string,type:string,downloaded:string,extracted:string,content:string>>")).alias("views"),
        F.when(on_id.isNotNull(), F.struct(on_id.alias("document_id"), F.get_json_object(on, "$.title").alias("title"), F.substring_index(on_id, "-", 1).alias("agency"))).alias("comment_on"),
    )


def _urls(raw: Column) -> Column:
    """Strings of a JSON list, or the one that stands without its list; none where there are none."""
    return F.coalesce(F.when(F.startswith(raw, F.lit("[")), F.filter(F.from_json(raw, "array<string>"), lambda u: u != "")).otherwise(F.array_compact(F.array(or_null(raw)))), F.array().cast("array<string>"))


def normalize_v1(records: DataFrame, raw: str = "json") -> DataFrame:
    """Documents of the older form: metadata entries of "@name" and "$" become details; views from fileFormats, of the document and of each attachment.
    One entry, file or attachment may stand without its list."""
    entries = F.get_json_object(raw, "$.metadata.entry")
    listed = F.from_json(F.when(F.startswith(entries, F.lit("[")), entries).otherwise(F.concat(F.lit("["), entries, F.lit("]"))), "array<map<string,string>>")
    pair = lambda m: F.struct(detail_key(F.element_at(m, F.lit("@name"))).alias("key"), F.element_at(m, F.lit("$")).alias("value"))
    pairs = F.filter(F.transform(listed, pair), lambda p: p["key"].isNotNull())
    get = lambda k: F.get_json_object(raw, f"$.{k}")
    on_id, on_type = get("commentOn.documentId"), get("commentOn.documentType")

    def attachment(a: Column) -> Column:
        inner = lambda k: F.get_json_object(a, f"$.{k}")
        text = lambda k: F.coalesce(inner(k), F.lit(""))
        return F.struct(text("title").alias("title"), text("abstract").alias("abstract"), F.transform(_urls(inner("fileFormats")), view_from_url).alias("views"))

    keys = F.array_distinct(F.transform(pairs, lambda p: p["key"]))
    details = F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(pairs, lambda p: p["key"] == k), -1)["value"]))
    return records.select(
        get("documentId").alias("doc_id"), get("title").alias("title"), get("docketId").alias("docket_id"), get("agencyId").alias("agency"), mapped(get("documentType"), DOC_TYPES, "other").alias("type"), or_null(get("rin")).alias("rin"), details.alias("details"),
        F.when(or_null(on_id).isNotNull() & or_null(on_type).isNotNull(), F.struct(on_id.alias("document_id"), get("commentOn.title").alias("title"), mapped(on_type, DOC_TYPES, "other").alias("type"))).alias("comment_on"),
        _urls(get("topics")).alias("topics"), or_null(get("commentText")).alias("abstract"), F.transform(_urls(get("fileFormats")), view_from_url).alias("views"), F.transform(listify(get("attachments.attachment"), "string"), attachment).alias("attachments"),
    )


def normalize_docket(records: DataFrame, raw: str = "json") -> DataFrame:
    """Dockets of either form, with the year that their id names."""
    get = lambda *ks: F.coalesce(*(F.get_json_object(raw, f"$.{k}") for k in ks))
    docket_id = get("docketId.value", "docketId")
    return records.select(docket_id.alias("docket_id"), get("title.value", "title", "docketTitle").alias("title"), get("agencyAcronym.value", "agencyAcronym", "agencyId").alias("agency"), or_null(get("rin.value", "rin")).alias("rin"), docket_year(docket_id).alias("year"))


def normalize_docket_record(records: DataFrame, agency: str, source: str) -> DataFrame:
    """Docket records (id, title, url, type, subtype) of an agency, still to be scraped; of the details those that are given."""
    details = F.create_map(F.lit("Source_ID"), "id", F.lit("Source_URL"), "url", F.lit("Type"), "type", F.lit("Subtype"), "subtype")
    given = F.map_filter(details, lambda k, v: (k == "Source_ID") | F.coalesce(v != "", F.lit(False)))
    return records.select(F.concat(F.lit(f"{agency}-X-"), "id").alias("docket_id"), F.lit(agency).alias("agency"), or_null("title").alias("title"), given.alias("details"), F.lit(source).alias("source"), F.lit("no").alias("scraped"))


def docket_stub(ids: DataFrame, agency: str, source: str) -> DataFrame:
    """Dockets of which only the id (docket_id) is known."""
    return ids.select("docket_id", F.lit(agency).alias("agency"), F.lit(source).alias("source"), F.lit("no").alias("scraped")).distinct()


def view_from_url(url: Column) -> Column:
    clean = url_without_fragment(url)
    return F.struct(clean.alias("url"), url_type(url).alias("type"), crockford_hash(clean).alias("object_id"), F.lit("no").alias("downloaded"), F.lit("no").alias("extracted"))


def normalize_fr_record(records: DataFrame, agency: str) -> DataFrame:
    """Rule-making records (id, doctype, title, date, url, file_number, parent): ids by agency, file number or parent or hash; dates after 1900 only."""
    base = F.coalesce(or_null("file_number"), or_null("parent"), crockford_hash("url"))
    docket_id = F.concat(F.lit(f"{agency}-X-"), base)
    date = F.try_to_timestamp("date", F.lit("yyyy-MM-dd")).cast("date")
    return records.select(F.concat(docket_id, F.lit("-"), "id").alias("doc_id"), docket_id.alias("docket_id"), F.lit(agency).alias("agency"), "title", mapped("doctype", DOC_TYPES, "notice").alias("type"), F.when(date > F.lit("1900-01-01").cast("date"), date).alias("date_posted"), F.array(view_from_url(F.col("url"))).alias("views"))


def normalize_comment(records: DataFrame, agency: str, live_host: str = "comments.cftc.gov") -> DataFrame:
    """Comment records (id, docket_id, title, date, url, first_name, last_name, organization, num_received)."""
    date = F.try_to_timestamp("date", F.lit("yyyy-MM-dd")).cast("date")
    details = F.map_filter(F.create_map(F.lit("First_Name"), "first_name", F.lit("Last_Name"), "last_name", F.lit("Organization_Name"), "organization", F.lit("Number_of_Duplicate_Submissions"), F.col("num_received").cast("string")), lambda _, v: F.coalesce(v != "", F.lit(False)))
    return records.select(F.concat_ws("-", F.lit(agency), "docket_id", "id").alias("doc_id"), F.concat_ws("-", F.lit(agency), "docket_id").alias("docket_id"), title_with_fallback("title", "first_name", "last_name", "organization", "id").alias("title"), date.alias("date_posted"), F.when((F.lit(agency) == "CFTC") & F.col("url").contains(live_host), "no").otherwise("yes").alias("scraped"), details.alias("details"))


def flatten_listings(dockets: DataFrame) -> DataFrame:
    """Rows of dockets(id, groups: array of (title, file_no, headings: map of heading to listings (url, title))): docket, title of the
    first group, kind by heading, file number, carried down from the group above where a group has none. A heading of no
    known kind is an error."""
    groups = dockets.select("id", F.col("groups")[0]["title"].alias("docket_title"), F.posexplode("groups").alias("g_no", "g"), "groups")
    above = F.filter(F.transform(F.slice("groups", 1, F.col("g_no") + 1), lambda g: or_null(g["file_no"])), lambda x: x.isNotNull())
    rows = groups.select("id", "docket_title", "g_no", F.when(F.size(above) > 0, F.element_at(above, -1)).alias("file_no"), F.explode("g.headings").alias("heading", "listings"))
    flat = rows.select("*", F.posexplode("listings").alias("l_no", "l"))
    kind = F.when(F.col("heading") == "Other", "other").when(F.col("heading").contains("Comments"), "comment").when(F.col("heading").contains("Meetings"), "exparte").otherwise(F.raise_error(F.concat(F.lit("unknown heading: "), "heading")))
    key = F.coalesce(or_null(F.regexp_extract("l.url", r"/([^/.]+)\.\w+$", 1)), crockford_hash(F.coalesce("l.url", "l.title")))
    return flat.select("id", "docket_title", "file_no", kind.alias("subtype"), key.alias("comment_id"), F.col("l.url").alias("url"), collapse_spaces("l.title").alias("title"))


def keep_own_release(comments: DataFrame) -> DataFrame:
    """Comments whose first release is their docket's."""
    return comments.where(F.get("releases", F.lit(0)) == F.col("docket_release"))


def listify(raw: Column, element: str) -> Column:
    """JSON that is a list or a single element, as an array; nothing is an empty array."""
    text = F.when(F.startswith(F.ltrim(raw), F.lit("[")), raw).otherwise(F.concat(F.lit("["), raw, F.lit("]")))
    return F.coalesce(F.from_json(text, f"array<{element}>"), F.array().cast(f"array<{element}>"))


def checked_us_date(x: Column) -> Column:
    return F.when(is_us_date(x), x).otherwise(F.raise_error(F.concat(F.lit("not a date: "), F.coalesce(x, F.lit("null")))))


def truthy_json(row: DataFrame, columns: list[str]) -> Column:
    """JSON of the fields that are given."""
    kinds = dict(row.dtypes)
    return F.to_json(F.struct(*(F.when(truthy(c, kinds[c]), F.col(c)).alias(c) for c in columns)))


def rename_details(key: Column) -> Column:
    return dotted_key(key)


def scope(docs: DataFrame, *, agency: str | None = None, docket: str | None = None, source: str | None = None, types: tuple[str, ...] = (), deleted: bool = False) -> DataFrame:
    """Documents of an agency, docket, source and types, undeleted unless asked for."""
    out = docs
    for column, value in (("agency", agency), ("docket_id", docket), ("source", source)):
        out = out.where(F.col(column) == value) if value is not None else out
    out = out.where(F.col("type").isin(*types)) if types else out
    return out if deleted or "deleted" not in docs.columns else out.where(~F.coalesce("deleted", F.lit(False)))
