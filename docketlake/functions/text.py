"""Scalar functions over columns: normalising, parsing and classifying the texts, ids, dates and links of public documents.

Every function takes and returns columns (or names of columns) and is made of built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Col = Column | str


def _c(x: Col) -> Column:
    return F.col(x) if isinstance(x, str) else x


def held(x: Col) -> Column:
    """The same value, as a column that the optimizer neither copies nor moves: for costly arrays that later steps look into item by
    item, where a filter pushed below them would compute the whole array anew for every item."""
    return F.when(F.spark_partition_id() >= 0, _c(x))


def or_null(x: Col) -> Column:
    """Null for the empty string."""
    return F.nullif(_c(x), F.lit(""))


def strip(x: Col) -> Column:
    """White space of every kind off both ends."""
    return F.regexp_replace(_c(x), r"^\s+|\s+$", "")


def words(text: Col) -> Column:
    """Lower-case words: everything but ASCII letters, digits and underscore separates."""
    return F.filter(F.split(F.regexp_replace(F.lower(_c(text)), r"\W", " "), " "), lambda w: w != "")


def ngrams(tokens: Col, n: int) -> Column:
    """The distinct runs of n words in order of first place; none where there are fewer words."""
    tokens = _c(tokens)
    at = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - (n - 1)))
    return F.coalesce(F.array_distinct(F.transform(at, lambda i: F.array_join(F.slice(tokens, i, n), " "))), F.array().cast("array<string>"))


def overlap(x: Col, y: Col) -> Column:
    return F.size(F.array_intersect(_c(x), _c(y)))


def jaccard(x: Col, y: Col) -> Column:
    """Share of common elements; 0 where both are empty."""
    common = overlap(x, y)
    union = F.size(F.array_distinct(_c(x))) + F.size(F.array_distinct(_c(y))) - common
    return F.when(union > 0, common / union).otherwise(0.0)


def levenshtein_ratio(a: Col, b: Col) -> Column:
    """(length of both less the edit distance) / length of both, in characters; 1 where both are empty."""
    both = F.length(_c(a)) + F.length(_c(b))
    return F.when(both > 0, (both - F.levenshtein(_c(a), _c(b))) / both).otherwise(F.when(both == 0, 1.0))


def _most_edits(a: Col, b: Col, ratio: float) -> Column:
    """The largest edit distance at which ``levenshtein_ratio`` is above ``ratio``."""
    return (F.ceil((F.length(_c(a)) + F.length(_c(b))) * F.lit(1 - ratio)) - 1).cast("int")


def within_ratio(a: Col, b: Col, ratio: float) -> Column:
    """Whether ``levenshtein_ratio`` is above ``ratio``, by an edit distance that is given up beyond it."""
    return F.call_function("levenshtein", _c(a), _c(b), _most_edits(a, b, ratio)) >= 0


def extract_comment(raw: Col) -> Column:
    """What follows a comment marker, up to a rule of equals signs; the whole text where there is no marker."""
    # a fixed value: the marker before a comment and the rule after it
    pattern = r"(?s)Comments? ?(?:\*+|:)(.*?)(?:===+.*)?$"
    return strip(F.when(_c(raw).rlike(pattern), F.regexp_extract(_c(raw), pattern, 1)).otherwise(_c(raw)))


def strip_tags(markup: Col) -> Column:
    return F.regexp_replace(_c(markup), r"<[^>]*>", "")


def html_is_empty(page: Col) -> Column:
    """Whether a page has no body, or no text in it besides a document outline."""
    body = F.regexp_extract(_c(page), r"(?is)<body[^>]*>(.*)</body>", 1)
    body = F.regexp_replace(body, r"(?is)<a name=\"?outline\"?>.*?<hr[^>]*>", "")
    return ~_c(page).rlike(r"(?is)<body[^>]*>.*</body>") | (strip(replace_nbsp(strip_tags(body))) == "")


def replace_nbsp(x: Col) -> Column:
    return F.regexp_replace(_c(x), "&nbsp;| ", " ")


def remove_control_chars(x: Col) -> Column:
    """Without control characters; line feed and carriage return stay."""
    return F.regexp_replace(_c(x), r"[\x00-\x09\x0b\x0c\x0e-\x1f\x7f-\x9f]", "")


def ocr_scrub(x: Col) -> Column:
    """Lines that are at least half letters and spaces, stripped and joined by line feeds; null where less than half of the text is left."""
    lines = F.transform(F.split(_c(x), "\n"), lambda line: F.struct(line.alias("whole"), F.btrim(line, F.lit(" \t\x0b\f\r")).alias("kept")))
    good = F.filter(lines, lambda line: (F.length(line["kept"]) > 0) & (2 * F.length(F.regexp_replace(line["whole"], r"[^a-zA-Z ]+", "")) >= F.length(line["whole"])))
    kept = F.array_join(F.transform(good, lambda line: line["kept"]), "\n")
    # a list of one, so that what is kept is made once and not anew for the condition
    return F.get(F.filter(F.array(kept), lambda k: (F.length(_c(x)) > 0) & (2 * F.length(k) >= F.length(_c(x)))), F.lit(0))


def html_section_text(page: Col, heading: str) -> Column:
    """Text between a second-level heading and the next."""
    found = F.regexp_extract(_c(page), rf"(?is)<h2[^>]*>\s*{heading}\s*</h2>(.*?)(?:<h2|$)", 1)
    return strip(strip_tags(found))


CROCKFORD = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"


def crockford_hash(x: Col) -> Column:
    """MD5 in Crockford's base 32: 26 characters for the 128 bits, the last padded with zero bits."""
    # digest and bits are one-element arrays that a lambda opens, so each is worked out once a row
    digest = F.array(F.md5(_c(x)))
    bits = F.transform(digest, lambda d: F.rpad(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(32)), lambda i: F.lpad(F.conv(F.substr(d, i, F.lit(1)), 16, 2), 4, "0")), ""), 130, "0"))
    five = lambda b: F.transform(F.sequence(F.lit(1), F.lit(126), F.lit(5)), lambda i: F.substr(F.lit(CROCKFORD), F.conv(F.substr(b, i, F.lit(5)), 2, 10).cast("int") + 1, F.lit(1)))
    return F.when(_c(x).isNotNull(), F.get(F.transform(bits, lambda b: F.array_join(five(b), "")), F.lit(0)))


def docket_year(docket_id: Col) -> Column:
    # a fixed value: how docket ids hold their year
    return or_null(F.regexp_extract(_c(docket_id), r"[_-](\d{4})[_-]", 1)).cast("int")


ZONES = {"Eastern": "America/New_York", "Central": "America/Chicago", "Mountain": "America/Denver", "Pacific": "America/Los_Angeles"}


def parse_posted_date(x: Col) -> Column:
    """UTC time of "Month dd yyyy, at hh:mm AM Zone ..."; an unknown zone is Eastern; null where the form does not fit."""
    pattern = r"^\s*(\w+) (\d{1,2}) (\d{4}),? at (\d{1,2}):(\d{2}) ([AP]M)\s*(\w*)"
    part = lambda i: F.regexp_extract(_c(x), pattern, i)
    local = F.try_to_timestamp(F.concat_ws(" ", part(1), F.lpad(part(2), 2, "0"), part(3), F.concat(F.lpad(part(4), 2, "0"), F.lit(":"), part(5)), part(6)), F.lit("MMMM dd yyyy hh:mm a"))
    zone = F.lit(ZONES["Eastern"])
    for name, tz in ZONES.items():
        zone = F.when(part(7) == name, tz).otherwise(zone)
    return F.when(_c(x).rlike(pattern), F.to_utc_timestamp(local, zone))


def detail_key(label: Col) -> Column:
    return F.regexp_replace(_c(label), r"[^a-zA-Z]+", "_")


def dotted_key(label: Col) -> Column:
    """The other form of detail keys: blanks become underscores, dots go."""
    return F.translate(_c(label), " .", "_")


#: Document types of the sources, by their own names.
DOC_TYPES = {"FR": "rule", "PR": "proposed_rule", "N": "notice", "PS": "public_submission", "SR": "supporting_material", "O": "other", "Rule": "rule", "Proposed Rule": "proposed_rule", "Notice": "notice", "Public Submission": "public_submission", "Supporting & Related Material": "supporting_material", "Other": "other"}
#: The names that records give the same types in capitals.
RECORD_TYPES = {"PROPOSED_RULES": "proposed_rule", "RULES": "rule", "NOTICES": "notice", "OTHER": "other"}
#: Document types of the second pair of sources, by their own names.
IMPORT_TYPES = {
    "notice": "notice", "other": "other", "proposed_rule": "proposed_rule", "public_submission": "public_submission", "rule": "rule", "General CFTC": "other", "Industry Filing": "other",
    "Orders and Other Announcements": "other", "Press Release": "other", "Privacy Act Systems": "other", "Proposed Rule": "proposed_rule", "Public Information Collection": "notice", "Sunshine Act": "other",
    "concept": "notice", "final": "rule", "interim-final-temp": "rule", "interp": "notice", "petitions": "other", "policy": "other", "proposed": "proposed_rule", "Federal Register Release": "notice",
}
#: File types by the ends of names.
FILE_TYPES = {"pdf": "xpdf", "html": "html", "htm": "html"}
FR_TYPES = ("notice", "rule", "proposed_rule")


def file_type(url: Col) -> Column:
    """The type of a file by the letters that its address ends in after a dot; other ends stay as they are; html where there is none."""
    end = or_null(F.regexp_extract(_c(url), r"\.([A-Za-z]+)$", 1))
    return F.coalesce(mapped(end, FILE_TYPES), end, F.lit("html"))


def mapped(x: Col, pairs: dict[str, str], default: str | None = None) -> Column:
    """A value by a fixed map."""
    table = F.create_map(*(F.lit(v) for kv in pairs.items() for v in kv))
    return F.coalesce(F.element_at(table, _c(x)), F.lit(default))


def url_without_fragment(url: Col) -> Column:
    return F.regexp_replace(_c(url), "#.*", "")


def url_type(url: Col) -> Column:
    """File type of a link by its extension, html where there is none."""
    return F.coalesce(or_null(F.lower(F.regexp_extract(url_without_fragment(url), r"/[^/?]*\.([A-Za-z]+)$", 1))), F.lit("html"))


def submitter_string(organization: Col, first: Col, last: Col, representative: Col, title: Col, whole_title: Col) -> Column:
    """All that may name a submitter, joined by a mark that no name crosses. whole_title: whether the title itself may."""
    by = or_null(F.regexp_extract(_c(title), r"(?i)^(?:public )?(?:comment|submission)s? (?:by|from) (.*)$", 1))
    name = or_null(F.concat_ws(" ", or_null(first), or_null(last)))
    return F.concat_ws(" XXXX ", or_null(organization), name, or_null(representative), by, F.when(_c(whole_title), or_null(title)))


def escape_export(x: Col) -> Column:
    return F.coalesce(F.replace(_c(x).cast("string"), F.lit("\\."), F.lit(".")), F.lit("\\N"))


def collapse_spaces(x: Col) -> Column:
    return strip(F.regexp_replace(_c(x), "[\\s ]+", " "))


def canonical_url(url: Col, host: str) -> Column:
    return F.when(F.startswith(_c(url), F.lit("/")), F.concat(F.lit(host), _c(url))).otherwise(_c(url))


def file_number_from_url(url: Col) -> Column:
    """An upper-case file number such as S7-12-34 in a link; else a code of four to six characters before the extension, split."""
    number = or_null(F.upper(F.regexp_extract(F.lower(_c(url)), r"((?:s\d+-)?\d+-\d+)", 1)))
    code = or_null(F.regexp_extract(F.lower(_c(url)), r"/([a-z]?\d{4,6})(?:/|\.|$)", 1))
    split = F.when(F.length(code) <= 5, F.concat(F.substr(code, F.lit(1), F.length(code) - 3), F.lit("-"), F.right(code, F.lit(3)))).otherwise(F.concat(F.left(code, F.length(code) - 4), F.lit("-"), F.right(code, F.lit(4))))
    return F.coalesce(number, F.upper(split))


def classify_file_url(url: Col) -> Column:
    """(id, strategy) of a docket link: current by CommentList?id=, sirt by a numbered filing page, old by a dated folder."""
    current = or_null(F.regexp_extract(_c(url), r"(?i)CommentList\.aspx\?id=(\d+)", 1))
    sirt = or_null(F.regexp_extract(_c(url), r"(?i)sirt\.aspx\?.*?Topic=([A-Za-z]+)", 1))
    old = or_null(F.regexp_extract(_c(url), r"(?i)/foia/(?:comment|fedreg)(\d+)/", 1))
    return F.struct(F.coalesce(current, sirt, old).alias("id"), F.when(current.isNotNull(), "current").when(sirt.isNotNull(), "sirt").when(old.isNotNull(), "old").alias("strategy"))


def parse_listing_line(line: Col) -> Column:
    """(title, date, attachment) of a line like "Title, affiliation, Mon. 5, 2010 (File.pdf)"; a memorandum is a meeting."""
    date = or_null(F.regexp_extract(_c(line), r"((?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\.? \d{1,2}, \d{4})", 1))
    attachment = or_null(F.regexp_extract(_c(line), r"\(?([\w-]+\.(?:pdf|txt|htm|html|doc))\)?", 1))
    title = F.regexp_replace(_c(line), r"\(?[\w-]+\.(?:pdf|txt|htm|html|doc)\)?", "")
    title = F.regexp_replace(title, r",? ?(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\.? \d{1,2}, \d{4}", "")
    title = F.regexp_replace(collapse_spaces(F.regexp_replace(title, r"\([^)]*\)", "")), r"[ ,;]+$", "")
    return F.struct(title.alias("title"), date.alias("date"), attachment.alias("attachment"), F.lower(title).rlike("^memorandum").alias("is_meeting"))


def bulk_count(title: Col) -> Column:
    """How many people a listing stands for: "Comments of N individuals", or the number after a colon."""
    a = or_null(F.regexp_extract(_c(title), r"(?i)comments of ([\d,]+) individuals", 1))
    b = or_null(F.regexp_extract(_c(title), r":\s*([\d,]+)\s*$", 1))
    return F.translate(F.coalesce(a, b), ",", "").try_cast("bigint")


def parse_release_meta(x: Col) -> Column:
    """Map from a kind of number to its list: "Release No. 1; File No. 2 and 3"; a bare number continues the kind before it."""
    clean = F.regexp_replace(F.regexp_replace(_c(x), r"Nos\.", "No."), r"Rel\.", "Release")
    parts = F.filter(F.transform(F.split(clean, r";|,| and "), strip), lambda p: p != "")
    pattern = r"^(.*?) ?No\. ?(.+)$"
    start = F.struct(F.lit("").alias("kind"), F.array().cast("array<struct<kind:string,id:string>>").alias("all"))

    def step(acc: Column, p: Column) -> Column:
        named = p.rlike(pattern)
        kind = F.when(named, strip(F.regexp_extract(p, pattern, 1))).otherwise(acc["kind"])
        value = F.when(named, strip(F.regexp_extract(p, pattern, 2))).otherwise(p)
        return F.struct(kind.alias("kind"), F.array_append(acc["all"], F.struct(kind.alias("kind"), value.alias("id"))).alias("all"))

    pairs = F.aggregate(parts, start, step, lambda acc: acc["all"])
    kinds = F.array_distinct(F.transform(pairs, lambda p: p["kind"]))
    return F.map_from_arrays(kinds, F.transform(kinds, lambda k: F.transform(F.filter(pairs, lambda p: p["kind"] == k), lambda p: p["id"])))


def fr_doctype_from_title(title: Col) -> Column:
    low = F.lower(_c(title))
    return F.when(low.contains("proposed"), "proposed_rule").when(low.contains("final"), "rule").otherwise("notice")


def fr_citation_parts(x: Col) -> Column:
    """(volume, page, date) of "77 FR 1234 (Jan. 5, 2012)"."""
    pattern = r"(\d+) (?:FR|Fed\. Reg\.) (\d+)(?: \(([^)]*)\))?"
    part = lambda i: or_null(F.regexp_extract(_c(x), pattern, i))
    return F.struct(part(1).cast("int").alias("volume"), part(2).cast("int").alias("page"), part(3).alias("date"))


SMALL_WORDS = ("the", "and", "of", "on", "in", "for")


def normalize_agency_name(name: Col) -> Column:
    """Space about an ampersand after a capital, single spaces, capitals on all words but small ones; the first always."""
    spaced = collapse_spaces(F.regexp_replace(_c(name), r"([A-Z])&", "$1 & "))
    parts = F.transform(F.split(F.lower(spaced), " "), lambda w, i: F.when((i > 0) & w.isin(*SMALL_WORDS), w).otherwise(F.initcap(w)))
    return F.array_join(parts, " ")


def trim_fr_number(number: Col) -> Column:
    return F.regexp_replace(_c(number), r"-0+([^-]*)$", "-$1")


def full_name(first: Col, middle: Col, last: Col) -> Column:
    return F.concat_ws(" ", or_null(first), or_null(middle), or_null(last))


def default_docket_id(doc_id: Col) -> Column:
    return F.regexp_replace(_c(doc_id), "-[^-]*$", "")


def title_with_fallback(title: Col, first: Col, last: Col, organization: Col, doc_id: Col) -> Column:
    """The title; else "Comment from First Last, Organization" of what is there; else the id."""
    who = or_null(F.concat_ws(", ", or_null(F.concat_ws(" ", or_null(first), or_null(last))), or_null(organization)))
    return F.coalesce(or_null(title), F.concat(F.lit("Comment from "), who), _c(doc_id))


def parse_view_url(url: Col) -> Column:
    """(object_id, document_id, attachment, type) of a download link."""
    def query(key: str) -> Column:
        return or_null(F.regexp_extract(_c(url), rf"[?&]{key}=([^&#]*)", 1))

    return F.struct(query("objectId").alias("object_id"), query("documentId").alias("document_id"), query("attachmentNumber").try_cast("int").alias("attachment"), F.coalesce(query("contentType"), query("disposition")).alias("type"))


def is_us_date(x: Col) -> Column:
    return F.coalesce(_c(x).rlike(r"^\d{1,2}/\d{1,2}/\d{2,4}$"), F.lit(False))


def coerce_cell(x: Col) -> Column:
    """(date, flag, url, title, text) of a spreadsheet cell: dd/dd/dddd, Y or N, or a hyperlink formula."""
    link = r'(?i)^(?:of:)?=?hyperlink\("([^"]*)"\s*[,;]\s*"([^"]*)"\)$'
    return F.struct(
        F.when(_c(x).rlike(r"^\d\d/\d\d/\d{4}$"), F.try_to_timestamp(_c(x), F.lit("MM/dd/yyyy")).cast("date")).alias("date"),
        F.when(_c(x) == "Y", True).when(_c(x) == "N", False).alias("flag"),
        or_null(F.regexp_extract(_c(x), link, 1)).alias("url"),
        or_null(F.regexp_extract(_c(x), link, 2)).alias("title"),
        _c(x).alias("text"),
    )


def truthy(x: Col, dtype: str) -> Column:
    """Whether a value counts as given: not null, zero, false or empty."""
    x = _c(x)
    if dtype.startswith(("array", "map")):
        return F.coalesce(F.size(x) > 0, F.lit(False))
    if dtype == "boolean":
        return F.coalesce(x, F.lit(False))
    if dtype == "string":
        return F.coalesce(x != "", F.lit(False))
    return F.coalesce(x != 0, F.lit(False)) if dtype in ("tinyint", "smallint", "int", "bigint", "float", "double") or dtype.startswith("decimal") else x.isNotNull()


def expanded_count(doc_type: Col, duplicates: Col) -> Column:
    """Submissions that a document stands for: for a public submission the number it states, 1 where that is no integer; others 0."""
    return F.when(_c(doc_type) == "public_submission", F.coalesce(_c(duplicates).try_cast("bigint"), F.lit(1))).otherwise(0).cast("bigint")


def html_links(page: Col) -> Column:
    """Array of (url, text) of a page's links."""
    page = _c(page)
    urls = F.regexp_extract_all(page, F.lit(r'(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(?:.*?)</a>'), 1)
    texts = F.regexp_extract_all(page, F.lit(r'(?is)<a\s[^>]*?href="[^"]*"[^>]*>(.*?)</a>'), 1)
    return F.transform(F.arrays_zip(urls.alias("url"), texts.alias("text")), lambda x: F.struct(x["url"].alias("url"), collapse_spaces(strip_tags(x["text"])).alias("text")))
