"""Registered queries: scalar functions over the supplied texts, pages, and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketlake.functions import text as t
from docketlake.operators import normalize
from docketlake.plans.registry import register
from docketlake.session import table


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@register(r"select doc_id, len(list_filter(string_split(regexp_replace(lower(text), '\W', ' ', 'g'), ' '), lambda x: x <> '')) as n_words, md5(array_to_string(list_filter(string_split(regexp_replace(lower(text), '\W', ' ', 'g'), ' '), lambda x: x <> ''), ' ')) as digest from documents")
def m1_normalize_words(spark, sf_dir):
    d = _docs(spark, sf_dir).select("doc_id", t.words("text").alias("w"))
    return d.select("doc_id", F.size("w").cast("long").alias("n_words"), F.md5(F.array_join("w", " ")).alias("digest"))


@register("select a.p_partkey as a, b.p_partkey as b, round((length(a.p_name) + length(b.p_name) - levenshtein(a.p_name, b.p_name)) / (length(a.p_name) + length(b.p_name)), 6) as ratio from part a join part b on b.p_partkey = a.p_partkey + 1")
def m2_levenshtein_ratio(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("a"), F.col("p_name").alias("x"))
    q = p.select((F.col("a") - 1).alias("k"), F.col("a").alias("b"), F.col("x").alias("y"))
    return p.join(q, p.a == q.k).select("a", "b", F.round(t.levenshtein_ratio("x", "y"), 6).alias("ratio"))


@register(r"select doc_id, case when doc_id % 2 = 1 then md5(regexp_replace(text, '^\s+|\s+$', '', 'g')) else md5(regexp_replace(text, '^\s+|\s+$', '', 'g')) end as digest from documents")
def m3_extract_comment(spark, sf_dir):
    raw = F.when(F.col("doc_id") % 2 == 1, F.concat(F.lit("meta. Comment: "), "text", F.lit(" ==== Attachments"))).otherwise(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", F.md5(t.extract_comment(raw)).alias("digest"))


@register("select page_id, length(regexp_replace(html, '<[^>]*>', '', 'g')) as n from pages")
def m4_strip_tags(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.length(t.strip_tags("html")).cast("long").alias("n"))


@register("select page_id, page_id % 3 = 0 or not regexp_matches(html, '(?is)<body[^>]*>.*</body>') as empty from pages")
def m5_html_is_empty(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", t.html_is_empty(F.when(F.col("page_id") % 3 == 0, F.lit("<html><body> <p>&nbsp;</p></body></html>")).otherwise(F.col("html"))).alias("empty"))


@register("select page_id, length(regexp_replace(html, '&nbsp;| ', ' ', 'g')) as n from pages")
def m6_replace_nbsp(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.length(t.replace_nbsp("html")).cast("long").alias("n"))


@register("select doc_id, md5(text) as digest from documents")
def m7_remove_control_chars(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(t.remove_control_chars(F.concat(F.char(F.lit(7)), "text", F.char(F.lit(1))))).alias("digest"))


@register(r"""with l as (select doc_id, text, list_filter(string_split(text, chr(10)), lambda x: length(trim(x, chr(32) || chr(9))) > 0 and 2 * length(regexp_replace(x, '[^a-zA-Z ]', '', 'g')) >= length(x)) as g from documents),
  k as (select doc_id, text, array_to_string(list_transform(g, lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), chr(10)) as kept from l) select doc_id, case when length(text) > 0 and 2 * length(kept) >= length(text) then md5(kept) end as digest from k""")
def m8_ocr_scrub(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(t.ocr_scrub("text")).alias("digest"))


@register("select page_id, 'a b' as section from pages")
def m9_html_section_text(spark, sf_dir):
    html = F.concat("html", F.lit("<h2>General Comment</h2><p>a <b>b</b></p><h2>Next</h2>"))
    return table(spark, sf_dir, "pages").select("page_id", t.html_section_text(html, "General Comment").alias("section"))


@register("""with h as (select doc_id, md5(text) as m from documents), bits as (select doc_id, rpad(array_to_string(list_transform(range(1, 33), lambda i: lpad(bin(instr('0123456789abcdef', substr(m, i, 1)) - 1), 4, '0')), ''), 130, '0') as b from h)
  select doc_id, array_to_string(list_transform(range(0, 26), lambda k: substr('0123456789ABCDEFGHJKMNPQRSTVWXYZ', 1 + cast(list_sum(list_transform(range(1, 6), lambda j: cast(substr(b, k * 5 + j, 1) as int) * cast(pow(2, 5 - j) as int))) as int), 1)), '') as hash from bits""")
def m10_crockford_hash(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", t.crockford_hash("text").alias("hash"))


@register("select o_orderkey as doc_id, case when o_orderkey % 4 = 0 then null else 2000 + cast(o_orderkey % 20 as int) end as year from orders")
def m11_docket_year(spark, sf_dir):
    k = F.col("o_orderkey")
    docket = F.when(k % 4 == 0, "EPA-HQ").otherwise(F.concat(F.lit("EPA-"), (2000 + k % 20).cast("string"), F.lit("-0001")))
    return table(spark, sf_dir, "orders").select(k.alias("doc_id"), t.docket_year(docket).alias("year"))


# the first Sunday of April to the last of October; from 2007 the second of March to the first of November
POSTED = """with o as (select o_orderkey, cast(o_orderdate as date) as d, year(o_orderdate) as y from orders),
  s as (select *, case when y < 2007 then make_date(y, 4, 1) + cast((7 - dayofweek(make_date(y, 4, 1))) % 7 as int) else make_date(y, 3, 8) + cast((7 - dayofweek(make_date(y, 3, 8))) % 7 as int) end as first,
    case when y < 2007 then make_date(y, 10, 31) - cast(dayofweek(make_date(y, 10, 31)) as int) else make_date(y, 11, 1) + cast((7 - dayofweek(make_date(y, 11, 1))) % 7 as int) end as last from o)
  select o_orderkey as doc_id, case when o_orderkey % 5 <> 0 then strftime(cast(d as timestamp) + interval 30 minute + case when d >= first and d < last then interval 16 hour else interval 17 hour end, '%Y-%m-%d %H:%M') end as posted from s"""


@register(POSTED)
def m12_parse_posted_date(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    raw = F.when(F.col("o_orderkey") % 5 == 0, "unknown").otherwise(F.concat(F.date_format("o_orderdate", "MMMM dd yyyy"), F.lit(", at 12:30 PM Eastern Standard Time")))
    return o.select(F.col("o_orderkey").alias("doc_id"), F.date_format(t.parse_posted_date(raw), "yyyy-MM-dd HH:mm").alias("posted"))


@register("select p_partkey, regexp_replace(p_type || ' #1', '[^a-zA-Z]+', '_', 'g') as detail, replace(replace(p_type || '. x', ' ', '_'), '.', '') as dotted from part")
def m13_detail_key(spark, sf_dir):
    kind = F.col("p_type")
    return table(spark, sf_dir, "part").select("p_partkey", t.detail_key(F.concat(kind, F.lit(" #1"))).alias("detail"), t.dotted_key(F.concat(kind, F.lit(". x"))).alias("dotted"))


@register("select o_orderkey as doc_id, case o_orderstatus when 'F' then 'rule' when 'O' then 'other' else 'unknown' end as type from orders")
def m14_doc_type_map(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), t.mapped(F.when(F.col("o_orderstatus") == "F", "FR").otherwise(F.col("o_orderstatus")), t.DOC_TYPES, "unknown").alias("type"))


@register("select page_id, case page_id % 5 when 0 then 'xpdf' when 1 then 'html' when 2 then 'html' when 3 then 'docx' else 'html' end as type from pages")
def m14_file_type_map(spark, sf_dir):
    """File types of pages' addresses with an end of a file's name put to them; a fifth has none."""
    end = F.element_at(F.array(F.lit(".pdf"), F.lit(".htm"), F.lit("/index.txt?a=1.5"), F.lit(".docx"), F.lit("/")), (F.col("page_id") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "pages").select("page_id", t.file_type(F.concat(F.regexp_replace("url", r"\.", "-"), end)).alias("type"))


@register("select page_id, c_type as type from (select page_id, case page_id % 6 when 0 then 'notice' when 1 then 'rule' when 2 then 'rule' when 3 then 'proposed_rule' when 4 then 'other' end as c_type from pages) where c_type is not null")
def m14_import_type_map(spark, sf_dir):
    """Types of the second pair of sources, and records' names in capitals."""
    name = F.element_at(F.array(*map(F.lit, ("concept", "final", "RULES", "proposed", "OTHER", "no such type"))), (F.col("page_id") % 6 + 1).cast("int"))
    found = F.coalesce(t.mapped(name, t.IMPORT_TYPES), t.mapped(name, t.RECORD_TYPES))
    return table(spark, sf_dir, "pages").select("page_id", found.alias("type")).where("type is not null")


@register("select page_id, regexp_replace(url, '#.*', '') as clean, coalesce(nullif(lower(regexp_extract(regexp_replace(url, '#.*', ''), '/[^/?]*\\.([A-Za-z]+)$', 1)), ''), 'html') as type from pages")
def m15_view_from_url(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", normalize.view_from_url(F.col("url")).alias("v"))
    return p.select("page_id", F.col("v.url").alias("clean"), "v.type")


@register("select c_custkey, case c_custkey % 3 when 0 then c_name || ' XXXX ' || 'Ann Lee' when 1 then 'Bob XXXX Joe Roe' else 'Org XXXX Comment on rule' end as submitter from customer")
def m16_submitter_string(spark, sf_dir):
    k = F.col("c_custkey") % 3
    org = F.when(k == 0, F.col("c_name")).when(k == 2, "Org")
    title = F.when(k == 1, "Public comment from Joe Roe").when(k == 2, "Comment on rule")
    none = F.lit(None).cast("string")
    return table(spark, sf_dir, "customer").select("c_custkey", t.submitter_string(org, F.when(k == 0, "Ann").when(k == 1, "Bob"), F.when(k == 0, "Lee"), none, title, k == 2).alias("submitter"))


@register(r"select doc_id, case when doc_id % 3 = 0 then '\N' else replace(source || '\.', '\.', '.') end as value from documents")
def m17_escape_export(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", t.escape_export(F.when(F.col("doc_id") % 3 != 0, F.concat("source", F.lit("\\.")))).alias("value"))


@register("select event_id, cast(case event_id % 3 when 0 then 0 when 1 then 1 else 2 end as int) as n from events")
def m18_listify(spark, sf_dir):
    k = F.col("event_id") % 3
    raw = F.when(k == 1, '{"a":1}').when(k == 2, '[{"a":1},{"a":2}]')
    return table(spark, sf_dir, "events").select("event_id", F.size(normalize.listify(raw, "struct<a:int>")).alias("n"))


@register(r"select page_id, case when page_id % 2 = 0 then 'http://h/x' else url end as url, regexp_replace('a ' || url || '  b', '[\s ]+', ' ', 'g') as spaced from pages".replace("\\u00a0", " "))
def m19_canonicalize_url(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", t.canonical_url(F.when(F.col("page_id") % 2 == 0, "/x").otherwise(F.col("url")), "http://h").alias("url"), t.collapse_spaces(F.concat(F.lit(" a "), "url", F.lit("  b "))).alias("spaced"))


@register("select o_orderkey as doc_id, case when o_orderkey % 2 = 0 then 'S7-' || (10 + o_orderkey % 80) || '-11' else '4-' || (100 + o_orderkey % 800) end as file_no from orders")
def m20_file_number(spark, sf_dir):
    k = F.col("o_orderkey")
    url = F.when(k % 2 == 0, F.concat(F.lit("http://s/comments/s7-"), (10 + k % 80).cast("string"), F.lit("-11/s.shtml"))).otherwise(F.concat(F.lit("http://s/rules/4-"), (100 + k % 800).cast("string"), F.lit(".htm")))
    return table(spark, sf_dir, "orders").select(k.alias("doc_id"), t.file_number_from_url(url).alias("file_no"))


@register("select o_orderkey as doc_id, case o_orderkey % 3 when 0 then cast(o_orderkey as varchar) when 1 then '07' end as id, case o_orderkey % 3 when 0 then 'current' when 1 then 'old' end as strategy from orders")
def m21_classify_file_url(spark, sf_dir):
    k = F.col("o_orderkey")
    url = F.when(k % 3 == 0, F.concat(F.lit("http://c/PublicComments/CommentList.aspx?id="), k.cast("string"))).when(k % 3 == 1, "http://c/foia/comment07/x.html").otherwise("http://c/")
    return table(spark, sf_dir, "orders").select(k.alias("doc_id"), t.classify_file_url(url).alias("c")).select("doc_id", "c.id", "c.strategy")


@register("select c_custkey, c_name || ', Firm' as title, 'Mar. 5, 2010' as date, 'f' || c_custkey || '.pdf' as attachment from customer")
def m22_parse_listing_line(spark, sf_dir):
    line = F.concat("c_name", F.lit(", Firm, Mar. 5, 2010 (f"), F.col("c_custkey").cast("string"), F.lit(".pdf)"))
    return table(spark, sf_dir, "customer").select("c_custkey", t.parse_listing_line(line).alias("x")).select("c_custkey", "x.title", "x.date", "x.attachment")


@register("select o_orderkey as doc_id, case o_orderkey % 3 when 0 then 1000 + o_orderkey when 1 then o_orderkey end as n from orders")
def m23_bulk_count(spark, sf_dir):
    k = F.col("o_orderkey")
    title = F.when(k % 3 == 0, F.concat(F.lit("Comments of "), F.format_number(1000 + k, 0), F.lit(" individuals"))).when(k % 3 == 1, F.concat(F.lit("Form letter: "), k.cast("string"))).otherwise("Letter")
    return table(spark, sf_dir, "orders").select(k.alias("doc_id"), t.bulk_count(title).alias("n"))


@register("select o_orderkey as doc_id, '34-' || o_orderkey as release, 'S7-1,S7-2' as files from orders")
def m24_parse_release_meta(spark, sf_dir):
    k = F.col("o_orderkey").cast("string")
    m = t.parse_release_meta(F.concat(F.lit("Release No. 34-"), k, F.lit("; File Nos. S7-1 and S7-2")))
    got = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), m.alias("m"))
    return got.select("doc_id", F.element_at("m", F.lit("Release"))[0].alias("release"), F.array_join(F.element_at("m", F.lit("File")), ",").alias("files"))


@register("select p_partkey, case p_partkey % 3 when 0 then 'proposed_rule' when 1 then 'rule' else 'notice' end as type from part")
def m25_fr_doctype(spark, sf_dir):
    k = F.col("p_partkey") % 3
    title = F.when(k == 0, "Proposed and final").when(k == 1, "Final rule").otherwise("Meeting")
    return table(spark, sf_dir, "part").select("p_partkey", t.fr_doctype_from_title(title).alias("type"))


@register("select o_orderkey as doc_id, 77 as volume, cast(o_orderkey as int) as page, 'Jan. 5, 2012' as date from orders")
def m26_fr_citation(spark, sf_dir):
    x = F.concat(F.lit("see 77 FR "), F.col("o_orderkey").cast("string"), F.lit(" (Jan. 5, 2012)"))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), t.fr_citation_parts(x).alias("c")).select("doc_id", "c.volume", "c.page", "c.date")


@register("select n_nationkey, 'The Bureau of ' || array_to_string(list_transform(string_split(n_name, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ') || ' and R & D' as name from nation")
def m27_agency_name(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", t.normalize_agency_name(F.concat(F.lit("THE  BUREAU OF "), "n_name", F.lit(" AND R&D"))).alias("name"))


@register(r"select o_orderkey as doc_id, regexp_replace('2012-00' || o_orderkey, '-0+([^-]*)$', '-\1') as number from orders")
def m28_trim_fr_number(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), t.trim_fr_number(F.concat(F.lit("2012-00"), F.col("o_orderkey").cast("string"))).alias("number"))


@register("select c_custkey, 'A ' || case when c_custkey % 2 = 0 then 'M ' else '' end || c_name as name, regexp_replace('EPA-' || c_custkey || '-0001', '-[^-]*$', '') as docket_id from customer")
def m29_m30_names_and_dockets(spark, sf_dir):
    middle = F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("")
    return table(spark, sf_dir, "customer").select("c_custkey", t.full_name(F.lit("A"), middle, "c_name").alias("name"), t.default_docket_id(F.concat(F.lit("EPA-"), F.col("c_custkey").cast("string"), F.lit("-0001"))).alias("docket_id"))


@register("select o_orderkey as doc_id, 'o' || o_orderkey as object_id, cast(o_orderkey % 9 as int) as attachment, 'pdf' as type from orders")
def m32_parse_view_url(spark, sf_dir):
    k = F.col("o_orderkey")
    url = F.concat(F.lit("http://r/download?objectId=o"), k.cast("string"), F.lit("&attachmentNumber="), (k % 9).cast("string"), F.lit("&contentType=pdf"))
    return table(spark, sf_dir, "orders").select(k.alias("doc_id"), t.parse_view_url(url).alias("v")).select("doc_id", "v.object_id", "v.attachment", "v.type")


@register("""select page_id, count(*) as n, min(u) as first_url from (select page_id, unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*?href="([^"]*)"[^>]*>', 1)) as u from pages) group by page_id""")
def m33_html_links(spark, sf_dir):
    links = table(spark, sf_dir, "pages").select("page_id", F.explode(t.html_links("html")).alias("l"))
    return links.groupBy("page_id").agg(F.count("*").alias("n"), F.min("l.url").alias("first_url"))


@register("select o_orderkey as doc_id, o_orderkey % 2 = 0 as ok from orders")
def m34_check_us_date(spark, sf_dir):
    x = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "M/d/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), t.is_us_date(x).alias("ok"))


@register("select o_orderkey as doc_id, cast(cast(o_orderdate as date) as varchar) as date, case when o_orderkey % 2 = 0 then true end as flag, case when o_orderkey % 3 = 0 then 'http://x/' || o_orderkey end as url from orders")
def p20_coerce_cells(spark, sf_dir):
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders")
    date = t.coerce_cell(F.date_format("o_orderdate", "MM/dd/yyyy"))["date"].cast("string")
    flag = t.coerce_cell(F.when(k % 2 == 0, "Y").otherwise("x"))["flag"]
    link = t.coerce_cell(F.when(k % 3 == 0, F.concat(F.lit('=HYPERLINK("http://x/'), k.cast("string"), F.lit('","t")'))).otherwise("x"))["url"]
    return o.select(k.alias("doc_id"), date.alias("date"), flag.alias("flag"), link.alias("url"))


@register("""select event_id, '{"event_type":"' || event_type || '"' || case when cast(floor(value) as bigint) % 3 <> 0 then ',"value":' || cast(floor(value) as bigint) % 3 else '' end || '}' as json from events""")
def p10_keep_truthy(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type", (F.floor("value") % 3).alias("value"), F.lit("").alias("note"))
    return e.select("event_id", normalize.truthy_json(e, ["event_type", "value", "note"]).alias("json"))


@register("select s_suppkey as doc_id, len(list_distinct(list_concat([s_suppkey % 3, s_suppkey % 5], [s_suppkey % 2]))) as n_union, case when s_suppkey % 3 = s_suppkey % 2 or s_suppkey % 5 = s_suppkey % 2 then 1 else 0 end as n_common from supplier")
def x1_x5_set_operations(spark, sf_dir):
    k = F.col("s_suppkey")
    a, b = F.array(k % 3, k % 5), F.array(k % 2)
    return table(spark, sf_dir, "supplier").select(k.alias("doc_id"), F.size(F.array_union(a, b)).cast("long").alias("n_union"), t.overlap(a, b).alias("n_common"))


@register("select c_nationkey as k from customer intersect select s_nationkey from supplier where s_suppkey % 2 = 0")
def x2_intersect(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")).intersect(table(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0").select("s_nationkey"))


@register("select distinct p_partkey as k from part except select l_partkey from lineitem where l_returnflag = 'R' and l_quantity > 45")
def x3_difference(spark, sf_dir):
    gone = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R' and l_quantity > 45").select(F.col("l_partkey").alias("k"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k")).distinct().join(gone, "k", "left_anti")
