"""Registered queries: reconciling, upserts, views and their states, resolving references, normalising, exports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from docketlake.operators import normalize, reconcile, resolve, search, views
from docketlake.plans import bindings as b
from docketlake.plans.registry import register
from docketlake.session import scratch, table
from docketlake.sources import collection, sinks

def now():
    return F.lit("2024-06-01").cast("date")


def _store(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where("doc_id % 10 <> 0")
    return d.select("doc_id", F.when(F.col("doc_id") % 13 == 0, "failed").otherwise("yes").alias("scraped"), (F.col("doc_id") % 17 == 0).alias("deleted"), F.lit("2024-01-01").cast("date").alias("last_seen"), (F.col("doc_id") % 3).cast("int").alias("n_attachments"), (F.col("doc_id") % 19 == 0).alias("failed_download"))


def _dump(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where("doc_id % 7 <> 0")
    return d.select("doc_id", F.when(F.col("doc_id") % 23 == 0, "Withdrawn").otherwise("Posted").alias("status"), F.when(F.col("doc_id") % 11 == 0, 9).otherwise((F.col("doc_id") % 3).cast("int")).alias("n_attachments"))


RECONCILED = """store as (select doc_id, case when doc_id % 13 = 0 then 'failed' else 'yes' end as scraped, doc_id % 17 = 0 as deleted, doc_id % 3 as had, doc_id % 19 = 0 as fd from documents where doc_id % 10 <> 0),
  dump as (select doc_id, case when doc_id % 23 = 0 then 'Withdrawn' else 'Posted' end as status, case when doc_id % 11 = 0 then 9 else doc_id % 3 end as has from documents where doc_id % 7 <> 0),
  j as (select coalesce(s.doc_id, d.doc_id) as doc_id, s.doc_id is not null as in_s, d.doc_id is not null as in_d, s.scraped, coalesce(s.deleted, false) as deleted, s.had, s.fd, d.status, d.has from store s full join dump d on s.doc_id = d.doc_id),
  actions as (select doc_id, deleted and in_d as was_deleted, case when in_s and not deleted and not in_d then 'deleted' when in_s and not deleted and (scraped = 'failed' or fd or (scraped = 'yes' and had <> has)) then 'repaired'
    when in_s and not deleted then 'updated' when in_d and status <> 'Withdrawn' then 'new' end as action from j)"""


@register(f"with {RECONCILED} select doc_id, action, was_deleted and action = 'new' as resurrected from actions where action is not null")
def j1_reconcile(spark, sf_dir):
    return reconcile.reconcile(_store(spark, sf_dir), _dump(spark, sf_dir), now())


@register("select doc_id, n_chars from documents where source = (select max(source) from documents) and lang = 'en' and doc_id % 7 <> 0")
def s2_scan_docs(spark, sf_dir):
    """A scope of the stored collection: a partition, a docket, undeleted, two columns."""
    docs = table(spark, sf_dir, "documents").withColumnsRenamed({"lang": "agency", "source": "docket_id"}).withColumn("deleted", F.col("doc_id") % 7 == 0)
    name = f"collection_{uuid.uuid4().hex}"
    collection.write_collection(docs, name, path=scratch(spark, "collection"), buckets=8)
    return collection.scan_docs(spark, name, agency="en", docket=docs.agg(F.max("docket_id")).first()[0], columns=("doc_id", "n_chars"))


@register(f"with {RECONCILED} select coalesce(a.doc_id, s.doc_id) as doc_id, case when action in ('repaired', 'new') then 'no' else s.scraped end as scraped, case when action = 'deleted' then true when action = 'new' then false else coalesce(s.deleted, false) end as deleted, case when action in ('repaired', 'updated', 'new') then '2024-06-01' else '2024-01-01' end as last_seen from store s full join (select * from actions where action is not null) a on a.doc_id = s.doc_id")
def j1_apply_actions(spark, sf_dir):
    store = _store(spark, sf_dir)
    done = reconcile.apply_actions(store, reconcile.reconcile(store, _dump(spark, sf_dir), now()), now())
    return done.select("doc_id", "scraped", "deleted", F.col("last_seen").cast("string").alias("last_seen"))


@register("""with f as (select doc_id, date '2024-01-01' + cast(doc_id % 365 as int) as d, case when doc_id % 23 = 0 then 'Withdrawn' else 'Posted' end as status from documents)
  select doc_id, cast(d as varchar) as date_posted from f where d between date '2024-05-09' and date '2024-06-02' and status <> 'Withdrawn' and not (doc_id % 10 <> 0 and doc_id % 17 <> 0)""")
def j2_incremental_new(spark, sf_dir):
    feed = b.texts(spark, sf_dir).select("doc_id", "date_posted", F.when(F.col("doc_id") % 23 == 0, "Withdrawn").otherwise("Posted").alias("status"))
    got = reconcile.incremental_new(_store(spark, sf_dir), feed, F.lit("2024-05-10").cast("date"), now())
    return got.select("doc_id", F.col("date_posted").cast("string").alias("date_posted"))


@register("""select c_custkey as id, case when c_custkey % 4 <> 0 then case when c_custkey % 3 = 0 then 'new' else c_name end else 'new' end as name, case when c_custkey % 4 <> 0 then 'yes' else 'no' end as scraped from customer where c_custkey % 4 <> 0 or c_custkey % 3 = 0""")
def j3_insert_if_absent(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("yes").alias("scraped"))
    rows = c.where("id % 3 = 0").select("id", F.lit("new").alias("name"), F.lit("no").alias("scraped"))
    return reconcile.insert_if_absent(c.where("id % 4 <> 0"), rows, "id", ("name", "scraped"))


@register("select conv_id, arg_max(role, turn) as role, arg_max(text, turn) filter (length(text) > 100) as text from conversations group by conv_id")
def j17_merge_records(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.when(F.length("text") > 100, F.col("text")).alias("text"))
    return reconcile.merge_records(c, "conv_id", "turn")


@register("select distinct o_custkey as docket_id from orders where o_custkey % 3 = 0")
def j18_stub_missing_dockets(spark, sf_dir):
    docs = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("docket_id"))
    return reconcile.stub_missing(docs, table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("docket_id")))


@register("select coalesce(c.s_suppkey, i.s_suppkey) as id, coalesce(i.s_name, c.s_name) as name, i.s_suppkey is not null as participating, c.s_suppkey is null as inserted from (select * from supplier where s_suppkey % 2 = 0) c full join (select * from supplier where s_suppkey % 3 = 0) i on c.s_suppkey = i.s_suppkey")
def j20_upsert_agencies(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return reconcile.upsert_agencies(s.where("id % 2 = 0").withColumn("participating", F.lit(False)), s.where("id % 3 = 0").withColumn("participating", F.lit(True)))


@register("""select doc_id, case when doc_id % 5 = 0 and doc_id % 2 = 0 then 'fresh' else source end as title, case when doc_id % 2 <> 0 then 'no' when doc_id % 5 = 1 then 'failed' when doc_id % 5 < 3 then 'yes' else 'no' end as scraped, doc_id % 2 = 0 and doc_id % 5 = 2 as renamed from documents""")
def u9_apply_scrape_results(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("title"), F.lit("no").alias("scraped"), F.lit(1).alias("last_seen"), F.lit(1).alias("created"))
    k = F.col("doc_id") % 5
    results = d.where((F.col("doc_id") % 2 == 0) & (k < 3)).select("doc_id", F.when(k == 0, F.col("doc_id")).when(k == 2, F.col("doc_id") + 1).alias("found_id"), F.lit("fresh").alias("title"), F.when(k == 1, "timeout").alias("error"))
    return reconcile.apply_scrape_results(d, results).select("doc_id", "title", "scraped", "renamed")


@register(f"with {b.VIEWS} select doc_id, n, url from views where downloaded = 'failed' and extracted = 'yes' and type = 'pdf'")
def p13_find_views(spark, sf_dir):
    got = views.find_views(b.views(spark, sf_dir), lambda v: (v["downloaded"] == "failed") & (v["extracted"] == "yes") & (v["type"] == "pdf"))
    return got.select("doc_id", "view.n", "view.url")


def _with_attachments(spark, sf_dir):
    """Odd-numbered views as those of one attachment, named by the document."""
    v = b.views(spark, sf_dir)
    odd = F.filter("views", lambda x: x["n"] % 2 == 1)
    return v.select("doc_id", F.filter("views", lambda x: x["n"] % 2 == 0).alias("views"), F.array(F.struct(F.col("doc_id").cast("string").alias("object_id"), F.lit("part").alias("title"), odd.alias("views"))).alias("attachments"))


@register(f"with {b.VIEWS} select doc_id, cast(doc_id as varchar) as object_id, n from views where n % 2 = 1 and downloaded = 'failed'")
def p14_find_attachment_views(spark, sf_dir):
    return views.find_attachment_views(_with_attachments(spark, sf_dir), lambda v: v["downloaded"] == "failed").select("doc_id", "object_id", "view.n")


@register(f"with {b.VIEWS} select doc_id, count(*) filter (extracted = 'no') = 0 as ready from views group by doc_id")
def p12_no_view_in_state(spark, sf_dir):
    return b.views(spark, sf_dir).select("doc_id", views.no_view_in_state("extracted", "no").alias("ready"))


@register(f"with {b.VIEWS}, r as (select doc_id, n, url, row_number() over (partition by doc_id order by n % 3 = 0, case when n % 3 = 0 then 0 else n end, url) as place from views) select doc_id, url, cast(place as int) as place from r")
def u1_replace_views(spark, sf_dir):
    docs = b.views(spark, sf_dir)
    new = docs.select("doc_id", F.explode("views").alias("view")).where("view.n % 3 = 0")
    return views.replace_views(docs, new).select("doc_id", F.posexplode("views").alias("p", "v")).select("doc_id", "v.url", (F.col("p") + 1).alias("place"))


@register(f"with {b.VIEWS} select doc_id, n, case when n % 2 = 1 and n % 3 = 0 then 'yes' else downloaded end as downloaded from views where n % 2 = 1")
def u2_replace_attachment_views(spark, sf_dir):
    docs = _with_attachments(spark, sf_dir)
    each = docs.select("doc_id", F.explode("attachments").alias("a")).select("doc_id", "a.object_id", F.explode("a.views").alias("view")).where("view.n % 3 = 0")
    new = each.withColumn("view", F.col("view").withField("downloaded", F.lit("yes")))
    return views.replace_attachment_views(docs, new).select("doc_id", F.explode("attachments").alias("a")).select("doc_id", F.explode("a.views").alias("v")).select("doc_id", "v.n", "v.downloaded")


@register(f"with {b.VIEWS} select doc_id, n, case when extracted like 'failed%' then 'no' else extracted end as extracted from views")
def u3_reset_failed(spark, sf_dir):
    return views.reset_failed(b.views(spark, sf_dir), "extracted").select("doc_id", F.explode("views").alias("v")).select("doc_id", "v.n", "v.extracted")


@register(f"with {b.VIEWS}, f as (select *, row_number() over (partition by doc_id, type order by n, url) as r from views) select doc_id, n, case when r = 1 and downloaded = 'failed' and type = 'pdf' then 'no' else downloaded end as downloaded from f union all select doc_id, 99, 'no' from views group by doc_id having count(*) filter (type = 'pdf') = 0")
def u4_repair_views(spark, sf_dir):
    docs = b.views(spark, sf_dir)
    new = F.array(F.struct(F.lit(99).alias("n"), F.lit("http://new").alias("url"), F.lit("pdf").alias("type"), F.lit("no").alias("downloaded"), F.lit("no").alias("extracted"), F.lit(0).alias("size")))
    got = docs.select("doc_id", F.explode(views.repair_views(F.col("views"), new)).alias("v"))
    return got.select("doc_id", "v.n", "v.downloaded")


@register(f"with {b.VIEWS} select doc_id, n, case when doc_id % 2 = 0 and type = 'pdf' and extracted = 'yes' then 'no' else extracted end as extracted from views")
def u6_reset_extractions(spark, sf_dir):
    docs = b.views(spark, sf_dir)
    return views.reset_extractions(docs, docs.where("doc_id % 2 = 0").select("doc_id")).select("doc_id", F.explode("views").alias("v")).select("doc_id", "v.n", "v.extracted")


def _flat(spark, sf_dir):
    return b.views(spark, sf_dir).select("doc_id", F.explode("views").alias("v")).select("doc_id", "v.*")


@register(f"with {b.VIEWS} select doc_id, n, case when n % 2 = 0 then downloaded when size >= 20 then 'yes' else 'failed' end as downloaded from views")
def u7_apply_download_results(spark, sf_dir):
    flat = _flat(spark, sf_dir)
    results = flat.where("n % 2 = 1").select("url", F.concat(F.lit("/files/"), F.col("n").cast("string")).alias("path"), F.col("size").alias("n_bytes"))
    return views.apply_download_results(flat, results, min_bytes=20).select("doc_id", "n", "downloaded")


@register(f"with {b.VIEWS} select doc_id, n, case when type = 'txt' then 'failed_no_extractor' when n % 2 = 0 then extracted when size >= 20 then 'yes' else 'failed_extraction' end as extracted from views")
def u8_apply_extraction_results(spark, sf_dir):
    flat = _flat(spark, sf_dir)
    results = flat.where("n % 2 = 1").select("url", F.when(F.col("size") >= 20, "text").alias("text"), F.lit("x").alias("mode"), F.lit(False).alias("ocr"))
    return views.apply_extraction_results(flat, results, ("pdf", "html")).select("doc_id", "n", "extracted")


@register("select o_orderkey as doc_id, o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R') as in_search_index from orders")
def u10_mark_processed(spark, sf_dir):
    docs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"))
    return views.mark(docs, table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("doc_id")), "in_search_index")


@register(f"with {b.VIEWS} select url as file, case when max(size) filter (size >= 25) is not null then 'yes' else 'failed_extraction' end as extracted, 1 as n from views group by url")
def w11_first_successful(spark, sf_dir):
    flat = _flat(spark, sf_dir).select(F.col("url").alias("file"), F.col("n").alias("priority"), (F.col("size") >= 25).alias("ok"), F.col("type").alias("text"), F.lit("bad").alias("error"))
    return views.first_successful(flat).select("file", "extracted", F.lit(1).alias("n"))


@register(f"with {b.VIEWS}, k as (select *, case type when 'html' then 1 when 'pdf' then 2 end as p from views where type <> 'txt') select doc_id, arg_min(cast(n as varchar), p * 1000 + n) as text from k group by doc_id")
def w4_preferred_view(spark, sf_dir):
    flat = _flat(spark, sf_dir).withColumn("text", F.col("n").cast("string"))
    return views.preferred_view(flat, ("html", "pdf"))


@register(f"with {b.VIEWS} select doc_id, url, left(md5(url), 2) || '/' || md5(url) || '.' || type as path from views where downloaded = 'no'")
def p17_download_plan(spark, sf_dir):
    return views.download_plan(_flat(spark, sf_dir).withColumn("object_id", F.lit(None).cast("string")))


@register(f"with {b.VIEWS} select distinct doc_id from views where type = 'pdf' and extracted = 'yes' and n % 2 = 0")
def p19_empty_extractions(spark, sf_dir):
    empty = F.lit("<html><body><p> </p></body></html>")
    return views.empty_extractions(_flat(spark, sf_dir).withColumn("content", F.when(F.col("n") % 2 == 0, empty).otherwise("<html><body>x</body></html>")))


@register("select c.doc_id as comment_id, d.doc_id as doc_id from documents c left join documents d on d.doc_id = c.doc_id - c.doc_id % 10 and d.doc_id % 10 = 0 and d.doc_id % 20 = 0")
def j5_resolve_comment_on(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    key = (F.col("doc_id") - F.col("doc_id") % 10).cast("string")
    comments = d.select(F.col("doc_id").alias("comment_id"), F.array(F.concat(F.lit("N"), key)).alias("releases"))
    rules = d.where("doc_id % 20 = 0").select("doc_id", F.concat(F.lit("N"), F.col("doc_id").cast("string")).alias("number"), F.lit(None).cast("string").alias("citation"), F.col("doc_id").alias("seq"))
    return resolve.resolve_comment_on(comments, rules.withColumn("doc_id", F.col("doc_id").cast("string"))).select("comment_id", F.col("doc_id").cast("long").alias("doc_id"))


@register("select o_orderkey as doc_id, case when o_custkey % 10 <> 0 then o_custkey - o_custkey % 10 else o_custkey end as docket_id from orders")
def j6_redirect_to_parent(spark, sf_dir):
    comments = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_custkey").alias("docket_id"))
    dockets = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 10 != 0, F.col("c_custkey") - F.col("c_custkey") % 10).alias("parent"))
    return resolve.redirect_to_parent(comments, dockets).select("doc_id", "docket_id")


def _two_sources(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.when(F.col("doc_id") % 2 == 0, "one").otherwise("two").alias("source"), F.lit("rule").alias("type"), F.md5("text").alias("number"))


@register("select a.doc_id as winner_id, b.doc_id as loser_id from documents a join documents b on a.text = b.text and a.doc_id % 2 = 0 and b.doc_id % 2 = 1")
def j7_suppressed_pairs(spark, sf_dir):
    return resolve.suppressed_pairs(_two_sources(spark, sf_dir), "one", "two")


@register("select d.doc_id, coalesce(len(list(distinct w.doc_id) filter (w.doc_id is not null)), 0) as n_replaced_by from documents d left join documents w on d.text = w.text and w.doc_id % 2 = 0 and d.doc_id % 2 = 1 group by d.doc_id")
def j7_apply_suppression(spark, sf_dir):
    docs = _two_sources(spark, sf_dir)
    got = resolve.apply_suppression(docs, resolve.suppressed_pairs(docs, "one", "two"))
    return got.select("doc_id", F.size("replaced_by").cast("long").alias("n_replaced_by"))


@register("select doc_id from documents d where doc_id % 2 = 0 or not exists (select 1 from documents w where w.text = d.text and w.doc_id % 2 = 0)")
def p18_exclude_suppressed(spark, sf_dir):
    docs = _two_sources(spark, sf_dir)
    return resolve.exclude_suppressed(resolve.apply_suppression(docs, resolve.suppressed_pairs(docs, "one", "two"))).select("doc_id")


@register("select n_nationkey as id, case when n_nationkey % 2 = 0 then n_regionkey end as fr_id from nation")
def j8_lookup_agency_ids(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    fr = n.where("n_nationkey % 2 = 0").select(F.col("n_nationkey").cast("string").alias("short_name"), F.col("n_regionkey").alias("fr_id"))
    return resolve.lookup_agency_ids(n.select(F.col("n_nationkey").cast("string").alias("id")), fr).select(F.col("id").cast("int").alias("id"), "fr_id")


TITLED = """t as (select p_partkey as k, p_name || ' ' || p_type || ' ' || p_size as title, case when p_partkey % 10 <> 3 then p_brand end as agency,
  case when p_partkey % 12 <> 5 then date '2024-01-01' + cast(p_partkey % 365 as int) end as d from part)"""
RATIO = "(length(a.title) + length(b.title) - levenshtein(a.title, b.title)) / (length(a.title) + length(b.title))"
GUESSED = f"""met as (select a.k as doc_id, b.k as article_id, {RATIO} as s, abs(a.d - b.d) as apart from t a join t b on a.k % 2 = 1 and b.k % 2 = 0
    and (a.agency is null or a.agency = b.agency) and (a.d is null or abs(a.d - b.d) <= 90) and length(a.title) >= 10 and length(b.title) >= 10),
  guessed as (select *, row_number() over (partition by doc_id order by apart, s desc, article_id) as r from met where s > 0.75)"""


def _titled(spark, sf_dir):
    """Parts as documents (odd keys) and articles (even keys): some documents have no agency, some no date, some neither."""
    k = F.col("p_partkey")
    title = F.concat_ws(" ", "p_name", "p_type", F.col("p_size").cast("string"))
    t = table(spark, sf_dir, "part").select(k.alias("k"), title.alias("title"), F.when(k % 10 != 3, F.col("p_brand")).alias("agency"), F.when(k % 12 != 5, F.date_add(F.lit("2024-01-01").cast("date"), (k % 365).cast("int"))).alias("date_posted"))
    return t.where("k % 2 = 1").withColumnRenamed("k", "doc_id"), t.where("k % 2 = 0").withColumnRenamed("k", "article_id")


@register(f"with {TITLED}, {GUESSED} select doc_id, article_id, round(s, 6) as similarity, cast(apart as int) as days_apart from guessed where r = 1")
def j9_guess_article(spark, sf_dir):
    docs, articles = _titled(spark, sf_dir)
    return resolve.guess_article(docs, articles).withColumn("similarity", F.round("similarity", 6))


@register(f"""with {TITLED}, r as (select a.k as doc_id, b.k as article_id, row_number() over (partition by a.k order by {RATIO} desc, b.k) as r from t a join t b
  on a.k % 2 = 1 and b.k % 2 = 0 and (a.k + 1) % 25 = b.k % 20) select doc_id, article_id from r where r = 1""")
def j10_article_by_citation(spark, sf_dir):
    docs, articles = _titled(spark, sf_dir)
    return resolve.article_by_citation(docs.withColumn("citation", (F.col("doc_id") + 1) % 25), articles.withColumn("citation", F.col("article_id") % 20))


@register(f"""with {TITLED}, {GUESSED}, cited as (select a.k as doc_id, b.k as article_id, row_number() over (partition by a.k order by {RATIO} desc, b.k) as r
    from t a join t b on a.k % 2 = 1 and b.k % 2 = 0 and (a.k + 1) % 60 = b.k % 40),
  routes as (select a.k as doc_id, case when a.k % 3 = 0 then n.k end as n_id, case when a.k % 5 = 0 then c.article_id end as c_id, case when a.k % 7 = 0 then c.article_id end as t_id, case when a.k % 7 <> 0 then g.article_id end as g_id
    from t a left join t n on n.k = a.k + 1 left join cited c on c.doc_id = a.k and c.r = 1 left join guessed g on g.doc_id = a.k and g.r = 1 where a.k % 2 = 1)
  select doc_id, coalesce(n_id, c_id, t_id, g_id) as article_id, case when n_id is not null then 'number' when c_id is not null then 'citation' when t_id is not null then 'text' when g_id is not null then 'title' else 'none' end as route from routes""")
def j11_annotate(spark, sf_dir):
    docs, articles = _titled(spark, sf_dir)
    k = F.col("doc_id")
    cite = F.concat(F.lit("c"), ((k + 1) % 60).cast("string"))
    docs = docs.select("*", F.when(k % 3 == 0, (k + 1).cast("string")).alias("number"), F.when(k % 5 == 0, cite).alias("citation"), F.when(k % 7 == 0, cite).alias("text_citation"))
    a = F.col("article_id")
    return resolve.annotate(docs, articles.select("*", a.cast("string").alias("number"), F.concat(F.lit("c"), (a % 40).cast("string")).alias("citation")))


@register("select doc_id, case doc_id % 3 when 0 then '77 FR ' else '76 FR ' end || doc_id as citation from documents where doc_id % 3 <> 2")
def w14_page_header_citation(spark, sf_dir):
    """A page header is set above two thirds of the texts, its number on the line before or after it."""
    d, key = table(spark, sf_dir, "documents"), F.col("doc_id").cast("string")
    above = F.when(F.col("doc_id") % 3 == 0, F.concat(key, F.lit("\nFederal Register / Vol. 77, No. 3\n"))).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("Federal Register / Vol. 76, No. 3\n"), key, F.lit("\n"))).otherwise("")
    lines = d.select("doc_id", F.posexplode(F.split(F.concat(above, F.coalesce("text", F.lit(""))), "\n")).alias("line_no", "line"))
    return resolve.page_header_citation(lines)


@register("""select cast(doc_id as varchar) as document_id, source as docket_id, lang as agency, date '2024-01-01' + cast(doc_id % 365 as int) as date_posted, case when doc_id % 4 = 0 then date '2025-03-01' end as date_due, text as title,
  'notice' as type, case when doc_id % 2 = 0 then 'org' else '' end as org_name, case when doc_id % 5 = 0 then '' else 'A' || doc_id % 9 || ' B' end as submitter_name, case when doc_id % 3 = 0 then 'rule' else '' end as on_type,
  case when doc_id % 3 = 0 then source || '-1' else '' end as on_id, case when doc_id % 3 = 0 then 'On' else '' end as on_title from documents where doc_id % 6 <> 0""")
def p2_export_metadata(spark, sf_dir):
    t = b.texts(spark, sf_dir)
    k = F.col("doc_id")
    named = k % 5 != 0
    details = F.create_map(F.lit("Date_Posted"), F.col("date_posted").cast("string"), F.lit("Comment_Due_Date"), F.when(k % 4 == 0, "2025-03-01"), F.lit("First_Name"), F.when(named, F.concat(F.lit("A"), (k % 9).cast("string"))), F.lit("Middle_Initial"), F.lit(""), F.lit("Last_Name"), F.when(named, "B"), F.lit("Organization_Name"), F.when(k % 2 == 0, "org"))
    on = F.when(k % 3 == 0, F.struct(F.concat("docket_id", F.lit("-1")).alias("document_id"), F.lit("On").alias("title"), F.lit("rule").alias("type")))
    docs = t.select(k.cast("string").alias("doc_id"), "docket_id", "agency", F.col("text").alias("title"), F.lit("notice").alias("type"), (k % 6 == 0).alias("deleted"), details.alias("details"), on.alias("comment_on"))
    return normalize.export_metadata(docs)


@register("select cast(o_orderkey as varchar) as doc_id, case o_orderstatus when 'F' then 'rule' when 'O' then 'other' else 'public_submission' end as type, o_orderstatus = 'F' as fr_doc from orders")
def p3_project_search_results(spark, sf_dir):
    kind = F.when(F.col("o_orderstatus") == "F", "FR").when(F.col("o_orderstatus") == "O", "O").otherwise("PS")
    dump = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("documentId"), F.lit("t").alias("title"), F.col("o_custkey").cast("string").alias("docketId"), F.lit("A").alias("agencyAcronym"), kind.alias("documentType"))
    return normalize.project_search_results(dump, F.lit("2024-01-01").cast("timestamp")).select("doc_id", "type", "fr_doc")


@register("select cast(event_id as varchar) as doc_id, event_type as title, cast(user_id as varchar) as docket_id, cast(floor(value) as int) as posted, 'rule' as type from events")
def p5_normalize_v3(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    field = lambda name, label, x: F.struct(F.lit(label).alias("label"), x.cast("string").alias("value")).alias(name)
    raw = F.to_json(F.struct(F.col("event_id").cast("string").alias("documentId"), field("title", "Title", F.col("event_type")), F.col("user_id").cast("string").alias("docketId"), F.lit("FR").alias("documentType"), field("value", "Posted Date", F.floor("value"))))
    got = normalize.normalize_v3(e.select(raw.alias("json")))
    return got.select("doc_id", "title", "docket_id", F.element_at("details", F.lit("Date_Posted")).cast("int").alias("posted"), "type")


@register("select 'SEC-X-' || s_suppkey as docket_id, 'SEC' as agency, case when s_suppkey % 3 <> 0 then s_name end as title, case when s_suppkey % 4 = 0 then 'http://x/' || s_suppkey end as url, 2 + case when s_suppkey % 4 = 0 then 1 else 0 end as n_details, 'other' as source, 'no' as scraped from supplier")
def p9_normalize_docket_record(spark, sf_dir):
    k = F.col("s_suppkey")
    records = table(spark, sf_dir, "supplier").select(k.cast("string").alias("id"), F.when(k % 3 != 0, F.col("s_name")).otherwise("").alias("title"), F.when(k % 4 == 0, F.concat(F.lit("http://x/"), k.cast("string"))).alias("url"), F.lit("rule").alias("type"), F.lit("").alias("subtype"))
    got = normalize.normalize_docket_record(records, "SEC", "other")
    return got.select("docket_id", "agency", "title", F.element_at("details", F.lit("Source_URL")).alias("url"), F.size("details").alias("n_details"), "source", "scraped")


@register("""select c_custkey as doc_id, n_nationkey as entity_id from customer join nation on c_nationkey = n_nationkey where c_custkey % 5 in (0, 1, 2)""")
def j19_submitter_matches(spark, sf_dir):
    """Customers as submitters: a nation named as organization, last name or in the title; or with its words in two parts, which is no match."""
    from docketlake.operators import entities

    nation = table(spark, sf_dir, "nation")
    k, name = F.col("c_custkey"), F.concat(F.lit("Land "), F.translate("n_name", "_", " "), F.lit(" Office"))
    c = table(spark, sf_dir, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 rows
    details = F.create_map(F.lit("Organization_Name"), F.when(k % 5 == 0, name).when(k % 5 == 3, "Land"), F.lit("First_Name"), F.lit("Ann"), F.lit("Last_Name"), F.when(k % 5 == 1, name).when(k % 5 == 3, F.translate("n_name", "_", " ")))
    docs = c.select(k.alias("doc_id"), details.alias("details"), F.when(k % 5 == 2, F.concat(F.lit("Public comment from "), name)).otherwise(name).alias("title"), F.lit("a").alias("source"), F.lit("notice").alias("type"))
    aliases = nation.select(F.concat(F.lit("Land "), F.translate("n_name", "_", " "), F.lit(" Office")).alias("alias"), F.col("n_nationkey").alias("entity_id"))
    return entities.submitter_matches(docs, aliases)


@register("select 'EPA-HQ' || o_custkey || '-' || year(o_orderdate) || '-' || o_orderkey as docket_id, o_orderpriority as title, cast(year(o_orderdate) as int) as year from orders")
def p6_normalize_docket(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    docket = F.concat(F.lit("EPA-HQ"), F.col("o_custkey").cast("string"), F.lit("-"), F.year("o_orderdate").cast("string"), F.lit("-"), F.col("o_orderkey").cast("string"))
    raw = F.when(F.col("o_orderkey") % 2 == 0, F.to_json(F.struct(docket.alias("docketId"), F.col("o_orderpriority").alias("title")))).otherwise(F.to_json(F.struct(F.struct(F.lit("Docket").alias("label"), docket.alias("value")).alias("docketId"), F.struct(F.lit("Title").alias("label"), F.col("o_orderpriority").alias("value")).alias("title"))))
    return normalize.normalize_docket(o.select(raw.alias("json"))).select("docket_id", "title", "year")


@register("select 'SEC-' || o_custkey || '-' || o_orderkey as doc_id, case when o_orderkey % 3 = 0 then 'Comment from A B, Org' when o_orderkey % 3 = 1 then 'T' else cast(o_orderkey as varchar) end as title, cast(cast(o_orderdate as date) as varchar) as date_posted from orders")
def p8_normalize_comments(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 3
    rec = o.select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").cast("string").alias("docket_id"), F.when(k == 1, "T").alias("title"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.lit("http://x/y.pdf").alias("url"), F.when(k == 0, "A").alias("first_name"), F.when(k == 0, "B").alias("last_name"), F.when(k == 0, "Org").alias("organization"), F.lit(None).cast("int").alias("num_received"))
    return normalize.normalize_comment(rec, "SEC").select("doc_id", "title", F.col("date_posted").cast("string").alias("date_posted"))


@register("select doc_id from documents where lang = 'de' and source = 'src0'")
def p11_scope(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("agency"), F.col("source").alias("docket_id"))
    return normalize.scope(docs, agency="de", docket="src0").select("doc_id")


@register("select cast(c_custkey as varchar) as docket_id, cast(case when c_custkey % 2 = 0 then 2 else 1 end as int) as n_identifiers from customer")
def p15_search_dockets(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("docket_id"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("agency"), F.when(F.col("c_custkey") % 2 == 0, "R1").otherwise("Not Assigned").alias("rin"))
    return search.search_dockets(c).select("docket_id", F.size("identifiers").alias("n_identifiers"))


def _search(spark, sf_dir):
    v = F.struct(F.lit("o").alias("object_id"), F.col("text").alias("content"))
    d = b.texts(spark, sf_dir)
    return search.search_documents(d.select(F.col("doc_id").cast("string").alias("doc_id"), "docket_id", F.lit("t").alias("title"), "agency", F.array_repeat(v, 7).alias("views"), F.array_repeat(F.struct(F.lit("a").alias("title"), F.array_repeat(v, 1).alias("views")), 2).alias("attachments"), (F.col("doc_id") % 9 == 0).alias("renamed"), F.lit(None).cast("string").alias("fr_number"), F.lit(None).cast("string").alias("rin"), F.array().cast("array<string>").alias("replaced_by")))


@register("select cast(doc_id as varchar) as doc_id, case when text = '' then 0 else 7 end as n_files, cast(case when text = '' then 0 else 7 * length(left(text, 100000)) end as bigint) as n_chars from documents where doc_id % 9 <> 0")
def p16_search_documents(spark, sf_dir):
    return _search(spark, sf_dir).select("doc_id", F.size("files").alias("n_files"), F.aggregate("files", F.lit(0).cast("long"), lambda a, f: a + F.length(f["text"])).alias("n_chars"))


@register("select cast(doc_id as varchar) as doc_id, source as docket_id, lang as agency, case when text <> '' then left(text, 100000) end as text from documents where doc_id % 9 <> 0")
def k6_search_feed(spark, sf_dir):
    lines = sinks.search_lines(_search(spark, sf_dir), "document").select(F.split("value", "\n", 2).alias("l"))
    command, record = (F.col("l")[i] for i in (0, 1))
    return lines.select(F.get_json_object(command, "$.index._id").alias("doc_id"), F.get_json_object(command, "$.index._parent").alias("docket_id"), F.get_json_object(record, "$.agency").alias("agency"), F.get_json_object(record, "$.files[6].text").alias("text"))


@register(r"select cast(doc_id as varchar) as document_id, case when doc_id % 5 = 0 then '\N' else source end as docket_id from documents")
def k1_export_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("document_id"), F.when(F.col("doc_id") % 5 != 0, F.col("source")).alias("docket_id"))
    return sinks.as_text(d)


@register("select doc_id, lang as title, 'u' || doc_id as url, text from documents")
def k4_doc_table(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return sinks.doc_table(d.select("doc_id", F.col("lang").alias("title"), F.concat(F.lit("u"), "doc_id").alias("url"), "text", "source"))


@register("select 'd' as what, count(*) as n from documents where lang = 'en' union all select 'f', count(distinct source) from documents where lang = 'en' union all select 'k', count(distinct source) from documents where lang = 'en'")
def k8_copy_subset(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("source").alias("docket_id"), F.array("source").alias("object_ids"), F.lit(None).cast("string").alias("source"))
    names = d.select(F.col("docket_id").alias("object_id")).distinct()
    got = reconcile.copy_subset(d, names, names.withColumnRenamed("object_id", "docket_id"), F.col("lang") == "en")
    counts = [x.agg(F.lit(k).alias("what"), F.count("*").alias("n")) for k, x in zip("dfk", got, strict=True)]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@register("select l_orderkey as doc_id, 'o' || l_orderkey as object_id, 'view' as kind, l_partkey as entity_id from lineitem")
def p22_explode_matches(spark, sf_dir):
    from docketlake.operators.entities import explode_matches

    li = table(spark, sf_dir, "lineitem")
    view = F.struct(F.lit(None).cast("string").alias("object_id"), F.concat(F.lit("/x/o"), F.col("l_orderkey").cast("string"), F.lit(".pdf")).alias("file_path"), F.lit("pdf").alias("type"), F.array("l_partkey").alias("entities"))
    docs = li.select(F.col("l_orderkey").alias("doc_id"), F.array(view).alias("views"), F.array().cast("array<struct<object_id:string,views:array<struct<type:string,entities:array<bigint>>>>>").alias("attachments"))
    return explode_matches(docs).select("doc_id", "object_id", "kind", "entity_id")


@register("select conv_id as doc_id, cast(turn as int) as n, case when turn % 2 = 0 then 'comment' else 'other' end as subtype from conversations")
def p23_flatten_listings(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    listing = F.array(F.struct(F.lit(None).cast("string").alias("url"), F.col("turn").cast("string").alias("title")))
    headings = F.create_map(F.when(F.col("turn") % 2 == 0, "Public Comments").otherwise("Other"), listing)
    group = F.struct(F.lit("T").alias("title"), F.when(F.col("turn") == 0, "S7").otherwise("").alias("file_no"), headings.alias("headings"))
    dockets = c.groupBy(F.col("conv_id").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", group.alias("g"))), lambda a, b_: F.when(a["turn"] < b_["turn"], -1).when(a["turn"] > b_["turn"], 1).otherwise(0)), lambda x: x["g"]).alias("groups"))
    return normalize.flatten_listings(dockets).select(F.col("id").alias("doc_id"), F.col("title").cast("int").alias("n"), "subtype")


@register("select doc_id from documents where doc_id % 4 = 0")
def p24_keep_own_release(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.array((F.col("doc_id") % 4).cast("string")).alias("releases"), F.lit("0").alias("docket_release"))
    return normalize.keep_own_release(d).select("doc_id")
