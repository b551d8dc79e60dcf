"""Registered queries: rollups, rankings and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketlake.operators import stats
from docketlake.plans import bindings as b
from docketlake.plans.registry import register
from docketlake.session import spread, table, written

WITH = f"with {b.DOCS}"
BOTH = f"with {b.DOCS}, {b.ENTITIES}, mentions as (select distinct e.doc_id, e.entity_id, e.mention, d.agency, d.docket_id, d.date_posted, d.type from doc_entities e join docs d using (doc_id))"
SCALARS = f"count(*) as n_docs, cast(sum({b.EXPANDED}) as bigint) as n_comments, cast(min(date_posted) as varchar) as first_date, cast(max(date_posted) as varchar) as last_date"


def text_dates(df):
    return df.withColumns({c: F.col(c).cast("string") for c, t in df.dtypes if t == "date"})


@register(f"{WITH} select docket_id, {SCALARS} from docs where docket_id is not null group by docket_id")
def a1_docket_stats(spark, sf_dir):
    return text_dates(stats.scalars(b.docs(spark, sf_dir), "docket_id"))


@register(f"{WITH} select agency, {SCALARS} from docs group by agency")
def a2_agency_stats(spark, sf_dir):
    return text_dates(stats.scalars(b.docs(spark, sf_dir), "agency"))


@register(f"{WITH} select comment_on_id, {SCALARS} from docs where type = 'public_submission' group by comment_on_id")
def a3_commented_doc_stats(spark, sf_dir):
    return text_dates(stats.scalars(stats.commented_docs(b.docs(spark, sf_dir)), "comment_on_id"))


def _mentions(spark, sf_dir):
    return stats.entity_documents(b.docs(spark, sf_dir), b.doc_entities(spark, sf_dir))


def _mentions_by(spark, sf_dir, *keys):
    """Mentions by keys that are nearly as many as themselves: counts made before the exchange would save little of it and hold them all."""
    return spread(_mentions(spark, sf_dir), table(spark, sf_dir, "lineitem"), *keys)


@register(f"{BOTH} select entity_id, mention, count(*) as n_docs, cast(min(date_posted) as varchar) as first_date, cast(max(date_posted) as varchar) as last_date from mentions group by entity_id, mention")
def a4_entity_stats(spark, sf_dir):
    return text_dates(stats.entity_scalars(_mentions(spark, sf_dir)))


@register(f"{BOTH} select entity_id, mention, agency, count(*) as n from mentions group by all")
def a4_entity_agencies(spark, sf_dir):
    return _mentions_by(spark, sf_dir, "entity_id", "mention", "agency").groupBy("entity_id", "mention", "agency").agg(F.count("*").alias("n"))


@register(f"{WITH} select doc_id, cast({b.EXPANDED} as bigint) as expanded from docs")
def a5_expanded_comment_count(spark, sf_dir):
    return stats.with_expanded(b.docs(spark, sf_dir)).select("doc_id", "expanded")


@register(f"{WITH} select docket_id, 'type' as metric, coalesce(type, 'None') as bucket, count(*) as n from docs group by all")
def a6_type_breakdown(spark, sf_dir):
    return stats.type_breakdown(b.docs(spark, sf_dir), "docket_id")


@register(f"{WITH} select docket_id, 'week' as metric, cast(cast(date_trunc('week', date_posted) as date) as varchar) as bucket, count(*) as n from docs group by all")
def a7_docket_weeks(spark, sf_dir):
    return stats.weeks(b.docs(spark, sf_dir), "docket_id")


@register(f"{WITH} select agency, 'month' as metric, strftime(date_posted, '%Y-%m') as bucket, count(*) as n from docs group by all")
def a7_agency_months(spark, sf_dir):
    return stats.months(b.docs(spark, sf_dir), "agency")


@register(f"{WITH} select type, cast(min(date_posted) as varchar) as first_date, cast(max(date_posted) as varchar) as last_date from docs group by type")
def a8_date_range(spark, sf_dir):
    return text_dates(b.docs(spark, sf_dir).groupBy("type").agg(F.min("date_posted").alias("first_date"), F.max("date_posted").alias("last_date")))


@register(f"{BOTH} select entity_id, count(*) filter (mention = 'text') as n_text, count(*) filter (mention = 'submitter') as n_submitter, count(*) as n_total from mentions group by entity_id")
def a9_entity_document_frequency(spark, sf_dir):
    return stats.entity_totals(_mentions(spark, sf_dir))


@register(f"{BOTH} select entity_id, mention, agency, strftime(date_posted, '%Y-%m') as month, count(*) as n from mentions group by all")
def a10_entity_matrix(spark, sf_dir):
    return stats.entity_matrix(_mentions_by(spark, sf_dir, "entity_id", "mention", "agency"))


@register(f"{WITH} select docket_id, 'week' as metric, cast(cast(date_trunc('week', date_posted) as date) as varchar) as bucket, count(*) as n from docs group by all")
def a11_merged_weeks(spark, sf_dir):
    """Stored statistics of even documents merged with those of odd ones: the same as one full run."""
    docs = b.docs(spark, sf_dir)
    old, new = (stats.weeks(docs.where(F.col("doc_id") % 2 == k), "docket_id") for k in (0, 1))
    return stats.merge_histograms(old, new)


@register(f"{WITH} select docket_id, {SCALARS} from docs group by docket_id")
def a11_merged_scalars(spark, sf_dir):
    docs = b.docs(spark, sf_dir)
    old, new = (stats.scalars(docs.where(F.col("doc_id") % 2 == k), "docket_id") for k in (0, 1))
    return text_dates(stats.merge_scalars(old, new, "docket_id"))


@register(f"""{WITH}, a as (select docket_id, agency, count(*) as k from docs group by all), r as (select docket_id, count(*) as n_agencies, min(agency) as least,
  min(agency) filter (starts_with(cast(docket_id as varchar), agency)) as begins from a group by docket_id) select docket_id, coalesce(begins, least) as agency, cast(n_agencies as int) as n_agencies from r""")
def a12_derive_dockets(spark, sf_dir):
    return stats.derive_dockets(b.docs(spark, sf_dir))


@register("select source as docket_id, min(lang) as agency, cast(count(distinct lang) as int) as n_agencies from documents group by source")
def a12_derive_dockets_of_texts(spark, sf_dir):
    return stats.derive_dockets(b.texts(spark, sf_dir))


@register(f"{WITH} select type, cast(max(date_posted) as varchar) as high_water from docs group by type")
def a13_high_water_date(spark, sf_dir):
    return text_dates(stats.high_water_date(b.docs(spark, sf_dir), "type"))


@register(f"{BOTH}, c as (select docket_id, mention, entity_id, count(*) as n from mentions group by all) select docket_id, mention, string_agg(entity_id || ': ' || n, '; ' order by n desc, entity_id) as entities, count(*) as n_entities from c group by docket_id, mention")
def a15_docket_report(spark, sf_dir):
    return stats.entity_report(_mentions_by(spark, sf_dir, "docket_id", "mention"), "docket_id")


@register("select conv_id as doc_id, cast(sum(n) as bigint) as n_bytes from (select conv_id, role, max(octet_length(encode(text))) as n from conversations group by all) group by conv_id")
def a15_longest_text_bytes(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return stats.longest_text_bytes(c.select(F.col("conv_id").alias("doc_id"), F.col("role").alias("attachment"), "text"))


@register(f"{BOTH}, c as (select agency, mention, entity_id, count(*) as n from mentions where mention = 'submitter' group by all) select agency, mention, string_agg(entity_id || ': ' || n, '; ' order by n desc, entity_id) as entities, count(*) as n_entities from c group by agency, mention")
def a16_agency_report(spark, sf_dir):
    return stats.entity_report(_mentions(spark, sf_dir).where("mention = 'submitter'"), "agency")


@register(f"{BOTH} select entity_id, p_name as name, count(*) as n from mentions join part on p_partkey = entity_id where mention = 'text' group by entity_id, p_name")
def j16_name_entity_counts(spark, sf_dir):
    counts = _mentions(spark, sf_dir).where("mention = 'text'").groupBy("entity_id").agg(F.count("*").alias("n"))
    names = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("entity_id"), F.array("p_name").alias("aliases"))
    return stats.name_entity_counts(counts, names)


@register("select event_type as action, count(*) as n from events group by event_type")
def a17_run_counters(spark, sf_dir):
    return stats.run_counters(table(spark, sf_dir, "events").withColumnRenamed("event_type", "action"))


@register("select event_type as action, count(*) as n from events group by event_type")
def a17_observed_counters(spark, sf_dir):
    """Counts that come with writing the rows elsewhere, without a second scan."""
    kinds = ("view", "signup", "click", "error", "purchase")
    counted, told = stats.observed_counters(table(spark, sf_dir, "events"), "event_type", kinds)
    written(counted, "events")
    return spark.createDataFrame([(k, n) for k, n in told.get.items() if n], "action string, n long")


def _recent_sql(types: str, k: int, key: str = "docket_id") -> str:
    return f"{WITH}, r as (select {key}, doc_id, cast(date_posted as varchar) as date_posted, row_number() over (partition by {key} order by date_posted desc nulls last, doc_id) as rank from docs where type in ({types})) select {key}, doc_id, date_posted, cast(rank as int) as rank from r where rank <= {k}"


@register(_recent_sql("'other'", 3))
def w1_recent_other(spark, sf_dir):
    return text_dates(stats.recent(b.docs(spark, sf_dir), "docket_id", 3, ("other",)).select("docket_id", "doc_id", "date_posted", "rank"))


@register(_recent_sql("'public_submission'", 5, "comment_on_id"))
def w1_recent_comments(spark, sf_dir):
    return text_dates(stats.recent(b.docs(spark, sf_dir), "comment_on_id", 5, ("public_submission",)).select("comment_on_id", "doc_id", "date_posted", "rank"))


@register(_recent_sql("'public_submission'", 5, "comment_on_id"))
def a11_merged_recent(spark, sf_dir):
    """The recent comments of even documents merged with those of odd ones: the same as one full run."""
    docs = b.docs(spark, sf_dir)
    old, new = (stats.recent_rows(docs.where(F.floor(F.col("doc_id") / 3) % 2 == k), "comment_on_id", 5, ("public_submission",)) for k in (0, 1))
    return text_dates(stats.merge_recent(old, new, "comment_on_id", 5))


@register(_recent_sql("'notice', 'rule', 'proposed_rule'", 2147483647))
def w2_fr_docs(spark, sf_dir):
    return text_dates(stats.fr_docs(b.docs(spark, sf_dir), "docket_id").select("docket_id", "doc_id", "date_posted", "rank"))


@register(f"""{WITH}, r as (select *, case when type in ('rule', 'proposed_rule', 'notice') then 0 when type = 'other' then 1 end as o from docs),
  k as (select *, row_number() over (partition by docket_id order by o nulls last, date_posted nulls last, doc_id) as r from r)
  select docket_id, case when o is not null then 'Document ' || doc_id else cast(docket_id as varchar) end as title from k where r = 1""")
def w3_name_dockets(spark, sf_dir):
    return stats.name_dockets(b.docs(spark, sf_dir).withColumn("title", F.concat(F.lit("Document "), F.col("doc_id").cast("string"))))


@register(f"{WITH}, r as (select docket_id, doc_id, date_posted, max(date_posted) over (partition by docket_id) as last_date from docs) select docket_id, doc_id, cast(date_posted as varchar) as date_posted from r where date_posted > last_date - 7")
def w12_last_seven(spark, sf_dir):
    return text_dates(stats.last_days(b.docs(spark, sf_dir), "docket_id").select("docket_id", "doc_id", "date_posted"))


@register(f"{WITH}, s as (select docket_id as id, count(*) as n from docs where docket_id % 3 <> 0 group by docket_id) select c.c_custkey as id, c_name as name, s.n as n from customer c left join s on s.id = c.c_custkey union all select s.id, null, s.n from s where s.id not in (select c_custkey from customer)")
def k7_upsert_stats_full(spark, sf_dir):
    target = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit(-1).cast("long").alias("n"))
    new = b.docs(spark, sf_dir).where("docket_id % 3 <> 0").groupBy(F.col("docket_id").alias("id")).agg(F.count("*").alias("n"))
    return stats.upsert(target, new, "id", clear_missing=True)


@register(f"{WITH}, s as (select docket_id as id, count(*) as n from docs where docket_id % 3 <> 0 group by docket_id) select c.c_custkey as id, c_name as name, coalesce(s.n, -1) as n from customer c left join s on s.id = c.c_custkey")
def k7_upsert_stats_incremental(spark, sf_dir):
    target = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit(-1).cast("long").alias("n"))
    new = b.docs(spark, sf_dir).where("docket_id % 3 <> 0").groupBy(F.col("docket_id").alias("id")).agg(F.count("*").alias("n"))
    return stats.upsert(target, new, "id", clear_missing=False)


@register("""with k as (select conv_id, turn, role, sum(case when role = 'user' then 1 else 0 end) over (partition by conv_id order by turn) as n from conversations)
  select conv_id, turn, max(case when role = 'user' then turn end) over (partition by conv_id order by turn rows between unbounded preceding and current row) as section from k""")
def w16_sections(spark, sf_dir):
    from docketlake.operators.resolve import assign_sections

    c = table(spark, sf_dir, "conversations")
    return assign_sections(c, "conv_id", "turn", F.when(F.col("role") == "user", F.col("turn"))).select("conv_id", "turn", "section")


@register(f"{WITH} select agency, docket_id, doc_id from docs")
def w15_ordered_listing(spark, sf_dir):
    d = b.docs(spark, sf_dir).select("agency", "docket_id", "doc_id")
    return d.repartition("agency", "docket_id").sortWithinPartitions("agency", "docket_id", "doc_id")


@register(f"""{BOTH}, g as (select entity_id, 'agency' as grain, agency as key, count(*) as n from mentions group by all
  union all select entity_id, 'docket', cast(docket_id as varchar), count(*) from mentions group by all) select * from g""")
def e3_grains(spark, sf_dir):
    """Two grains from each mention in one pass."""
    pairs = F.explode(F.array(F.struct(F.lit("agency").alias("grain"), F.col("agency").alias("key")), F.struct(F.lit("docket").alias("grain"), F.col("docket_id").cast("string").alias("key")))).alias("g")
    rows = _mentions(spark, sf_dir).select("entity_id", pairs).select("entity_id", "g.grain", "g.key")
    return spread(rows, table(spark, sf_dir, "lineitem"), "entity_id", "grain", "key").groupBy("entity_id", "grain", "key").agg(F.count("*").alias("n"))
