"""The supplied tables as documents, dockets, entities and texts: the model's tables for the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.session import spread, table

#: The same bindings in SQL, for the twins.
DOCS = """docs as (select o.o_orderkey as doc_id, o.o_custkey as docket_id, n.n_name as agency,
  case substr(o.o_orderpriority, 1, 1) when '1' then 'public_submission' when '2' then case when o.o_orderkey % 4 = 0 then 'other' else 'public_submission' end
    when '3' then 'notice' when '4' then 'proposed_rule' else 'supporting_material' end as type,
  case when o.o_orderkey % 97 = 0 then null else cast(o.o_orderdate as date) end as date_posted,
  o.o_orderkey - o.o_orderkey % 10 as comment_on_id,
  case when o.o_orderkey % 11 = 0 then 'n/a' when o.o_orderkey % 7 = 0 then null else cast(o.o_orderkey % 13 as varchar) end as dup_count
  from orders o join customer c on o.o_custkey = c.c_custkey join nation n on c.c_nationkey = n.n_nationkey)"""
ENTITIES = """doc_entities as (select distinct l_orderkey as doc_id, l_partkey as entity_id, 'text' as mention from lineitem
  union all select distinct l_orderkey, l_suppkey, 'submitter' from lineitem where l_returnflag = 'R')"""
EXPANDED = "case when type = 'public_submission' then coalesce(try_cast(dup_count as bigint), 1) else 0 end"


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    key, priority = F.col("o_orderkey"), F.substring("o_orderpriority", 1, 1)
    kind = (
        F.when(priority == "1", "public_submission")
        .when(priority == "2", F.when(key % 4 == 0, "other").otherwise("public_submission"))
        .when(priority == "3", "notice")
        .when(priority == "4", "proposed_rule")
        .otherwise("supporting_material")
    )
    joined = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), c.c_nationkey == n.n_nationkey)  # nation is fixed at 25 rows
    return joined.select(
        key.alias("doc_id"),
        F.col("o_custkey").alias("docket_id"),
        F.col("n_name").alias("agency"),
        kind.alias("type"),
        F.when(key % 97 != 0, F.col("o_orderdate").cast("date")).alias("date_posted"),
        (key - key % 10).alias("comment_on_id"),
        F.when(key % 11 == 0, "n/a").when(key % 7 == 0, F.lit(None)).otherwise((key % 13).cast("string")).alias("dup_count"),
    )


def doc_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of each document, text and submitters in one pass over the line items, by document."""
    li = table(spark, sf_dir, "lineitem")
    entity = lambda key, mention: F.struct(F.col(key).alias("entity_id"), F.lit(mention).alias("mention"))
    both = F.array_compact(F.array(entity("l_partkey", "text"), F.when(F.col("l_returnflag") == "R", entity("l_suppkey", "submitter"))))
    return spread(li.select(F.col("l_orderkey").alias("doc_id"), F.explode(both).alias("e")).select("doc_id", "e.*"), li, "doc_id").distinct()


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", "text", F.col("source").alias("docket_id"), F.col("lang").alias("agency"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int")).alias("date_posted"))


def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with an array of views: the line items of an order, with states from flag and status."""
    li = table(spark, sf_dir, "lineitem")
    yes = F.when(F.col("l_linestatus") == "O", "no").when(F.col("l_returnflag") == "A", "failed").otherwise("yes")
    done = F.when(F.col("l_returnflag") == "R", "failed_extraction").when(F.col("l_linestatus") == "O", "no").otherwise("yes")
    parts = (F.col(c).cast("int").cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))
    url = F.concat(F.lit("http://files/"), F.concat_ws("/", *parts))
    kind = F.when(F.col("l_partkey") % 3 == 0, "pdf").when(F.col("l_partkey") % 3 == 1, "html").otherwise("txt")
    view = F.struct(F.col("l_linenumber").alias("n"), url.alias("url"), kind.alias("type"), yes.alias("downloaded"), done.alias("extracted"), F.col("l_quantity").cast("int").alias("size"))
    return li.groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.sort_array(F.collect_list(view)).alias("views"))


VIEWS = """views as (select l_orderkey as doc_id, l_linenumber as n, 'http://files/' || concat_ws('/', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity as int)) as url,
  case l_partkey % 3 when 0 then 'pdf' when 1 then 'html' else 'txt' end as type,
  case when l_linestatus = 'O' then 'no' when l_returnflag = 'A' then 'failed' else 'yes' end as downloaded,
  case when l_returnflag = 'R' then 'failed_extraction' when l_linestatus = 'O' then 'no' else 'yes' end as extracted, cast(l_quantity as int) as size from lineitem)"""
