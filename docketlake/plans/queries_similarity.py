"""Registered queries: n-grams, pairs, clusters and entity matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketlake.functions.text import words
from docketlake.operators import entities, similarity
from docketlake.plans import bindings as b
from docketlake.plans.registry import register
from docketlake.session import table, written

TOKENS = r"tokens as (select doc_id, list_filter(string_split(regexp_replace(lower(text), '\W', ' ', 'g'), ' '), lambda x: x <> '') as t from documents)"
GRAMS = f"{TOKENS}, grams as (select distinct doc_id, array_to_string(t[i : i + 3], ' ') as gram from (select doc_id, t, unnest(range(1, len(t) - 2)) as i from tokens)), sizes as (select doc_id, count(*) as n from grams group by doc_id)"
SETS = f"{GRAMS}, sets as (select doc_id, list(gram order by gram) as g from grams group by doc_id), classes as (select d.doc_id, coalesce(max(s2.doc_id), d.doc_id) as class_id from documents d left join sets s on s.doc_id = d.doc_id left join sets s2 on s2.g = s.g group by d.doc_id)"
PAIRS = f"""{SETS}, reps as (select doc_id from sets where doc_id in (select class_id from classes)), rg as (select g.* from grams g join reps using (doc_id)),
  pairs as (select x.doc_id as a, y.doc_id as b, count(*) as overlap from rg x join rg y on x.gram = y.gram and x.doc_id > y.doc_id group by x.doc_id, y.doc_id),
  near as (select a, b, overlap, overlap / (sa.n + sb.n - overlap) as jaccard from pairs join sizes sa on sa.doc_id = a join sizes sb on sb.doc_id = b where overlap / (sa.n + sb.n - overlap) >= 0.5)"""


def _sets(spark, sf_dir):
    return similarity.gram_sets(table(spark, sf_dir, "documents"))


def _classes(spark, sf_dir):
    return similarity.exact_classes(_sets(spark, sf_dir))


def _base(spark, sf_dir):
    """Gram sets, not written, the representatives of their classes with grams, and the pairs with jaccard 0.5 or more, as written tables."""
    sets = similarity.hashed_sets(table(spark, sf_dir, "documents"))
    sized = written(similarity.representatives(sets), "reps")
    reps = sized.select("doc_id")
    return sets, reps, written(similarity.similar_pairs(sets, 0.5, sized), "near")


def _near(spark, sf_dir):
    return _base(spark, sf_dir)[2]


@register(f"with {GRAMS} select d.doc_id, coalesce(s.n, 0) as n_grams from documents d left join sizes s using (doc_id)")
def c1_ngrams(spark, sf_dir):
    return _sets(spark, sf_dir).select("doc_id", F.col("size").cast("long").alias("n_grams"))


@register(f"with {SETS} select doc_id, class_id from classes")
def c5_exact_classes(spark, sf_dir):
    return _classes(spark, sf_dir)


@register(f"with {PAIRS} select a, b, overlap, round(jaccard, 6) as jaccard from near")
def j14_similar_pairs(spark, sf_dir):
    p = _near(spark, sf_dir)
    return p.select("a", "b", F.col("overlap").cast("long").alias("overlap"), F.round("jaccard", 6).alias("jaccard"))


#: Components by eight rounds of least labels over a table of links: more than the supplied tables' chains need.
_ROUNDS = ", ".join(f"c{k + 1} as materialized (select c.doc_id, least(c.c, coalesce(min(n.c), c.c)) as c from c{k} c left join links l on l.x = c.doc_id left join c{k} n on n.doc_id = l.y group by c.doc_id, c.c)" for k in range(8))
CLUSTERS = f"""with {PAIRS.replace("near as (", "near as materialized (").replace("reps as (", "reps as materialized (")}, links as materialized (select a as x, b as y from near union select b, a from near),
  c0 as materialized (select doc_id, doc_id as c from reps), {_ROUNDS}, comp as (select doc_id, c as cluster_id from c8)"""


def _clusters(spark, sf_dir):
    _, reps, near = _base(spark, sf_dir)
    return similarity.single_link(near, reps, 0.5)


@register(f"{CLUSTERS} select doc_id, cluster_id from comp")
def c7_single_link(spark, sf_dir):
    return _clusters(spark, sf_dir)


@register(f"{CLUSTERS}, m as (select cluster_id, count(*) as size, min(doc_id) as first_doc, max(doc_id) as last_doc from comp group by cluster_id) select cluster_id, size, first_doc, last_doc from m")
def a18_cluster_members(spark, sf_dir):
    return similarity.cluster_members(_clusters(spark, sf_dir))


@register(f"{CLUSTERS}, m as (select cluster_id, count(*) as size, min(doc_id) as first_doc, max(doc_id) as last_doc from comp group by cluster_id having count(*) > 1) select cluster_id, size, first_doc, last_doc, cast(row_number() over (order by size desc, cluster_id) - 1 as int) as number from m")
def w10_cluster_ranking(spark, sf_dir):
    return similarity.cluster_ranking(_clusters(spark, sf_dir))


#: The pair table's edges taken one by one, the closest first, with the clusters' labels as a list.
MERGES = f"""with recursive {PAIRS.replace("near as (", "near as materialized (").replace("reps as (", "reps as materialized (")}, nodes as materialized (select doc_id, row_number() over (order by doc_id) as k from reps),
  e as materialized (select row_number() over (order by 1 - jaccard, a desc, b desc) as n, a, b, 1 - jaccard as distance, p.k as x, q.k as y from near join nodes p on p.doc_id = a join nodes q on q.doc_id = b),
  taken(n, lab, took) as (select 0, (select list(k order by k) from nodes), false union all
    select e.n, case when t.lab[e.x] <> t.lab[e.y] then list_transform(t.lab, lambda v: case when v = t.lab[e.y] then t.lab[e.x] else v end) else t.lab end, t.lab[e.x] <> t.lab[e.y] from taken t join e on e.n = t.n + 1),
  forest as (select a, b, distance from e join taken t on t.n = e.n where t.took),
  labels as (select unnest(lab) as c, generate_subscripts(lab, 1) as k from taken where n = (select max(n) from taken)),
  tops as (select max(doc_id) as b from labels join nodes using (k) group by c),
  merges as (select a, b, distance from forest union all select (select max(b) from tops), b, 1.0 from tops where b < (select max(b) from tops))"""


@register(f"{MERGES} select row_number() over (order by distance, a desc, b desc) - 1 as step, a, b, round(distance, 6) as distance from merges")
def c7_merge_order(spark, sf_dir):
    _, reps, near = _base(spark, sf_dir)
    return similarity.merge_order(similarity.merge_forest(near), reps).withColumn("distance", F.round("distance", 6))


#: Components at distance 0.3, as CLUSTERS at 0.5.
CUT = CLUSTERS.replace("select a as x, b as y from near union select b, a from near", "select a as x, b as y from near where 1 - jaccard <= 0.3 union select b, a from near where 1 - jaccard <= 0.3")


def _cut(spark, sf_dir):
    _, reps, near = _base(spark, sf_dir)
    return near, written(similarity.cut(similarity.merge_forest(near), reps, 0.3), "clusters")


@register(f"{CUT} select doc_id, cluster_id from comp")
def c7_cut_forest(spark, sf_dir):
    return _cut(spark, sf_dir)[1]


LARGEST = "largest as (select cluster_id as seed from comp group by cluster_id order by count(*) desc, cluster_id limit 1)"


def _largest(clusters):
    return similarity.cluster_members(clusters).orderBy(F.desc("size"), "cluster_id").first()["first_doc"]


@register(f"{CUT}, {LARGEST}, ends as (select max(doc_id) as other, (select cluster_id from comp where doc_id = (select max(doc_id) from comp)) as gone from comp) select doc_id, case when cluster_id = gone then seed else cluster_id end as cluster_id from comp, largest, ends")
def c6_merge(spark, sf_dir):
    """The largest cluster takes that of the last document."""
    clusters = _cut(spark, sf_dir)[1]
    return similarity.merge(clusters, _largest(clusters), clusters.agg(F.max("doc_id")).first()[0])


@register(f"{CUT}, {LARGEST} select doc_id from comp, largest where cluster_id = seed")
def c8_cluster_of(spark, sf_dir):
    clusters = _cut(spark, sf_dir)[1]
    return similarity.cluster_of(clusters, _largest(clusters))


@register(f"""{CUT}, {LARGEST}, inside as materialized (select doc_id from comp, largest where cluster_id = seed), both_ as (select a, b, jaccard from near union all select b, a, jaccard from near),
  d as (select a, min(1 - jaccard) as d from both_ where b in (select doc_id from inside) group by a),
  next as (select c.cluster_id from comp c left join d on d.a = c.doc_id where c.doc_id not in (select doc_id from inside) order by coalesce(d.d, 1.0), c.doc_id limit 8)
  select doc_id, false as joins from inside union all select doc_id, true from comp where cluster_id in (select cluster_id from next)""")
def c10_propose_growth(spark, sf_dir):
    """The largest cluster at distance 0.3 with the clusters of its eight closest outsiders."""
    near, clusters = _cut(spark, sf_dir)
    return similarity.propose_growth(near, clusters, _largest(clusters), 8)


SEEDS = "seeds as (select doc_id from reps where doc_id % 50 = 7)"


@register(f"""with {PAIRS}, {SEEDS}, both_ as (select a, b, jaccard from near union all select b, a, jaccard from near), d as (select a, min(1 - jaccard) as d from both_ where b in (select doc_id from seeds) group by a)
  select r.doc_id, round(coalesce(d.d, 1.0), 6) as distance from reps r left join d on d.a = r.doc_id where r.doc_id not in (select doc_id from seeds) order by coalesce(d.d, 1.0), r.doc_id limit 25""")
def w7_closest_neighbors(spark, sf_dir):
    _, reps, near = _base(spark, sf_dir)
    found = similarity.closest_neighbors(near, reps, reps.where("doc_id % 50 = 7"), 25)
    return found.select("doc_id", F.round("distance", 6).alias("distance"))


@register(f"with {PAIRS} select a, b, round(1 - jaccard, 6) as distance from near order by 1 - jaccard, a desc, b desc limit 1")
def w8_min_link(spark, sf_dir):
    _, reps, near = _base(spark, sf_dir)
    alone = reps.withColumn("cluster_id", F.col("doc_id"))
    return similarity.min_link(near, alone).select("a", "b", F.round("distance", 6).alias("distance"))


@register(f"with {PAIRS} select a, b, round(1 - jaccard, 6) as distance from near order by jaccard, a desc, b desc limit 1")
def w9_farthest_listed_pair(spark, sf_dir):
    ids = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").alias("pos"))
    return similarity.extreme_pair(_near(spark, sf_dir), ids, closest=False).select("a", "b", F.round("distance", 6).alias("distance"))


@register(f"""with {PAIRS}, k as (select count(*) as k from reps), s as (select count(*) as m, sum(1 - jaccard) as t, min(1 - jaccard) as low from near)
  select round(coalesce(low, 1.0), 6) as smallest, round((coalesce(t, 0) + k * (k - 1) / 2 - m) / (k * (k - 1) / 2), 6) as mean, 1.0 as largest from s, k""")
def a14_pair_stats(spark, sf_dir):
    _, reps, near = _base(spark, sf_dir)
    got = similarity.pair_stats(near, reps)
    return got.select(*(F.round(c, 6).alias(c) for c in got.columns))


@register(f"with {PAIRS} select a, b, round(1 - jaccard, 6) as distance from near where a % 2 = 0 and b % 2 = 0")
def c9_submatrix(spark, sf_dir):
    evens = table(spark, sf_dir, "documents").where("doc_id % 2 = 0").select("doc_id")
    return similarity.submatrix(_near(spark, sf_dir), evens).select("a", "b", F.round("distance", 6).alias("distance"))


@register(f"with {GRAMS}, p as (select doc_id, t, unnest(range(1, len(t) - 2)) as i from tokens), f as (select array_to_string(t[i : i + 3], ' ') as gram, min((doc_id, i)) as place from p group by 1) select gram, row_number() over (order by place) as gram_id from f")
def w13_gram_ids(spark, sf_dir):
    return similarity.text_gram_ids(table(spark, sf_dir, "documents"))


ALIASES = r"aliases as (select item_id as entity_id, array_to_string((list_filter(string_split(regexp_replace(lower(text), '\W', ' ', 'g'), ' '), lambda x: x <> ''))[5:8], ' ') as alias from benchmark)"


def _aliases(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("entity_id"), F.array_join(F.slice(words("text"), 5, 4), " ").alias("alias"))


@register(f"with {TOKENS}, {ALIASES} select distinct d.doc_id, a.entity_id from tokens d join aliases a on contains(' ' || array_to_string(d.t, ' ') || ' ', ' ' || a.alias || ' ') where a.alias <> ''")
def j12_match_entities(spark, sf_dir):
    return entities.match(table(spark, sf_dir, "documents"), _aliases(spark, sf_dir))


@register(rf"with {TOKENS}, a as (select item_id as entity_id, array_to_string(list_filter(string_split(regexp_replace(lower(text), '\W', ' ', 'g'), ' '), lambda x: x <> ''), ' ') as alias from benchmark) select distinct d.doc_id, a.entity_id from tokens d join a on contains(' ' || array_to_string(d.t, ' ') || ' ', ' ' || a.alias || ' ') where a.alias <> ''")
def j12_match_passages(spark, sf_dir):
    """Aliases of any length: whole passages, by the join that tables of any size take."""
    aliases = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("entity_id"), F.col("text").alias("alias"))
    return entities.match(table(spark, sf_dir, "documents"), aliases, most_words=0)


@register("with w as (select distinct lower(split_part(p_name, ' ', 1)) as word from part where p_partkey % 3 = 0) select p_partkey as entity_id, p_name as alias from part where lower(p_name) not in (select word from w)")
def j13_filter_aliases(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    common = part.where("p_partkey % 3 = 0").select(F.split("p_name", " ")[0].alias("word"))
    got = entities.filter_aliases(part.select(F.col("p_partkey").alias("entity_id"), F.array("p_name").alias("aliases")), common)
    return got.select("entity_id", F.explode("filtered_aliases").alias("alias"))


@register("select s_name as alias, s_suppkey as entity_id from supplier")
def p21_list_aliases(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    return entities.list_aliases(s.select(F.col("s_suppkey").alias("entity_id"), F.array("s_name").alias("filtered_aliases")))


@register("select coalesce(i.k, c.k) as entity_id, case when i.k is null then 'delete' when c.k is null then 'insert' else 'update' end as action from (select p_partkey as k from part where p_partkey % 5 <> 0) c full join (select p_partkey as k from part where p_partkey % 3 <> 0) i on i.k = c.k")
def j4_upsert_entities(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("entity_id"), F.col("p_name").alias("td_name"))
    return entities.upsert_entities(part.where("entity_id % 5 <> 0"), part.where("entity_id % 3 <> 0")).select("entity_id", "action")


@register("select p_partkey as entity_id, p_size % 2 = 0 and n > 30 as searchable from part join (select l_partkey, count(*) as n from lineitem group by 1) on l_partkey = p_partkey")
def u5_mark_searchable(spark, sf_dir):
    counts = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("entity_id")).agg((F.count("*") - 30).alias("n_total"))
    kind = F.when(F.col("p_size") % 2 == 0, "organization").otherwise("individual")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("entity_id"), kind.alias("td_type"))
    return entities.mark_searchable(part.join(counts, "entity_id")).select("entity_id", "searchable")
