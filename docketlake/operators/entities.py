"""Named entities in texts: alias lists, alias filtering, and matching by token windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketlake.functions.text import held, submitter_string, words
from docketlake.operators.automaton import Automaton, matcher
from docketlake.session import ship, written


def list_aliases(entities: DataFrame, column: str = "filtered_aliases") -> DataFrame:
    """(alias, entity_id) of every alias."""
    return entities.select(F.explode(column).alias("alias"), "entity_id").distinct()


def filter_aliases(entities: DataFrame, common: DataFrame) -> DataFrame:
    """``entities`` with filtered_aliases: those aliases whose lower-case form is no common word or name (column ``word``)."""
    rows = entities.select("entity_id", F.posexplode("aliases").alias("pos", "alias")).withColumn("word", F.lower("alias"))
    left = rows.join(common.select(F.lower("word").alias("word")).distinct(), "word", "left_anti")
    kept = left.groupBy("entity_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "alias"))), lambda x: x["alias"]).alias("filtered_aliases"))
    return entities.drop("filtered_aliases").join(kept, "entity_id", "left").withColumn("filtered_aliases", F.coalesce("filtered_aliases", F.array().cast("array<string>")))


#: Words of all aliases up to which they are one automaton: some 40 bytes a word, so 20 MB at most are broadcast.
AUTOMATON_WORDS = 500_000


def match(texts: DataFrame, aliases: DataFrame, *, blacklist: DataFrame | None = None, most_words: int = AUTOMATON_WORDS) -> DataFrame:
    """(doc_id, entity_id), distinct: an alias matches where its words, of any number, stand in a row in a text.

    Aliases (alias, entity_id) are put in the text's own word form. Up to ``most_words`` words in all, and as many owners, they are broadcast as an automaton that
    texts stream through; beyond that, texts and aliases meet in a join on first words (see ``match_by_join``). Null and empty texts and aliases match nothing.
    """
    known = _known(aliases, blacklist)
    size = known.agg(F.count("*"), F.sum(F.size("w"))).first()
    if max(size[0], size[1] or 0) > most_words:
        return match_by_join(texts, known)
    ship(texts.sparkSession)
    kind = known.schema["entity_id"].dataType
    table = known.groupBy("w").agg(F.collect_set("entity_id").alias("owners")).toArrow()  # at most most_words words and owners
    owners = table["owners"].combine_chunks()
    context = texts.sparkSession.sparkContext
    automaton = context.broadcast(Automaton.build(table["w"].to_pylist()))
    held_by = context.broadcast((owners.offsets.to_numpy().astype("int64"), owners.flatten()))
    tokens = texts.select("doc_id", words("text").alias("t"))
    schema = T.StructType([T.StructField("doc_id", texts.schema["doc_id"].dataType), T.StructField("entity_id", kind)])
    return tokens.mapInArrow(matcher(automaton, held_by), schema).distinct()


def _known(aliases: DataFrame, blacklist: DataFrame | None) -> DataFrame:
    """(entity_id, w: an alias's words), distinct, without those of the blacklist."""
    known = aliases.select("entity_id", words("alias").alias("w")).where((F.size("w") > 0) & F.col("entity_id").isNotNull()).distinct()
    return known if blacklist is None else known.join(blacklist.select(words("alias").alias("w")).distinct(), "w", "left_anti")


def match_by_join(texts: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, entity_id), distinct, for alias tables of any size: places where an alias's first two words stand are found by a join on these, and those of
    a text are then held against its words. Only the two words of a place move, not windows of every length."""
    known = written(known.withColumn("head", F.array_join(F.slice("w", 1, 2), " ")), "aliases")
    tokens = written(texts.select("doc_id", held(words("text")).alias("t")).where(F.size("t") > 0), "tokens")
    pairs = tokens.select("doc_id", "t", F.posexplode("t").alias("pos", "one"))
    second = F.get("t", F.col("pos") + 1)
    heads = pairs.select("doc_id", "pos", F.explode(F.array_distinct(F.array("one", F.coalesce(F.concat("one", F.lit(" "), second), F.col("one"))))).alias("head"))
    places = heads.join(known.select("head", F.size("w").alias("n"), "w", "entity_id"), "head")
    short = places.where("n <= 2").select("doc_id", "entity_id")
    longer = places.where("n > 2").select("doc_id", "pos", "n", "w", "entity_id").join(tokens, "doc_id").where(F.slice("t", F.col("pos") + 1, F.col("n")) == F.col("w")).select("doc_id", "entity_id")
    return short.unionByName(longer).distinct()


def submitter_matches(docs: DataFrame, aliases: DataFrame, *, title_source: str | None = None, blacklist: DataFrame | None = None) -> DataFrame:
    """(doc_id, entity_id) of the entities that a document's submitter may be: those of its organization, name, representative and what its title says
    of the sender; for submissions and other documents of ``title_source`` those of the whole title. No match crosses from one to another."""
    d = lambda k: F.element_at("details", F.lit(k))
    whole = F.coalesce((F.col("source") == title_source) & F.col("type").isin("public_submission", "other"), F.lit(False)) if title_source else F.lit(False)
    by = submitter_string(d("Organization_Name"), d("First_Name"), d("Last_Name"), d("Submitter_Representative"), F.col("title"), whole)
    return match(docs.select("doc_id", by.alias("text")), aliases, blacklist=blacklist)


def explode_matches(docs: DataFrame) -> DataFrame:
    """(doc_id, object_id, type, kind, entity_id) of the entities of every view and attachment view; a document view without an
    object id has its file's stem."""
    stem = F.regexp_extract("v.file_path", r"([^/]*?)(?:\.[^./]*)?$", 1)
    own = docs.select("doc_id", F.explode("views").alias("v")).select("doc_id", F.coalesce("v.object_id", stem).alias("object_id"), F.col("v.type").alias("type"), F.lit("view").alias("kind"), F.explode("v.entities").alias("entity_id"))
    part = docs.select("doc_id", F.explode("attachments").alias("a")).select("doc_id", "a.object_id", F.explode("a.views").alias("v"))
    attached = part.select("doc_id", "object_id", F.col("v.type").alias("type"), F.lit("attachment").alias("kind"), F.explode("v.entities").alias("entity_id"))
    return own.unionByName(attached)


def upsert_entities(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Every incoming entity with its action (insert or update), and current ones that are not incoming as delete."""
    a, b = current.select("entity_id").withColumn("_old", F.lit(True)), incoming.withColumn("_new", F.lit(True))
    joined = b.join(a, "entity_id", "full_outer")
    action = F.when(F.col("_new").isNull(), "delete").when(F.col("_old").isNull(), "insert").otherwise("update")
    return joined.withColumn("action", action).drop("_old", "_new")


def mark_searchable(entities: DataFrame) -> DataFrame:
    """Organizations that are mentioned at all."""
    return entities.withColumn("searchable", F.coalesce((F.col("td_type") == "organization") & (F.col("n_total") > 0), F.lit(False)))
