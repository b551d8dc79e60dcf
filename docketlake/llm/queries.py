"""Registered queries of the numbered operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.llm import bpe, conversations, extraction, langid, media, minhash, negatives, packing, quality, records, smallworld, substring, toxicity
from docketlake.session import scratch, table


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), first_line_is_context=True)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels.where(~held_out(F.col("doc_id"))))
    found = toxicity.score(docs, model).withColumn("held_out", held_out(F.col("doc_id")))
    return found.select("doc_id", "held_out", "score", "predicted")


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents")).drop("class_distance", "common_distance")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), settings=minhash.Settings(words=4))


def op7_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "records")
    index = records.write_records(table(spark, sf_dir, "documents"), folder=folder)
    return records.with_global_start(records.read_records(index, folder), index).select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out(F.col("doc_id")))
    model = langid.learn(docs.where("not held_out"))
    found = langid.predict(docs, model)
    return found.withColumn("held_out", held_out(F.col("doc_id"))).select("doc_id", "held_out", "lang_pred", "score")


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.through_media(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    return conversations.summaries(conversations.repair(conversations.damaged(given), given))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, label = table(spark, sf_dir, "embeddings"), F.col("label")
    moved = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return negatives.mine(moved, F.col("vec_id") % 50 == 0)


def op13_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return smallworld.near_vectors(table(spark, sf_dir, "embeddings")).links


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_packing, op2_toxicity, op3_substrings, op4_bpe, op5_quality, op6_near_duplicates, op7_records, op8_language, op9_main_text, op10_media, op11_conversations, op12_negatives, op13_embeddings)}


def oracle_sql() -> dict[str, str]:
    return {"op5_quality": quality.oracle_sql(), "op12_negatives": negatives.oracle_sql()}
