"""A training corpus from documents: quality rules, toxicity, near-duplicates, repeated passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docketlake.llm import minhash, packing, quality, substring, toxicity
from docketlake.session import intermediate, table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, with all columns. Null and empty texts go; repeated rows are judged alike; an empty table stays empty."""
    return quality.keep_good(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, by a model learned from those that are labelled, with all columns. Null and empty texts stay, having no
    evidence; without usable labels all stay; repeated rows are judged alike; an empty table stays empty."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group (five-word shingles, similarity 0.8 or more), with all columns. Null and
    empty texts and null ids are in no group and stay; rows that share the kept id all stay; an empty table stays empty."""
    return minhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand in an earlier one, with all columns; n_chars is counted anew. A document that is all repetition
    keeps its row with an empty text; null texts and null ids are left as they are; an empty table stays empty."""
    return substring.deduplicate(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens; a first line bears no loss. A null or empty text is the end id alone; repeated
    rows are packed each; an empty table gives no rows."""
    return packing.pack(docs, first_line_is_context=True)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", drop_toxic),
    ("MinHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("packing", packed),
]

#: Signatures, alignments, learned scores and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Each stage's documents are written to the shared folder and read again; its own tables are then deleted."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        with intermediate(spark):
            docs = stage(spark, docs, sf_dir)
            docs = written(docs, "stage", keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
