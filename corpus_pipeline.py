"""Corpus pipeline: documents in, packed training sequences out.

Five stages, each one operator of :mod:`blotter.llm` on all that its predecessor
kept. Every stage's result is written as Parquet to the shared checkpoint folder
and read again as the next one's documents, so a lost executor costs no more than
the stage it interrupts. All stages but the last return the columns of
``documents``; ``n_chars``, where present, follows the text.

Null and empty texts fail the quality rules; repeated rows are copies of one
another, of which near-dedup keeps one; empty tables pass through; further
columns are carried to the last stage, which returns packing rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm import common, op2_decontaminate, op3_packing, op4_neardup, op6_quality, op7_suffix

NEAR_PERCENT = 80      # similarity of near duplicates, on shingles of five words
REPEAT_BYTES = 200     # repeated strings to take out: well below fifty words of running text
REPEAT_GRAM = 64


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the decision list learned from ``labels``."""
    return op6_quality.keep_documents(docs, common.table(spark, sf_dir, "labels"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the least doc_id) of each near-duplicate component."""
    return op4_neardup.keep_one(docs, percent=NEAR_PERCENT)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings that also stand elsewhere in the corpus."""
    out = op7_suffix.remove_repeats(docs, window=REPEAT_BYTES, gram=REPEAT_GRAM)
    if "n_chars" in out.columns:
        kind = dict(out.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.char_length("text").cast(kind))
    return out


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified overlap with a ``benchmark`` item."""
    return op2_decontaminate.clean_documents(docs, common.table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and place."""
    return op3_packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", minhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

# Learned rules, connected components and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
