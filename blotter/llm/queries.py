"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import op1_token_counts, op10_warc, op11_merkle, op12_collocations as op12, op13_simhash as op13, op2_decontaminate, op3_packing, op4_neardup, op5_binary, op6_quality, op7_suffix, op8_chat, op9_html, oracles
from .common import table


def op1_token_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_packing.pack_documents(table(spark, sf_dir, "documents"))


def op4_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_binary.write_and_read(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_suffix.removals(table(spark, sf_dir, "documents"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "\\### Assistant: </turn> ok"  # the contract's added conversation
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").selectExpr("cast(conv_id as long) conv_id", "cast(turn as long) turn", "role", "text")
    return op8_chat.write_and_read(rows.unionByName(extra))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_html.extract(table(spark, sf_dir, "pages"))


def op10_warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_warc.write_and_read(table(spark, sf_dir, "pages"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_merkle.verify_tampered(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12.collocations(table(spark, sf_dir, "documents"))


def op13_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13.near_duplicates(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": op1_token_counts_query,
        "op2_decontamination": op2_decontamination,
        "op3_best_fit_packing": op3_best_fit_packing,
        "op4_minhash_neardup": op4_minhash_neardup,
        "op5_binary_output": op5_binary_output,
        "op6_quality_rules": op6_quality_rules,
        "op7_suffix_dedup": op7_suffix_dedup,
        "op8_chat_format": op8_chat_format,
        "op9_html_extraction": op9_html_extraction,
        "op10_warc": op10_warc_query,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_collocations": op12_collocations,
        "op13_simhash_neardup": op13_simhash_neardup,
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
