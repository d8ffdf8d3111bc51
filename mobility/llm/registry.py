"""The registered queries of this subpackage, with DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mobility.llm import (
    align,
    decontaminate,
    edit_counts,
    jaccard_join,
    langid,
    packing,
    pii,
    quality,
    secret_scan,
    spelling,
    suffix_dedup,
    tokenfile,
    topk,
)
from mobility.llm.common import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.query(table(spark, sf_dir, "documents"))


def op2_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.query(spark, table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.query(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.query(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.query(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.query(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.query(table(spark, sf_dir, "documents"))


def op9_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_counts.query(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.query(table(spark, sf_dir, "documents"))


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.query(table(spark, sf_dir, "embeddings"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.query(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.query(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": op1_language_id,
        "op2_token_file": op2_token_file,
        "op3_pii": op3_pii,
        "op4_quality_rules": op4_quality_rules,
        "op5_decontamination": op5_decontamination,
        "op6_suffix_dedup": op6_suffix_dedup,
        "op7_best_fit_packing": op7_best_fit_packing,
        "op8_secret_scan": op8_secret_scan,
        "op9_edit_counts": op9_edit_counts,
        "op10_jaccard_join": op10_jaccard_join,
        "op11_topk_search": op11_topk_search,
        "op12_token_alignment": op12_token_alignment,
        "op13_spelling_variants": op13_spelling_variants,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_quality_rules": quality.ORACLE,
        "op5_decontamination": decontaminate.ORACLE,
        "op11_topk_search": topk.ORACLE,
    }
