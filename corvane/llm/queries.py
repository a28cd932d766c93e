"""The queries of the training-data operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontam, langid, line_dedup, mixing, near_dedup, quality, substring, token_count, token_store, url_rules
from .encoding import default_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.document_tokens(_table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(_table(spark, sf_dir, "documents"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"), weights=(3, 1, 2), epochs=1.5, cap=2.0)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(_table(spark, sf_dir, "documents"))


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.encode_documents(_table(spark, sf_dir, "documents"), default_path("byte_bpe_50k.json"), end_id=0, remembered=1_000_000)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.filter_urls(_table(spark, sf_dir, "pages"), url_rules.RULES, default="allow")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents"), min_docs=10, min_chars=1, keep_first=False, with_text=False)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality_rules, op2_near_dedup, op3_token_counts, op4_decontamination, op5_language_id, op6_mix_sources, op7_substring_dedup, op8_token_store, op9_url_filter, op10_line_dedup)}


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": quality.ORACLE, "op2_near_dedup": near_dedup.ORACLE, "op6_mix_sources": mixing.ORACLE, "op7_substring_dedup": substring.ORACLE, "op9_url_filter": url_rules.ORACLE, "op10_line_dedup": line_dedup.ORACLE}
