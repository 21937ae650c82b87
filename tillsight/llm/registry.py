"""Registered queries of this package and the SQL that DuckDB runs for them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (chat, decontaminate, exact_dedup, line_dedup, line_hash, mixing, near_dedup, packing, periodic, quality,
               resample, suffix_dedup, toxicity)
from .common import table


def op1_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.report(table(spark, d, "documents"), table(spark, d, "labels"))


def op2_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    return line_dedup.report(table(spark, d, "pages"))


def op3_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.report(table(spark, d, "documents"))


def op4_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, d, "documents"))


def op5_suffix_dedup(spark: SparkSession, d: str) -> DataFrame:
    return suffix_dedup.report(table(spark, d, "documents"))


def op6_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return near_dedup.report(table(spark, d, "documents"))


def op7_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.report(table(spark, d, "documents"), table(spark, d, "labels"))


def op8_chat_format(spark: SparkSession, d: str) -> DataFrame:
    return chat.report(table(spark, d, "conversations"))


def op9_line_hash(spark: SparkSession, d: str) -> DataFrame:
    return line_hash.report(table(spark, d, "documents"))


def op10_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.report(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op11_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.report(table(spark, d, "documents"))


def op12_periodic_runs(spark: SparkSession, d: str) -> DataFrame:
    return periodic.report(table(spark, d, "documents"))


def op13_importance_resampling(spark: SparkSession, d: str) -> DataFrame:
    return resample.report(table(spark, d, "documents"), table(spark, d, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality, op2_line_dedup, op3_mixing, op4_exact_dedup, op5_suffix_dedup,
                                       op6_near_dedup, op7_toxicity, op8_chat_format, op9_line_hash, op10_decontaminate,
                                       op11_packing, op12_periodic_runs, op13_importance_resampling)}


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": line_dedup.SQL, "op4_exact_dedup": exact_dedup.SQL, "op5_suffix_dedup": suffix_dedup.SQL,
            "op6_near_dedup": near_dedup.SQL, "op9_line_hash": line_hash.SQL, "op10_decontaminate": decontaminate.SQL,
            "op13_importance_resampling": resample.SQL}
