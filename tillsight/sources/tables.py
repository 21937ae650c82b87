"""Parquet table access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One Parquet dataset per table; scans stay lazy so Catalyst prunes
    columns and pushes filters into the reader."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
