"""Parquet table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Scan a Parquet table; filters and column choices reach the files."""
    return spark.read.parquet(path)
