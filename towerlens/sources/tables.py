"""Driver tables (Parquet, one file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; column pruning, filter pushdown and the splits come from Spark."""
    return spark.read.parquet(table_path(sf_dir, name))
