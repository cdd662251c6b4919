"""Reading the tables of a directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One Parquet table (a file or a directory) below a root."""
    return spark.read.parquet(f"{root}/{name}.parquet")
