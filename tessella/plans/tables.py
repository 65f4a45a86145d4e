"""The driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def near(column: Column, digits: int = 6) -> Column:
    """Rounded, with one zero."""
    return F.round(column, digits) + 0.0
