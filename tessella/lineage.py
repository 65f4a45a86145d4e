"""Cutting the lineage of iterative operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The checkpoint folder that the session names; a temporary one only in local mode without it."""
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="tessella-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """df computed once and written to the checkpoint folder."""
    folder(df.sparkSession)
    return df.checkpoint()
