"""Tables that cut lineage, and bounded membership filters.

Everything is written below ``spark.checkpoint.dir`` through Spark's own
writers, so it works on any store that Spark can reach and survives the loss
of an executor.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A membership filter has 2**SLOT_BITS rows of 64 bits at most: 8 MB.
SLOT_BITS = 19


#: Bytes of one Arrow batch for a Python worker; long texts would make batches of many rows very large.
BATCH_BYTES = 8 << 20


def arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """df.mapInArrow in batches of bounded size, by workers that give their free memory back after each task."""

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            trim()

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if df.sparkSession.conf.get(key) == "67108864b":  # its default
        df.sparkSession.conf.set(key, f"{BATCH_BYTES}b")
    return df.mapInArrow(tidy, schema)


def trim() -> None:
    """Return what this process has freed; workers live longer than tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    release = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if release is not None:
        release(0)


def root(spark: SparkSession) -> str:
    """The shared folder of this cluster; a temporary one only in local mode without the setting."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="tessella-")
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found.rstrip('/')}/tessella-{sc.applicationId}"


#: The folders, one in the other, in which tables are written now.
_scopes: list[str] = []


@contextlib.contextmanager
def scope() -> Iterator[str]:
    """Tables written inside lie in a folder of their own, which ``discard`` deletes when results that read them are written."""
    name = f"work-{uuid.uuid4().hex}"
    _scopes.append(name)
    try:
        yield name
    finally:
        _scopes.remove(name)


def discard(spark: SparkSession, name: str) -> None:
    """Delete the tables of a scope, or one table."""
    _delete(spark, f"{root(spark)}/{name}")


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, tag: str, name: str | None = None) -> DataFrame:
    """df written once as Parquet in the shared folder and read back; later readers recompute nothing."""
    spark = df.sparkSession
    path = "/".join([root(spark), *_scopes, name or f"{tag}-{uuid.uuid4().hex}"])
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_row(docs: DataFrame, stage: Callable[[DataFrame], DataFrame], nulls_first: bool) -> DataFrame:
    """stage(docs) with decisions that hold for single rows, where ids are null or repeated too.

    If there are such ids, the stage sees row numbers instead of them, in the
    order of the ids and written once; equal ids are in the order of their texts.
    """
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null")
    if not ids.limit(1).count():
        return stage(docs)
    order = F.asc_nulls_first("doc_id") if nulls_first else F.asc_nulls_last("doc_id")
    keys = [order, F.asc("__digest"), F.asc("__at")]
    rows = docs.withColumn("__digest", F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)).withColumn("__at", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__id", F.col("doc_id")).withColumn("doc_id", F.monotonically_increasing_id())
    kept = stage(materialize(rows.drop("__digest", "__at"), "rows"))
    return kept.withColumn("doc_id", F.col("__id")).select(docs.columns)


def release(spark: SparkSession) -> None:
    """Delete this application's scratch tables; results that still read them become invalid."""
    _delete(spark, root(spark))


def _slot(key: str):
    return F.xxhash64(F.lit("slot"), F.col(key)).bitwiseAND((1 << SLOT_BITS) - 1)


def _bit(key: str):
    return F.shiftrightunsigned(F.xxhash64(F.lit("slot"), F.col(key)), SLOT_BITS).bitwiseAND(63).cast("int")


def marked(rows: DataFrame, ids: DataFrame, key: str, flag: str) -> DataFrame:
    """rows with a boolean column flag: false means that key is surely not among ids.

    One bit for each hash value of the ids, kept in at most 2**SLOT_BITS rows
    whatever the number of ids, so the broadcast has a fixed bound. Where the
    filter fills up, more rows are marked and later joined exactly.
    """
    words = ids.where(F.col(key).isNotNull()).select(_slot(key).alias("__slot"), F.expr(f"shiftleft(1L, {_bit_sql(key)})").alias("__b")).groupBy("__slot").agg(F.bit_or("__b").alias("__bits"))
    out = rows.withColumn("__slot", _slot(key)).join(F.broadcast(words), "__slot", "left")
    hit = F.coalesce(F.expr(f"(shiftrightunsigned(__bits, {_bit_sql(key)}) & 1L) = 1L"), F.lit(False))
    return out.withColumn(flag, hit).drop("__slot", "__bits")


def _bit_sql(key: str) -> str:
    return f"cast(shiftrightunsigned(xxhash64('slot', `{key}`), {SLOT_BITS}) & 63 as int)"


def only(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose key is among ids (distinct). Only rows that pass the bounded filter are shuffled."""
    return marked(rows, ids, key, "__hit").where("__hit").drop("__hit").join(ids.select(key), key, "left_semi")


def without(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not among ids; rows outside the bounded filter are not shuffled. A null key stays."""
    names = rows.columns
    flagged = marked(rows, ids, key, "__hit")
    clear = flagged.where("not __hit").select(names)
    return clear.unionByName(flagged.where("__hit").select(names).join(ids.select(key), key, "left_anti").select(names))
