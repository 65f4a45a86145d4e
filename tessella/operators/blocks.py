"""Sparse block matrices in long form: a row (i, j, val) for each scalar entry, with any number of group keys before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def coalesced(m: DataFrame, keys: tuple[str, ...] = ("i", "j")) -> DataFrame:
    """Entries of equal place summed."""
    return m.groupBy(*keys).agg(F.sum("val").alias("val"))


def transposed_product(a: DataFrame, b: DataFrame) -> DataFrame:
    """A^T B: rows meet on their row number, products of equal places are summed before they are shuffled."""
    left = a.select("i", F.col("j").alias("ja"), F.col("val").alias("va"))
    right = b.select("i", F.col("j").alias("jb"), F.col("val").alias("vb"))
    return left.join(right, "i").groupBy(F.col("ja").alias("i"), F.col("jb").alias("j")).agg(F.sum(F.col("va") * F.col("vb")).alias("val"))


def gram(a: DataFrame) -> DataFrame:
    """A^T A, of which only the upper half is formed by the join."""
    left = a.select("i", F.col("j").alias("ja"), F.col("val").alias("va"))
    right = a.select("i", F.col("j").alias("jb"), F.col("val").alias("vb"))
    upper = left.join(right, "i").where("ja <= jb").groupBy("ja", "jb").agg(F.sum(F.col("va") * F.col("vb")).alias("val"))
    lower = upper.where("ja < jb").select(F.col("jb").alias("i"), F.col("ja").alias("j"), "val")
    return upper.select(F.col("ja").alias("i"), F.col("jb").alias("j"), "val").unionByName(lower)


def transposed_vector(a: DataFrame, v: DataFrame) -> DataFrame:
    """A^T v for a vector (i, val)."""
    right = v.select("i", F.col("val").alias("vv"))
    return a.join(right, "i").groupBy(F.col("j").alias("i")).agg(F.sum(F.col("val") * F.col("vv")).alias("val"))


def product(a: DataFrame, b: DataFrame) -> DataFrame:
    left = a.select("i", F.col("j").alias("k"), F.col("val").alias("va"))
    right = b.select(F.col("i").alias("k"), "j", F.col("val").alias("vb"))
    return left.join(right, "k").groupBy("i", "j").agg(F.sum(F.col("va") * F.col("vb")).alias("val"))


def transpose(m: DataFrame) -> DataFrame:
    return m.select(F.col("j").alias("i"), F.col("i").alias("j"), "val")


def plus(a: DataFrame, b: DataFrame, sign: float = 1.0, keys: tuple[str, ...] = ("i", "j")) -> DataFrame:
    """a + sign * b."""
    return coalesced(a.select(*keys, "val").unionByName(b.select(*keys, (F.col("val") * sign).alias("val"))), keys)


def damped(m: DataFrame, damping: float | Column, eps: float) -> DataFrame:
    """The diagonal grows by eps and a share of itself (a number), or by eps and a column's value."""
    more = F.lit(eps) + (F.col("val") * damping if isinstance(damping, (int, float)) else damping)
    return m.withColumn("val", F.col("val") + F.when(F.col("i") == F.col("j"), more).otherwise(0.0))


def diagonal_inverse(m: DataFrame) -> DataFrame:
    """The inverse of a matrix that has a diagonal only."""
    return m.where("i = j").select("i", "j", (1 / F.col("val")).alias("val"))


def schur(h: DataFrame, e: DataFrame, c: DataFrame) -> DataFrame:
    """H - E C^-1 E^T for a diagonal C: (i, j) of H, (i, k) of E, (k, k) of C."""
    inverse = diagonal_inverse(c).select(F.col("i").alias("k"), F.col("val").alias("ci"))
    left = e.select("i", F.col("j").alias("k"), F.col("val").alias("a")).join(inverse, "k").withColumn("a", F.col("a") * F.col("ci"))
    right = e.select(F.col("i").alias("j"), F.col("j").alias("k"), F.col("val").alias("b"))
    eliminated = left.join(right, "k").groupBy("i", "j").agg(F.sum(F.col("a") * F.col("b")).alias("val"))
    return plus(h, eliminated, -1.0)


def dense_numbers(m: DataFrame, groups: list[str], block: str, size: int) -> DataFrame:
    """Blocks with dense numbers within their group and the scalar row at which each begins."""
    w = Window.partitionBy(*groups).orderBy(block)
    ids = m.select(*groups, block).distinct().withColumn("dense", F.row_number().over(w) - 1)
    return m.join(ids, [*groups, block]).withColumn("row", F.col("dense") * size)
