"""Group-by-index reductions, dense over 0 .. size - 1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REDUCERS = ("sum", "add", "mul", "mean", "min", "max")


def _reduced(kind: str, value: Column, order: Column | None, whole: bool) -> dict[str, Column]:
    if kind in ("sum", "add"):
        return {"value": F.sum(value)}
    if kind == "mul":
        return {"value": F.product(value)}
    if kind == "mean":
        mean = F.sum(value) / F.greatest(F.count(value), F.lit(1))
        return {"value": F.floor(mean) if whole else mean}
    if kind in ("min", "max"):
        f, g = (F.min, F.min_by) if kind == "min" else (F.max, F.max_by)
        out = {"value": f(value)}
        if order is not None:
            # Of equal values the first in order.
            out["arg"] = g(order, F.struct(value, order if kind == "min" else -order))
        return out
    raise ValueError(f"no reducer {kind!r}; one of {', '.join(REDUCERS)}")


def scatter(rows: DataFrame, index: str, value: Column, kind: str, size: int | None = None, order: str | None = None, whole: bool = False, into: DataFrame | None = None) -> DataFrame:
    """index, value (and arg with an order column) for every index below size, or for those that occur.

    Empty groups are 0, or 1 for mul; their arg is the number of rows. With
    whole, means are rounded down as integers are. into (index, value) is a
    result to go on from, for sum and mul.
    """
    at = F.col(order) if order else None
    out = rows.groupBy(index).agg(*[c.alias(n) for n, c in _reduced(kind, value, at, whole).items()])
    if size is None and into is None:
        return out
    frame = rows.sparkSession.range(size).select(F.col("id").alias(index)) if size is not None else into.select(index)
    empty = F.lit(1 if kind == "mul" else 0)
    dense = frame.join(out, index, "left").withColumn("value", F.coalesce("value", empty))
    if "arg" in dense.columns:
        total = rows.agg(F.count(F.lit(1)).alias("_n"))  # one row
        dense = dense.join(F.broadcast(total)).withColumn("arg", F.coalesce("arg", "_n")).drop("_n")
    if into is not None:
        base = into.select(index, F.col("value").alias("_b"))
        mix = F.col("value") * F.coalesce("_b", empty) if kind == "mul" else F.col("value") + F.coalesce("_b", empty)
        dense = dense.join(base, index, "left").withColumn("value", mix).drop("_b")
    return dense


def segment_accumulate(rows: DataFrame, index: str, value: str, wanted: DataFrame) -> DataFrame:
    """Sums of the wanted indices alone."""
    return rows.join(wanted.select(index).distinct(), index).groupBy(index).agg(F.sum(value).alias(value))


def packed(counts: DataFrame, order: list[str], count: str, stream: str) -> DataFrame:
    """Start of each group in a packed table of its stream: the sum of the counts before it."""
    w = Window.partitionBy(stream).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("start", F.coalesce(F.sum(count).over(w), F.lit(0)))


def ravelled(rows: DataFrame, group: list[str], block: str, size: int) -> DataFrame:
    """Dense numbers of block ids within their group, and the first scalar row of each."""
    w = Window.partitionBy(*group).orderBy(block)
    return rows.select(*group, block).distinct().withColumn("dense", F.row_number().over(w) - 1).withColumn("row", F.col("dense") * size)
