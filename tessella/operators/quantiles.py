"""Exact quantiles of groups of any size.

A group of at most HELD rows is sorted where it meets (the built-in aggregate
keeps its distinct values). Of larger ones no task holds a column: the bracket
of a wanted rank is cut into BINS, counted with partial sums, and narrowed to
the bin that holds the rank, until few values or one are left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.lineage import cut

HELD, BINS = 1 << 20, 1 << 10
#: Values of a bracket that are sorted together.
LAST = 1 << 12


def quantiles(rows: DataFrame, keys: list[str], columns: dict[str, Column], probabilities: list[float], lower: bool = False) -> DataFrame:
    """For each group an array of the quantiles of every column, over its values that are not null.

    Values between two ranks are interpolated; with lower the quantile is a
    value itself, the first whose share reaches the probability.
    """
    plain = rows.select(*keys, *[c.cast("double").alias(n) for n, c in columns.items()])
    counts = plain.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    large = cut(counts.where(F.col("_n") > HELD).drop("_n").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.lit(True).alias("_large")))
    if not large.limit(1).count():
        return _held(plain, keys, list(columns), probabilities, lower)
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] or [F.lit(True)]
    on = same[0]
    for x in same[1:]:
        on = on & x
    marked = plain.join(large if keys else F.broadcast(large), on, "left").drop(*[f"_k{i}" for i in range(len(keys))])
    small = _held(marked.where("_large is null").drop("_large"), keys, list(columns), probabilities, lower)
    refined = _refined(marked.where("_large").drop("_large"), keys, list(columns), probabilities, lower)
    return refined if not keys else small.unionByName(refined)


def _held(rows: DataFrame, keys: list[str], names: list[str], probabilities: list[float], lower: bool) -> DataFrame:
    if not lower:
        return rows.groupBy(*keys).agg(*[F.percentile(n, F.array(*[F.lit(float(p)) for p in probabilities])).alias(n) for n in names])
    own = lambda n: F.array(*[F.expr(f"percentile_disc({float(p)}) within group (order by `{n}`)") for p in probabilities]).alias(n)
    return rows.groupBy(*keys).agg(*[own(n) for n in names])


def _refined(rows: DataFrame, keys: list[str], names: list[str], probabilities: list[float], lower: bool) -> DataFrame:
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("x")) for n in names]))
    values = rows.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], pairs.alias("_v")).select(*[f"_k{i}" for i in range(len(keys))], "_v.name", "_v.x").where("x is not null")
    group = [*[f"_k{i}" for i in range(len(keys))], "name"]
    total = values.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    at = lambda p: F.col("n") * p if lower else (F.col("n") - 1) * p
    rank = lambda p: [F.greatest(F.ceil(at(p)) - 1, F.lit(0))] if lower else [F.floor(at(p)), F.ceil(at(p))]
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(*[r.cast("long") for r in rank(p)]) for p in probabilities])))
    total = cut(total)
    wanted = cut(total.select(*group, F.explode(ranks).alias("rank"), "lo", "hi", F.lit(0).cast("long").alias("below"), F.col("n").alias("inside")))
    found = None
    while True:
        done = wanted.where("lo = hi").select(*group, "rank", F.col("lo").alias("value"))
        few = wanted.where(f"lo < hi and inside <= {LAST}")
        met = _met(values, few, group)
        picked = met.groupBy(*group, "rank", "below").agg(F.sort_array(F.collect_list("x")).alias("xs")).select(*group, "rank", F.get("xs", (F.col("rank") - F.col("below")).cast("int")).alias("value"))
        part = cut(done.unionByName(picked))
        found = part if found is None else found.unionByName(part)
        wide = wanted.where(f"lo < hi and inside > {LAST}")
        if not wide.limit(1).count():
            break
        place = F.least(F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BINS), F.lit(BINS - 1))
        bins = _met(values, wide, group).select(*group, "rank", "below", place.alias("bin"), "x")
        sums = bins.groupBy(*group, "rank", "below", "bin").agg(F.count(F.lit(1)).alias("inside"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        # At most BINS rows of a rank.
        upto = F.sum("inside").over(Window.partitionBy(*group, "rank").orderBy("bin"))
        ranked = sums.withColumn("upto", F.col("below") + upto)
        wanted = cut(ranked.where((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("inside") <= F.col("rank"))).select(*group, "rank", "lo", "hi", (F.col("upto") - F.col("inside")).alias("below"), "inside"))
    held = found.groupBy(*group).agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("values"))
    both = total.withColumnsRenamed({c: f"_t_{c}" for c in group}).join(held, [F.col(f"_t_{c}").eqNullSafe(F.col(c)) for c in group])
    one = lambda r: F.element_at("values", r.cast("long"))

    def value(p: float) -> Column:
        if lower:
            return one(rank(p)[0])
        a, b = rank(p)
        return one(a) + (one(b) - one(a)) * (at(p) - F.floor(at(p)))

    shown = both.select(*group, F.array(*[value(p) for p in probabilities]).alias("q"))
    wide = shown.groupBy(*group[:-1]).agg(*[F.max(F.when(F.col("name") == n, F.col("q"))).alias(n) for n in names])
    return wide.withColumnsRenamed({f"_k{i}": k for i, k in enumerate(keys)})


def _met(values: DataFrame, brackets: DataFrame, group: list[str]) -> DataFrame:
    """Values with the brackets of their group that hold them."""
    named = brackets.withColumnsRenamed({c: f"_t_{c}" for c in group})
    on = F.col(group[0]).eqNullSafe(F.col(f"_t_{group[0]}"))
    for c in group[1:]:
        on = on & F.col(c).eqNullSafe(F.col(f"_t_{c}"))
    return values.join(named, on).where("x between lo and hi").drop(*[f"_t_{c}" for c in group])
