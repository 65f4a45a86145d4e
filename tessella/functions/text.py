"""Small text, time and array forms of the frame tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_value(line: Column) -> tuple[Column, Column]:
    """``key: value`` lines; a line with another colon or without one has null parts."""
    parts = F.split(line, ":")
    whole = F.size(parts) == 2
    return F.when(whole, F.trim(parts[0])), F.when(whole, F.trim(parts[1]))


def clock_seconds(clock: Column) -> Column:
    """Seconds of ``H:M:S.f``."""
    parts = F.split(clock, ":")
    return F.get(parts, 0).cast("double") * 3600 + F.get(parts, 1).cast("double") * 60 + F.get(parts, 2).cast("double")


def caption(phrases: Column) -> Column:
    """Phrases as one detector prompt, each closed with a full stop."""
    return F.concat(F.array_join(phrases, ". "), F.lit("."))


def cross_fade_weights(n: Column) -> Column:
    """Inner points of an even division of [0, 1]: weights of the later window over an overlap of n frames."""
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: i / (n + 1))).otherwise(F.array().cast("array<double>"))


def blend_weights(n: Column) -> Column:
    """An even division of [0, 1] with both ends."""
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: i / F.greatest(n - 1, F.lit(1)))


def best_span(tokens: Column, scores: Column, stop: str = ".") -> Column:
    """The words between stops whose scores sum highest; the first of equals."""
    start = F.struct(F.lit("").alias("words"), F.lit(0.0).alias("sum"), F.lit("").alias("best"), F.lit(float("-inf")).alias("top"))

    def close(s: Column) -> Column:
        better = (s["sum"] > s["top"]) & (s["words"] != "")
        return F.struct(F.lit("").alias("words"), F.lit(0.0).alias("sum"), F.when(better, s["words"]).otherwise(s["best"]).alias("best"), F.when(better, s["sum"]).otherwise(s["top"]).alias("top"))

    def step(s: Column, x: Column) -> Column:
        longer = F.struct(F.when(s["words"] == "", x["token"]).otherwise(F.concat_ws(" ", s["words"], x["token"])).alias("words"), (s["sum"] + x["score"]).alias("sum"), s["best"].alias("best"), s["top"].alias("top"))
        return F.when(x["token"] == stop, close(s)).otherwise(longer)

    pairs = F.zip_with(tokens, scores, lambda a, b: F.struct(a.alias("token"), b.cast("double").alias("score")))
    return F.aggregate(pairs, start, step, lambda s: close(s)["best"])
