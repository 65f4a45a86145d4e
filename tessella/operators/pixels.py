"""Rasters as pixel rows (keys, v, u, value): morphology, resizing, sampling, masks, pyramids."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.functions.lie import Quat, q_act
from tessella.operators.joins import bilinear, dot_product, knn


def _spread(rows: DataFrame, low: int, high: int) -> DataFrame:
    """Each pixel at all places from low to high around it."""
    at = lambda c: F.explode(F.sequence(F.col(c) + low, F.col(c) + high)).alias(c)
    rest = [c for c in rows.columns if c not in ("u", "v")]
    return rows.select(*rest, at("v"), "u").select(*rest, "v", at("u"))


def eroded(rows: DataFrame, keys: list[str], value: str, size: int) -> DataFrame:
    """The least value of a square around each pixel; beyond the border the nearest pixels count, so borders do not erode."""
    return _pooled(rows, keys, value, size, F.min)


def dilated(rows: DataFrame, keys: list[str], value: str, size: int) -> DataFrame:
    return _pooled(rows, keys, value, size, F.max)


def _pooled(rows: DataFrame, keys: list[str], value: str, size: int, f) -> DataFrame:
    k = size // 2
    pooled = _spread(rows.select(*keys, "v", "u", value), -k, size - 1 - k).groupBy(*keys, "v", "u").agg(f(value).alias(value))
    return rows.drop(value).join(pooled, [*keys, "v", "u"])


def nearest_resized(rows: DataFrame, keys: list[str], height: int, width: int, new_height: int, new_width: int) -> DataFrame:
    """The raster at another size by its nearest pixels: places round half to even and stay inside."""
    spark = rows.sparkSession
    place = lambda c, n, m: F.least(F.greatest(F.bround((F.col(c) + 0.5) * n / m - 0.5), F.lit(0)), F.lit(n - 1)).cast("int")
    grid = spark.range(new_height * new_width).select(F.floor(F.col("id") / new_width).cast("int").alias("nv"), (F.col("id") % new_width).cast("int").alias("nu"))
    grid = grid.withColumns({"v": place("nv", height, new_height), "u": place("nu", width, new_width)})
    return rows.join(F.broadcast(grid), ["v", "u"]).drop("v", "u").withColumnsRenamed({"nv": "v", "nu": "u"})  # the grid is one raster


def cropped(rows: DataFrame, top: int, bottom: int, left: int, right: int) -> DataFrame:
    """Pixels with top <= v < bottom and left <= u < right, moved to the new corner."""
    inside = rows.where((F.col("v") >= top) & (F.col("v") < bottom) & (F.col("u") >= left) & (F.col("u") < right))
    return inside.withColumns({"v": F.col("v") - top, "u": F.col("u") - left})


def sky(rows: DataFrame, phrases: DataFrame, keys: list[str]) -> DataFrame:
    """Pixels with whether their instance's phrase is sky."""
    named = phrases.where("phrase = 'sky'").select(*keys, "instance").distinct().withColumn("_s", F.lit(True))
    return rows.join(named, [*keys, "instance"], "left").withColumn("sky", F.coalesce("_s", F.lit(False))).drop("_s")


def alignment_mask(confidence: Column, median: Column, is_sky: Column, depth: Column, metric: Column) -> Column:
    return (confidence >= median) & ~is_sky & (metric > 1e-2) & (depth > 1e-3)


def metric_of_focal(depth: Column, fx: Column, fy: Column, scale: float = 300.0) -> Column:
    return depth * (fx + fy) / 2 / scale


def display_range(rows: DataFrame, keys: list[str], frame: str, depth: str, is_sky: Column, widen: float = 1.3) -> DataFrame:
    """Bounds of inverse depth over a stream: the extremes of each frame's 5 % and 95 % quantiles, widened about their middle."""
    inverse = F.when((F.col(depth) > 0) & ~is_sky, 1 / F.col(depth))
    per = rows.groupBy(*keys, frame).agg(F.percentile(inverse, F.array(F.lit(0.05), F.lit(0.95))).alias("q"))
    both = per.groupBy(*keys).agg(F.min(F.col("q")[0]).alias("a"), F.max(F.col("q")[1]).alias("b"))
    middle, half = (F.col("a") + F.col("b")) / 2, (F.col("b") - F.col("a")) / 2 * widen
    return both.select(*keys, (middle - half).alias("low"), (middle + half).alias("high"))


def perspective_places(grid: DataFrame, focal: float, cx: float, cy: float, turn: Quat, width: int, height: int) -> DataFrame:
    """Where each pixel (v, u) of a perspective view looks in a panorama of a size: columns pu, pv."""
    from tessella.functions.camera import panorama_uv

    ray = ((F.col("u") - cx) / focal, (F.col("v") - cy) / focal, F.lit(1.0))
    rows = grid.withColumns({f"_r{a}": c for a, c in zip("xyz", q_act(turn, ray), strict=True)})
    u, v = panorama_uv((F.col("_rx"), F.col("_ry"), F.col("_rz")))
    return rows.withColumns({"pu": u * width - 0.5, "pv": v * height - 0.5}).drop("_rx", "_ry", "_rz")


def pooled_pyramid(corr: DataFrame, keys: list[str], value: str, levels: int) -> list[DataFrame]:
    """A raster and its halves: means of 2x2 pixels, rests beside whole pairs left out."""
    out = [corr.select(*keys, "v", "u", value)]
    for _ in range(levels - 1):
        up = out[-1].groupBy(*keys, F.floor(F.col("v") / 2).alias("v"), F.floor(F.col("u") / 2).alias("u")).agg(F.avg(value).alias(value), F.count(F.lit(1)).alias("_n"))
        out.append(up.where("_n = 4").drop("_n"))
    return out


def pyramid_lookup(levels: list[DataFrame], places: DataFrame, keys: list[str], u: str, v: str, value: str, radius: int = 3) -> DataFrame:
    """Values of every level in a window around each place: level, dv, du, value; outside counts 0."""
    out = None
    for n, level in enumerate(levels):
        wide = places.withColumn("dv", F.explode(F.sequence(F.lit(-radius), F.lit(radius)))).withColumn("du", F.explode(F.sequence(F.lit(-radius), F.lit(radius))))
        wide = wide.withColumns({"_x": F.col(u) / 2**n + F.col("du"), "_y": F.col(v) / 2**n + F.col("dv")})
        got = bilinear(level, wide, keys, "_x", "_y", [value]).drop("_x", "_y").withColumn("level", F.lit(n))
        out = got if out is None else out.unionByName(got)
    return out


def patch_correlation(a: DataFrame, b: DataFrame, keys: list[str], feature: str, radius: int) -> DataFrame:
    """Dot products of each pixel's feature with those of the other raster's pixels within a square: dv, du, corr."""
    left = a.select(*keys, "v", "u", F.col(feature).alias("_a"))
    wide = left.withColumn("dv", F.explode(F.sequence(F.lit(-radius), F.lit(radius)))).withColumn("du", F.explode(F.sequence(F.lit(-radius), F.lit(radius))))
    other = b.select(*keys, F.col("v").alias("_v"), F.col("u").alias("_u"), F.col(feature).alias("_b"))
    ask = wide.withColumns({"_v": F.col("v") + F.col("dv"), "_u": F.col("u") + F.col("du")})
    return ask.join(other, [*keys, "_v", "_u"]).select(*keys, "v", "u", "dv", "du", dot_product(F.col("_a"), F.col("_b")).alias("corr"))


#: Depths at or below this are no measurement; pixels that the patterns ``cubic`` and ``distance`` sample; keypoints that ``keypoints`` needs.
LEAST_DEPTH, SAMPLED, LEAST_KEYPOINTS = 1e-4, 2000, 20
#: A scanner's points in a line, and the ends of its lines' pitch and of a line's yaw.
LIDAR_POINTS, LIDAR_PITCH, LIDAR_YAW = 200, 0.5, math.pi / 2.1


def _some(rows: DataFrame, keys: list[str], number: int, seed: int) -> DataFrame:
    """At most so many pixels of each raster, drawn by a hash of the place."""
    w = Window.partitionBy(*keys, F.lit(0)).orderBy(F.xxhash64(F.lit(seed), *keys, "v", "u"), "v", "u")
    return rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= number).drop("_r")


def lidar_pixels(spark: SparkSession, lines: int, width: int, height: int) -> DataFrame:
    """The pixels (v, u) that a scanner of so many lines hits, seen by a camera with the image's height as focal length."""
    turn = lambda n, m, end: F.lit(-end) if m == 1 else -end + F.col(n) * (2 * end / (m - 1))
    grid = spark.range(lines * LIDAR_POINTS).select(F.floor(F.col("id") / LIDAR_POINTS).alias("line"), (F.col("id") % LIDAR_POINTS).alias("point"))
    pitch, yaw = turn("line", lines, LIDAR_PITCH), turn("point", LIDAR_POINTS, LIDAR_YAW)
    rays = grid.select(F.sin(pitch).alias("y"), (F.cos(pitch) * F.sin(yaw)).alias("x"))
    z = F.sqrt(1 - F.col("x") * F.col("x") - F.col("y") * F.col("y"))
    place = lambda c, middle: F.bround((height * F.col(c) + middle * z) / (z + 1e-8)).cast("int")
    at = rays.select(place("y", height / 2).alias("v"), place("x", width / 2).alias("u")).distinct()
    return at.where((F.col("u") >= 0) & (F.col("u") < width) & (F.col("v") >= 0) & (F.col("v") < height))


def _downscaled(rows: DataFrame, keys: list[str], depth: str, factor: int, width: int, height: int) -> DataFrame:
    """A raster's depths at a smaller size (blanks filled from five neighbours, corners kept), at the pixels where that raster's rows and columns begin."""
    known = rows.where(F.col(depth) > LEAST_DEPTH).select(*keys, "v", "u", F.col(depth).alias("_z"), (F.col("v").cast("long") * width + F.col("u")).alias("_p"))
    blank = rows.where(~(F.col(depth) > LEAST_DEPTH)).select(*keys, "v", "u", (F.col("v").cast("long") * width + F.col("u")).alias("_q"))
    full = known.select(*keys, "v", "u", "_z")
    if blank.limit(1).count():
        near = knn(blank, known, keys, ["v", "u"], 5, None, "_q", "_p").join(known.select(*keys, "_p", "_z"), [*keys, "_p"])
        filled = near.groupBy(*keys, "_q").agg(F.avg("_z").alias("_z"))
        full = full.unionByName(filled.select(*keys, F.floor(F.col("_q") / width).cast("int").alias("v"), (F.col("_q") % width).cast("int").alias("u"), "_z"))
    low_h, low_w = height // factor, width // factor
    even = lambda n, m: F.col(n) * ((m[0] - 1) / (m[1] - 1)) if m[1] > 1 else F.lit(0.0)
    grid = rows.sparkSession.range(low_h * low_w).select(F.floor(F.col("id") / low_w).alias("a"), (F.col("id") % low_w).alias("b"))
    grid = grid.select(even("a", (height, low_h)).alias("y"), even("b", (width, low_w)).alias("x"), F.floor(F.col("a") * (height / low_h)).cast("int").alias("v"), F.floor(F.col("b") * (width / low_w)).cast("int").alias("u"))
    places = rows.select(*keys).distinct().join(F.broadcast(grid)) if keys else grid  # the grid is one small raster
    at = bilinear(full.withColumnRenamed("_z", "_d"), places.withColumnsRenamed({"v": "_tv", "u": "_tu"}), keys, "x", "y", ["_d"])
    return at.select(*keys, F.col("_tv").alias("v"), F.col("_tu").alias("u"), F.col("_d").alias("_low"))


def sparse_sample(rows: DataFrame, pattern: str, depth: str = "depth", width: int | None = None, height: int | None = None, seed: int = 0, keys: list[str] | None = None, keypoints: DataFrame | None = None) -> DataFrame:
    """The pixels of each raster that a named pattern keeps, with whether they belong to a cover (``cover``).

    ``N``: so many measured pixels, drawn by chance. ``downscale_k``: one pixel
    for each of the raster at a k-th of the size, with that raster's depth.
    ``cubic_k``: a square of k by k is cut out, SAMPLED of the rest are drawn.
    ``distance_a_b``: of the pixels strictly between two whole distances SAMPLED
    are drawn. ``LiDAR_n``: where n lines of a scanner hit. ``keypoints``: at
    the caller's keypoints (keys, x, y); few of them mean SAMPLED drawn ones.
    """
    keys = keys or []
    # Without a depth every pixel counts as measured.
    measured = rows.where(F.col(depth) > LEAST_DEPTH) if depth in rows.columns else rows
    uncovered = lambda df: df.withColumn("cover", F.lit(False))
    if re.fullmatch(r"\d+", pattern):
        return uncovered(_some(measured, keys, int(pattern), seed))
    if pattern == "keypoints" and keypoints is not None:
        at = keypoints.select(*keys, F.bround("y").cast("int").alias("v"), F.bround("x").cast("int").alias("u"))
        counts = keypoints.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        few = measured.join(counts, keys, "left") if keys else measured.join(F.broadcast(counts))
        few = few.withColumn("_n", F.coalesce("_n", F.lit(0)))
        exact = few.where(F.col("_n") >= LEAST_KEYPOINTS).drop("_n").join(at.distinct(), [*keys, "v", "u"], "left_semi")
        return uncovered(exact.unionByName(_some(few.where(F.col("_n") < LEAST_KEYPOINTS).drop("_n"), keys, SAMPLED, seed)))
    if m := re.fullmatch(r"distance_(\d+)_(\d+)", pattern):
        near = measured.where((F.col(depth) > int(m[1])) & (F.col(depth) < int(m[2])))
        return _some(near, keys, SAMPLED, seed).withColumn("cover", F.lit(True))
    if not (width and height):
        raise ValueError(f"no sampling pattern {pattern!r} without the raster's size")
    if m := re.fullmatch(r"LiDAR_(\d+)", pattern):
        return uncovered(measured.join(F.broadcast(lidar_pixels(rows.sparkSession, int(m[1]), width, height)), ["v", "u"], "left_semi"))  # one raster's pixels at most
    if m := re.fullmatch(r"cubic_(\d+)", pattern):
        k = int(m[1])
        if k >= min(width, height):
            raise ValueError(f"a square of {k} pixels needs a larger raster")
        corner = lambda n, size: F.pmod(F.xxhash64(F.lit(seed), F.lit(n), *keys), F.lit(size - k))
        hole = F.col("v").between(corner("v", height), corner("v", height) + k - 1) & F.col("u").between(corner("u", width), corner("u", width) + k - 1)
        return _some(measured.where(~hole), keys, SAMPLED, seed).withColumn("cover", F.lit(True))
    if m := re.fullmatch(r"downscale_(\d+)", pattern):
        low = _downscaled(rows, keys, depth, int(m[1]), width, height)
        return uncovered(measured.join(low, [*keys, "v", "u"]).where(F.col("_low") > LEAST_DEPTH).withColumn(depth, F.col("_low")).drop("_low"))
    raise ValueError(f"no sampling pattern {pattern!r}")
