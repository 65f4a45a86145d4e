"""Rasters (keys, v, u, values) resampled: other sizes, other cameras, panorama views, and frames seen from other poses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions import camera
from tessella.functions.lie import SE3, Quat
from tessella.operators.joins import splat
from tessella.operators.pixels import perspective_places


def _corners(x: Column, y: Column, width: int, height: int, clamp: bool) -> Column:
    """The four pixels around a place with their shares; with clamp those outside are the nearest inside."""
    x0, y0 = F.floor(x), F.floor(y)
    fx, fy = x - x0, y - y0
    held = lambda c, n: F.least(F.greatest(c, F.lit(0)), F.lit(n - 1)) if clamp else c
    one = lambda dx, dy: F.struct(held(x0 + dx, width).alias("u"), held(y0 + dy, height).alias("v"), ((fx if dx else 1 - fx) * (fy if dy else 1 - fy)).alias("w"))
    return F.array(*[one(dx, dy) for dy in (0, 1) for dx in (0, 1)])


def sampled(rows: DataFrame, places: DataFrame, keys: list[str], x: str, y: str, width: int, height: int, smooth: list[str] = [], nearest: list[str] = [], clamp: bool = False) -> DataFrame:  # noqa: B006
    """Values of a raster at places (keys, x and y in pixels, own columns): smooth ones between four pixels, nearest ones of the nearest pixel.

    Outside the raster smooth values count 0 and nearest ones are null; with clamp its border goes on.
    """
    own = [c for c in places.columns if c not in keys]
    grid = rows.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("u").cast("long").alias("_u"), F.col("v").cast("long").alias("_v"), *[F.col(c).alias(f"_g_{c}") for c in [*smooth, *nearest]])
    ask = places.select(*keys, *own, *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    on = [*[f"_k{i}" for i in range(len(keys))], "_u", "_v"]
    out = None
    if smooth:
        wide = ask.withColumn("_c", F.explode(_corners(F.col(x), F.col(y), width, height, clamp))).withColumns({"_u": F.col("_c.u"), "_v": F.col("_c.v"), "_w": F.col("_c.w")})
        met = wide.join(grid.select(*on, *[f"_g_{c}" for c in smooth]), on, "left")
        out = met.groupBy(*keys, *own).agg(*[F.sum(F.coalesce(F.col(f"_g_{c}") * F.col("_w"), F.lit(0.0))).alias(c) for c in smooth])
    if nearest:
        held = lambda c, n: F.least(F.greatest(c, F.lit(0)), F.lit(n - 1)) if clamp else c
        near = ask.withColumns({"_u": held(F.bround(F.col(x)).cast("long"), width), "_v": held(F.bround(F.col(y)).cast("long"), height)})
        met = near.join(grid.select(*on, *[f"_g_{c}" for c in nearest]), on, "left").select(*keys, *own, *[F.col(f"_g_{c}").alias(c) for c in nearest])
        out = met if out is None else out.join(met, [*keys, *own])
    return out


def resized(rows: DataFrame, keys: list[str], size: tuple[int, int], new_size: tuple[int, int], smooth: list[str] = [], nearest: list[str] = [], masks: list[str] = []) -> DataFrame:  # noqa: B006
    """A raster (size: width, height) at another size: smooth values bilinear, nearest ones of the pixel in front, masks where more than 0.9 of them is set."""
    (w, h), (nw, nh) = size, new_size
    grid = rows.sparkSession.range(nw * nh).select(F.floor(F.col("id") / nw).cast("int").alias("v"), (F.col("id") % nw).cast("int").alias("u"))
    every = rows.select(*keys).distinct().join(F.broadcast(grid)) if keys else grid  # the grid is one raster
    middle = lambda c, n, m: F.greatest((F.col(c) + 0.5) * (n / m) - 0.5, F.lit(0.0))
    places = every.withColumns({"_x": middle("u", w, nw), "_y": middle("v", h, nh)})
    shown = rows.withColumns({c: F.col(c).cast("double") for c in masks})
    out = sampled(shown, places, keys, "_x", "_y", w, h, [*smooth, *masks], clamp=True) if smooth or masks else places
    out = out.withColumns({c: F.col(c) > 0.9 for c in masks}).drop("_x", "_y")
    if nearest:
        front = every.withColumns({"_x": F.floor(F.col("u") * (w / nw)).cast("double"), "_y": F.floor(F.col("v") * (h / nh)).cast("double")})
        out = out.join(sampled(rows, front, keys, "_x", "_y", w, h, nearest=nearest, clamp=True).drop("_x", "_y"), [*keys, "v", "u"])
    return out


def rectification(grid: DataFrame, seen: camera.Pinhole | camera.Mei, shown: camera.Pinhole | camera.Mei) -> DataFrame:
    """Where each pixel (v, u) of a camera that is shown lies in the image of the camera that has seen: x, y in pixels of it."""
    u, v = seen.project(shown.unproject(F.col("u").cast("double"), F.col("v").cast("double")))
    return grid.withColumns({"x": u - 0.5, "y": v - 0.5})


def panorama_view(rows: DataFrame, keys: list[str], size: tuple[int, int], view: tuple[int, int], focal: float, turn: Quat, smooth: list[str], nearest: list[str] = []) -> DataFrame:  # noqa: B006
    """A perspective view (width, height) of a panorama of a size, with its centre in the middle: colours between pixels, labels of the nearest one."""
    width, height = view
    grid = rows.sparkSession.range(width * height).select(F.floor(F.col("id") / width).cast("int").alias("v"), (F.col("id") % width).cast("int").alias("u"))
    places = perspective_places(grid, focal, width / 2 - 0.5, height / 2 - 0.5, turn, *size)
    every = rows.select(*keys).distinct().join(F.broadcast(places)) if keys else places  # the grid is one view
    return sampled(rows, every, keys, "pu", "pv", *size, smooth, nearest, clamp=True).drop("pu", "pv")


def reprojected(rows: DataFrame, keys: list[str], depth: str, values: list[str], relative: SE3, source: camera.Pinhole, target: camera.Pinhole, width: int, height: int, mask: Column | None = None) -> DataFrame:
    """A frame as another camera sees it: keys, u, v, weight, values.

    relative takes points from the source's camera to the target's. Where
    several pixels meet, near ones outweigh far ones: a pixel's weight is
    exp(-50 log(1 + depth) / the frame's largest log(1 + depth)).
    """
    ray = source.unproject(F.col("u").cast("double"), F.col("v").cast("double"))
    moved = relative.act(tuple(c * F.col(depth) for c in ray))
    seen = rows.withColumns({f"_p{a}": c for a, c in zip("xyz", moved, strict=True)})
    log = F.log(1 + F.least(F.greatest(F.col("_pz"), F.lit(0.0)), F.lit(1000.0)))
    most = seen.groupBy(*keys).agg(F.max(log).alias("_most"))
    seen = seen.join(most, keys) if keys else seen.join(F.broadcast(most))  # one row without keys
    good = (F.col("_pz") > 1e-6) & (F.col(depth) > 1e-6) & (F.lit(True) if mask is None else mask)
    z = F.col("_pz") + 1e-6
    at = seen.where(good).select(*keys, *values, (F.col("_px") / z * target.fx + target.cx - 0.5).alias("_u"), (F.col("_py") / z * target.fy + target.cy - 0.5).alias("_v"), F.exp(-50 * log / (F.col("_most") + 1e-7)).alias("_weight"))
    return splat(at, keys, "_u", "_v", width, height, values, weight="_weight")
