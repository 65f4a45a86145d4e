"""Results of a reconstruction as tables: map points by keyframe, poses, intrinsics, and points on rasters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keyframe_points(points: DataFrame, keyframe: int, view: int = -1) -> DataFrame:
    """Points of one keyframe; view -1 is all views."""
    own = points.where(F.col("keyframe") == keyframe)
    return own if view < 0 else own.where(F.col("view") == view)


def full_map(points: DataFrame, scale: float = 1.0) -> DataFrame:
    """All points, with their places multiplied."""
    return points.withColumns({a: F.col(a) * scale for a in "xyz"})


def rescaled(poses: DataFrame, disparities: DataFrame | None, factor: float) -> tuple[DataFrame, DataFrame | None]:
    """Translations multiplied by a factor and disparities divided by it."""
    moved = poses.withColumns({c: F.col(c) * factor for c in ("tx", "ty", "tz")})
    return moved, None if disparities is None else disparities.withColumn("disp", F.col("disp") / factor)


def intrinsics_of(frames: DataFrame, intrinsics: DataFrame) -> DataFrame:
    """Frames with their intrinsics: by frame where the table has frame_idx, else the one row of the view."""
    by = [c for c in ("stream", "view", "frame_idx") if c in intrinsics.columns and c in frames.columns]
    return frames.join(intrinsics, by, "left") if by else frames.join(F.broadcast(intrinsics))  # one row without keys


def refreshed_sensor(pixels: DataFrame, focal: DataFrame) -> DataFrame:
    """Sensor disparities after a change of the focal length: multiplied by the old one over the new one of each frame (frame_idx, focal_before, focal)."""
    both = pixels.join(focal, "frame_idx", "left")
    ratio = F.coalesce(F.col("focal_before") / F.col("focal"), F.lit(1.0))
    return both.withColumn("disp_sensor", F.col("disp_sensor") * ratio).select(*pixels.columns)


def stencil(radius: int, round_: bool = True) -> list[tuple[int, int]]:
    """Offsets (dv, du) of a disc, or of a square."""
    return [(v, u) for v in range(-radius, radius + 1) for u in range(-radius, radius + 1) if not round_ or v * v + u * u <= radius * radius]


def drawn(points: DataFrame, keys: list[str], u: str, v: str, order: Column, values: list[str], width: int, height: int, offsets: list[tuple[int, int]]) -> DataFrame:
    """The pixels that points cover with a stencil, each with the values of the last point in order; pixels outside fall away."""
    at = F.explode(F.array(*[F.struct((F.floor(F.col(v)) + a).alias("v"), (F.floor(F.col(u)) + b).alias("u")) for a, b in offsets]))
    wide = points.select(*keys, at.alias("_at"), F.struct(order.alias("o"), *values).alias("_value"))
    inside = wide.where(F.col("_at.u").between(0, width - 1) & F.col("_at.v").between(0, height - 1))
    top = inside.groupBy(*keys, F.col("_at.v").alias("v"), F.col("_at.u").alias("u")).agg(F.max("_value").alias("_value"))
    return top.select(*keys, "v", "u", *[F.col(f"_value.{c}").alias(c) for c in values])


def boxes_of(detections: DataFrame, logits: str, threshold: float = 0.35) -> DataFrame:
    """Detections whose largest token probability exceeds a threshold, with corners (x0, y0, x1, y1) from centre and size (cx, cy, w, h)."""
    kept = detections.withColumn("score", F.array_max(logits)).where(F.col("score") > threshold)
    return kept.withColumns({"x0": F.col("cx") - F.col("w") / 2, "y0": F.col("cy") - F.col("h") / 2, "x1": F.col("cx") + F.col("w") / 2, "y1": F.col("cy") + F.col("h") / 2})


def window_keyframes(frames: DataFrame, keyframes: DataFrame, stream: str) -> DataFrame:
    """The distinct keyframes (stream, kf) that rows of a window name, without those that are frames of it (stream, frame_idx)."""
    return keyframes.select(stream, "kf").distinct().join(frames.select(stream, F.col("frame_idx").alias("kf")), [stream, "kf"], "left_anti")
