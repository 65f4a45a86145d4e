"""Frame attributes as optional columns of a stream's table (stream, frame_idx, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The columns that a frame may have beside its keys.
ATTRIBUTES = ("rgb", "pose", "intrinsics", "camera_type", "metric_depth", "instance", "instance_phrases", "mask", "sky_mask")


def _known(name: str) -> str:
    if name not in ATTRIBUTES:
        raise ValueError(f"no attribute {name!r}; one of {', '.join(ATTRIBUTES)}")
    return name


def attributes(frames: DataFrame) -> Column:
    """The names of a frame's attributes that are not null, in order."""
    own = [F.when(F.col(a).isNotNull(), F.lit(a)) for a in ATTRIBUTES if a in frames.columns]
    return F.array_compact(F.array(*own)) if own else F.array().cast("array<string>")


def get(frames: DataFrame, name: str) -> Column:
    """An attribute, null where the stream has none; unknown names are refused."""
    return F.col(_known(name)) if name in frames.columns else F.lit(None)


def with_attribute(frames: DataFrame, name: str, value: Column) -> DataFrame:
    return frames.withColumn(_known(name), value)


def stream_attribute(frames: DataFrame, name: str, keys: tuple[str, ...] = ("stream", "frame_idx")) -> DataFrame:
    """One attribute of all frames: a scan of that column alone."""
    return frames.select(*[k for k in keys if k in frames.columns], get(frames, name).alias(name))


def assigned(frames: DataFrame, values: DataFrame, keys: tuple[str, ...] = ("stream", "frame_idx")) -> DataFrame:
    """Frames with the attributes of another table of the same frames, which replace their own; frames without a row there get nulls."""
    by = [k for k in keys if k in frames.columns and k in values.columns]
    new = [_known(c) for c in values.columns if c not in by]
    return frames.drop(*new).join(values.dropDuplicates(by), by, "left")
