"""Scans of frame folders, video headers and annotation artifacts."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Fixed list of image files that a frame folder may hold.
IMAGE_SUFFIXES = ("png", "jpg", "jpeg", "bmp", "tiff", "webp")


def in_range(frames: DataFrame, number: str, start: int = 0, end: int = -1, step: int = 1) -> DataFrame:
    """start <= number < end (-1: all) at every step-th place from start; reaches a Parquet scan as a filter."""
    out = frames.where(F.col(number) >= start)
    if end >= 0:
        out = out.where(F.col(number) < end)
    return out.where((F.col(number) - start) % step == 0) if step > 1 else out


def frame_folder(spark: SparkSession, path: str, start: int = 0, end: int = -1, step: int = 1, content: bool = False) -> DataFrame:
    """Images of a folder in order of their names: stream_id, frame_idx, path, length (and content)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(path)
    if not content:
        files = files.drop("content")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    images = files.where(F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)).isin(*IMAGE_SUFFIXES))
    stream = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    numbered = images.select(stream.alias("stream_id"), "path", "length", *(["content"] if content else []))
    # File listings are small beside what they list: one row for each frame of one folder.
    ranked = numbered.select("path", (F.row_number().over(Window.partitionBy("stream_id").orderBy("path")) - 1).cast("long").alias("frame_idx"))
    return in_range(numbered.join(ranked, "path"), "frame_idx", start, end, step)


def _boxes(data: bytes, start: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(kind, begin, end) of the boxes of an ISO media file between two places."""
    while start + 8 <= end:
        size, kind = struct.unpack(">I4s", data[start : start + 8])
        head = 8
        if size == 1:
            size, head = struct.unpack(">Q", data[start + 8 : start + 16])[0], 16
        stop = end if size == 0 else start + size
        if stop <= start or stop > end:
            return
        yield kind, start + head, stop
        start = stop


def movie_header(data: bytes) -> dict | None:
    """Width, height, frames and seconds of the first video track of an MP4 file."""

    def find(start: int, end: int, *path: bytes):
        for kind, a, b in _boxes(data, start, end):
            if kind == path[0]:
                if len(path) == 1:
                    yield a, b
                else:
                    yield from find(a, b, *path[1:])

    for a, b in find(0, len(data), b"moov", b"trak"):
        handlers = [data[x + 8 : x + 12] for x, _ in find(a, b, b"mdia", b"hdlr")]
        if b"vide" not in handlers:
            continue
        out = {"width": 0, "height": 0, "n_frames": 0, "seconds": 0.0}
        for x, y in find(a, b, b"tkhd"):
            w, h = struct.unpack(">II", data[y - 8 : y])
            out |= {"width": w >> 16, "height": h >> 16}
        for x, _ in find(a, b, b"mdia", b"mdhd"):
            scale, length = struct.unpack(">II", data[x + 12 : x + 20]) if data[x] == 0 else struct.unpack(">IQ", data[x + 20 : x + 32])
            out["seconds"] = length / scale if scale else 0.0
        for x, _ in find(a, b, b"mdia", b"minf", b"stbl", b"stts"):
            n = struct.unpack(">I", data[x + 4 : x + 8])[0]
            out["n_frames"] = sum(struct.unpack(">I", data[x + 8 + 8 * i : x + 12 + 8 * i])[0] for i in range(n))
        return out
    return None


def movie_list(spark: SparkSession, path: str, start: int = 0, end: int = -1, step: int = 1) -> DataFrame:
    """Headers of the MP4 files of a folder (or one file): stream_id, path, width, height, n_frames, fps of the range that is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.mp4").load(path).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(p, *(h.values() if (h := movie_header(c)) else (None,) * 4)) for p, c in zip(batch.path, batch.content, strict=True)]
            yield pd.DataFrame(rows, columns=["path", "width", "height", "n_frames", "seconds"])

    heads = files.mapInPandas(run, "path string, width int, height int, n_frames long, seconds double")
    last = F.least(F.lit(end), F.col("n_frames")) if end >= 0 else F.col("n_frames")
    taken = F.greatest(F.ceil((last - start) / F.lit(step)), F.lit(0)).cast("long")
    return heads.select(F.regexp_extract("path", r"([^/]+)\.mp4$", 1).alias("stream_id"), "path", "width", "height", taken.alias("n_frames"), (F.col("n_frames") / F.col("seconds") / step).alias("fps"))


def multiview(views: list[DataFrame], number: str = "frame_idx") -> DataFrame:
    """Streams of one rig as one table with view_idx; frames that not all views have fail the length check of the caller."""
    out = None
    for i, v in enumerate(views):
        v = v.withColumn("view_idx", F.lit(i))
        out = v if out is None else out.unionByName(v)
    return out


def unequal_views(frames: DataFrame, stream: str = "stream_id") -> DataFrame:
    """Streams whose views differ in their number of frames."""
    per = frames.groupBy(stream, "view_idx").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(stream).agg(F.min("n").alias("least"), F.max("n").alias("most")).where("least <> most")


def intrinsics(spark: SparkSession, table: str, cameras: str | None) -> DataFrame:
    """inds, data, camera: a Parquet table of parameters joined with ``idx: CAMERA`` lines; without lines all are PINHOLE with 4 parameters."""
    rows = spark.read.parquet(table)
    if cameras is None:
        four = F.when(F.size("data") == 4, F.lit("PINHOLE")).otherwise(F.raise_error(F.lit("parameters without camera names must be 4")))
        return rows.withColumn("camera", four)
    lines = spark.read.text(cameras).where("trim(value) <> ''")
    parts = F.split("value", ":")
    named = lines.select(F.trim(parts[0]).cast("long").alias("inds"), F.trim(parts[1]).alias("camera"))
    return rows.join(named, "inds", "left").withColumn("camera", F.coalesce("camera", F.lit("PINHOLE")))


def phrases(spark: SparkSession, path: str) -> DataFrame:
    """``id: phrase`` lines as instance, phrase; a line with another colon fails."""
    parts = F.split("value", ":")
    lines = spark.read.text(path).where("trim(value) <> ''")
    whole = F.when(F.size(parts) == 2, F.trim(parts[1])).otherwise(F.raise_error(F.concat(F.lit("not one colon: "), F.col("value"))))
    return lines.select(F.trim(parts[0]).cast("int").alias("instance"), whole.alias("phrase"))


def sequences(spark: SparkSession, base: str) -> DataFrame:
    """Names of the sequences of an artifact folder, by their colour videos."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.mp4").load(f"{base}/rgb").select("path")
    return files.select(F.regexp_extract("path", r"([^/]+)\.mp4$", 1).alias("name"))


def dataset_catalogue(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """Clips of each video link among the archives whose name has a prefix."""
    meta = spark.read.parquet(path).where(F.col("tar_name").startswith(prefix))
    return meta.groupBy("youtube_link").agg(F.array_sort(F.collect_list(F.struct("start", "end", "tar_name"))).alias("clips"))


REGISTRY = {"frame_folder": frame_folder, "movie_list": movie_list}


def make(kind: str, spark: SparkSession, **options) -> DataFrame:
    """A source by name; unknown names are refused."""
    if kind not in REGISTRY:
        raise ValueError(f"no source {kind!r}; one of {', '.join(sorted(REGISTRY))}")
    return REGISTRY[kind](spark, **options)


def pose_arrays(spark: SparkSession, path: str, benchmark: bool = False) -> DataFrame:
    """Poses of ``.npz`` files (inds, 4x4 data, camera to world): stream_id, inds, tx .. qw.

    With benchmark also runtime, keyframe_ids and frame_num of the file, null where it has none.
    """
    import io

    import numpy as np

    from tessella.functions.lie import SE3

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(path).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for p, c in zip(batch.path, batch.content, strict=True):
                with np.load(io.BytesIO(c), allow_pickle=False) as z:
                    inds, data = z["inds"].astype(np.int64), z["data"].astype(float).reshape(len(z["inds"]), 16)
                    one = lambda n, kind: kind(z[n]) if n in z else None  # noqa: E731, B023
                    more = one("runtime", float), one("keyframe_ids", lambda x: np.atleast_1d(x).astype(np.int64).tolist()), one("frame_num", int)
                yield pd.DataFrame({"path": p, "inds": inds, "m": list(data), "runtime": more[0], "keyframe_ids": [more[1]] * len(inds), "frame_num": pd.array([more[2]] * len(inds), "Int64")})

    rows = files.mapInPandas(run, "path string, inds long, m array<double>, runtime double, keyframe_ids array<long>, frame_num long")
    m = [[F.col("m")[4 * r + c] for c in range(4)] for r in range(4)]
    return rows.select(F.regexp_extract("path", r"([^/]+)\.npz$", 1).alias("stream_id"), "inds", *SE3.of_matrix(m).columns(), *(["runtime", "keyframe_ids", "frame_num"] if benchmark else []))
