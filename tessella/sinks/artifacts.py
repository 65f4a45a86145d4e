"""Artifacts as Parquet tables and as text for structure-from-motion tools."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.functions.lie import SE3

POSE = ("tx", "ty", "tz", "qx", "qy", "qz", "qw")


def save_attribute(frames: DataFrame, path: str, columns: list[str], number: str = "frame_idx", stream: str = "stream_id") -> None:
    """One attribute of all frames that have it, keyed by place in the stream; a folder for each stream."""
    some = F.lit(True)
    for c in columns:
        some = some & F.col(c).isNotNull()
    frames.where(some).select(stream, F.col(number).alias("inds"), *columns).write.mode("overwrite").partitionBy(stream).parquet(path)


def save_all(frames: DataFrame, base: str, attributes: dict[str, list[str]]) -> None:
    """Every attribute in a folder of its own; the frames are read once."""
    kept = frames.persist()
    try:
        for name, columns in attributes.items():
            save_attribute(kept, f"{base}/{name}", columns)
    finally:
        kept.unpersist()


def merged_phrases(phrases: DataFrame, number: str = "frame_idx", stream: str = "stream_id") -> DataFrame:
    """Phrases of a stream's instances; later frames win."""
    return phrases.groupBy(stream, "instance").agg(F.max_by("phrase", number).alias("phrase"))


def save_map(points: DataFrame, path: str) -> None:
    """Map points with their edges beside them, so that neighbours are still known after reading."""
    points.write.mode("overwrite").partitionBy("stream_id").parquet(path)


def load_map(spark: SparkSession, path: str, edges: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Map points as ``save_map`` wrote them, and the edges where they were written too."""
    return spark.read.parquet(path), None if edges is None else spark.read.parquet(edges)


def save_intermediate(poses: DataFrame, intrinsics: DataFrame, rig: DataFrame, trajectory: DataFrame, base: str, view: int, flags: dict[str, str] | None = None) -> None:
    """The tables of one view's reconstruction (poses, intrinsics, the rig's transform, the base trajectory) and its flags, a folder each."""
    spark = poses.sparkSession
    for name, rows in (("pose", poses), ("intrinsics", intrinsics), ("rig", rig)):
        (rows.where(F.col("view") == view) if "view" in rows.columns else rows).write.mode("overwrite").parquet(f"{base}/{name}")
    trajectory.write.mode("overwrite").parquet(f"{base}/trajectory")
    named = [(k, str(v)) for k, v in sorted({"view": str(view), **(flags or {})}.items())]
    spark.createDataFrame(named, "name string, value string").write.mode("overwrite").parquet(f"{base}/flags")


def save_depth(frames: DataFrame, path: str, depth: str = "depth") -> None:
    """Depths at half precision, pixel by pixel; frames and pixels without one are left out."""
    rows = frames.where(F.col(depth).isNotNull()).withColumn(depth, half(F.col(depth)).cast("float"))
    rows.write.mode("overwrite").partitionBy(*[c for c in ("stream_id",) if c in frames.columns]).parquet(path)


def half(value: Column) -> Column:
    """A value as half precision would keep it: 11 significant bits, the step of small ones fixed, large ones infinite."""
    size = F.abs(value)
    power = F.greatest(F.floor(F.log2(F.when(size > 0, size).otherwise(1.0))), F.lit(-14))
    step = F.pow(F.lit(2.0), power - 10)
    kept = F.bround(value / step) * step
    return F.when(F.abs(kept) >= 65520, F.signum(value) * float("inf")).otherwise(kept)


def camera_lines(intrinsics: DataFrame, width: int, height: int) -> DataFrame:
    """A single camera, of the first frame."""
    first = intrinsics.orderBy("inds").limit(1)
    return first.select(F.format_string(f"1 PINHOLE {width} {height} %.9f %.9f %.9f %.9f", *[F.col("data")[i] for i in range(4)]).alias("value"))


def image_lines(poses: DataFrame, name: str = "%06d.jpg") -> DataFrame:
    """World to camera, quaternion with w first, ids from 1, and an empty line of points after each."""
    g = SE3.of().inv()
    rows = poses.select("inds", *g.columns("i_"))
    parts = [F.col(f"i_{c}") for c in ("qw", "qx", "qy", "qz", "tx", "ty", "tz")]
    return rows.select("inds", F.format_string(f"%d %.9f %.9f %.9f %.9f %.9f %.9f %.9f 1 {name}\n", (F.col("inds") + 1).cast("long"), *parts, F.col("inds").cast("long")).alias("value"))


def numbered(rows: DataFrame, order: list[str], start: int = 1) -> DataFrame:
    """Rows numbered over their whole order without one task for all: ranges are sorted apart and their counts added."""
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_k", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33))
    counts = spread.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_b"))  # as many rows as partitions
    return spread.join(F.broadcast(before), "_p").withColumn("id", F.col("_b") + F.col("_k") + start).drop("_p", "_k", "_b")


def point_lines(points: DataFrame, order: list[str]) -> DataFrame:
    """Map points with ids over all keyframes, colours as whole numbers, no track."""
    colour = lambda c: F.least(F.greatest(F.floor(F.col(c) * 255), F.lit(0)), F.lit(255)).cast("int")
    return numbered(points, order).select("id", F.format_string("%d %.6f %.6f %.6f %d %d %d 0", "id", "x", "y", "z", colour("r"), colour("g"), colour("b")).alias("value"))


def depth_points(depth: DataFrame, poses: DataFrame, k: tuple[float, float, float, float], depth_step: int, pixel_step: int = 4) -> DataFrame:
    """World points of every depth_step-th frame and every pixel_step-th pixel that is reliable; poses are camera to world."""
    from tessella.functions.camera import Pinhole

    cam = Pinhole(*[F.lit(float(x)) for x in k])
    some = depth.where((F.col("frame_idx") % depth_step == 0) & (F.col("u") % pixel_step == 0) & (F.col("v") % pixel_step == 0) & F.col("reliable"))
    ray = cam.unproject(F.col("u").cast("double"), F.col("v").cast("double"))
    at = some.join(poses.withColumnRenamed("inds", "frame_idx"), "frame_idx")
    p = SE3.of().act(tuple(c * F.col("depth") for c in ray))
    return at.select("frame_idx", "v", "u", *[c.alias(n) for c, n in zip(p, "xyz", strict=True)])


def write_lines(lines: DataFrame, path: str) -> None:
    lines.select("value").write.mode("overwrite").text(path)
