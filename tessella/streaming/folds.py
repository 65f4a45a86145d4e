"""Structured Streaming forms: keyframe folds, object numbers, sessions, change feeds, ordered checks.

Every stateful operator has a batch twin that gives the same rows on the same
data; rows of a stream must arrive in order, or within one trigger, where they
are sorted (limit a trigger at the source, by files or by rows). Keyframes keep
one number for a stream, object numbers the names that it has numbered. With a
time to live a stream's state goes when it has been silent for so long; that is
for streams that run on, a bounded run would wait for it without an end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.lineage import folder


def _expired(state, ttl: str | None, frames: Iterator[pd.DataFrame]) -> pd.DataFrame | None:
    """The rows of a trigger; None, with the state removed, where a silent stream has timed out."""
    if state.hasTimedOut:
        state.remove()
        return None
    if ttl:
        state.setTimeoutDuration(int(pd.Timedelta(ttl).total_seconds() * 1000))
    return pd.concat(list(frames))


def keyframes(rows: DataFrame, stream: str, order: list[str], value: str, threshold: float, ttl: str | None = None) -> DataFrame:
    """Rows whose value lies more than a threshold from their stream's last keyframe; the first is one."""
    names = rows.columns

    def run(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        if (frame := _expired(state, ttl, frames)) is None:
            return
        frame = frame.sort_values(order)
        keep = []
        for x in frame[value].tolist():
            hit = last is None or abs(x - last) > threshold
            keep.append(hit)
            last = x if hit else last
        if last is not None:
            state.update((float(last),))
        yield frame[keep][names]

    return rows.groupBy(stream).applyInPandasWithState(run, rows.schema, "last double", "append", "ProcessingTimeTimeout" if ttl else "NoTimeout")


def object_numbers(rows: DataFrame, stream: str, order: list[str], name: str, ttl: str | None = None) -> DataFrame:
    """Each new name of a stream gets the next number from 1; the state is the numbers given so far."""

    def run(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        known = dict(zip(state.get[0], range(1, len(state.get[0]) + 1), strict=True)) if state.exists else {}
        if (frame := _expired(state, ttl, frames)) is None:
            return
        frame = frame.sort_values(order)
        frame["object_id"] = [known.setdefault(x, len(known) + 1) for x in frame[name].tolist()]
        state.update((list(known),))
        yield frame

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", object_id long"
    return rows.groupBy(stream).applyInPandasWithState(run, out, "names array<string>", "append", "ProcessingTimeTimeout" if ttl else "NoTimeout")


def event_time(rows: DataFrame, time: str, late: str) -> DataFrame:
    """A watermark on a time column; columns without a zone are read as UTC first."""
    kind = dict(rows.dtypes)[time]
    if kind == "timestamp_ntz":
        rows = rows.withColumn(time, F.from_utc_timestamp(F.col(time).cast("timestamp"), F.current_timezone()))
    return rows.withWatermark(time, late)


def tumbling(rows: DataFrame, time: str, width: str, keys: list[str], value: str) -> DataFrame:
    out = rows.groupBy(F.window(time, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("w.start").alias("start"), *keys, "n", "total")


def sessions(rows: DataFrame, time: str, gap: str, keys: list[str]) -> DataFrame:
    out = rows.groupBy(F.session_window(time, gap).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")


def changed_rows(rows: DataFrame, write: Callable[[DataFrame, int], None]):
    """A writer that hands each trigger's rows on: only changed keyframes are emitted again."""
    return rows.writeStream.foreachBatch(write)


def checked_length(rows: DataFrame, expected: int) -> DataFrame:
    """The rows, unless their number is not the expected one: then reading fails."""
    n = rows.agg(F.count(F.lit(1)).alias("_n"))  # one row
    ok = F.when(F.col("_n") == expected, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit(f"expected {expected} rows, found "), F.col("_n").cast("string"))).cast("boolean"))
    return rows.join(F.broadcast(n)).where(ok).drop("_n")


def drain(query_df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """All rows of a bounded stream, by one run over what is there, as a Parquet table in the checkpoint folder.

    Appended rows are written once each by the file sink; a complete result replaces the one before.
    """
    spark = query_df.sparkSession
    path = f"{folder(spark)}/stream-{name}"
    out = query_df.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/state").trigger(availableNow=True)
    if mode == "append":
        q = out.format("parquet").option("path", f"{path}/rows").start()
    else:
        q = out.foreachBatch(lambda rows, _: rows.write.mode("overwrite").parquet(f"{path}/rows")).start()
    try:
        q.awaitTermination()
    finally:
        q.stop()
    return spark.read.schema(query_df.schema).parquet(f"{path}/rows")
