"""Streaming queries over the events table as a bounded stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessella.catalogue import query
from tessella.streaming import folds


def _stream(spark, d):
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)


@query(
    "stream_keyframes",
    """with recursive r as (select user_id, event_id, value, row_number() over (partition by user_id order by event_id) as n from events),
    f as (select user_id, event_id, n, value as base, true as keep from r where n = 1
          union all select r.user_id, r.event_id, r.n, case when abs(r.value - f.base) > 50 then r.value else f.base end, abs(r.value - f.base) > 50 from f join r on r.user_id = f.user_id and r.n = f.n + 1)
    select user_id, event_id from f where keep""",
)
def stream_keyframes(spark, d):
    rows = _stream(spark, d).select("user_id", "event_id", "value")
    return folds.drain(folds.keyframes(rows, "user_id", ["event_id"], "value", 50.0), f"kf_{uuid.uuid4().hex}").select("user_id", "event_id")


@query(
    "stream_object_numbers",
    """with f as (select user_id, event_type, min(event_id) as first_id from events group by 1, 2), n as (select user_id, event_type, row_number() over (partition by user_id order by first_id) as object_id from f)
    select e.user_id, e.event_id, n.object_id from events e join n using (user_id, event_type)""",
)
def stream_object_numbers(spark, d):
    rows = _stream(spark, d).select("user_id", "event_id", "event_type")
    return folds.drain(folds.object_numbers(rows, "user_id", ["event_id"], "event_type"), f"on_{uuid.uuid4().hex}").select("user_id", "event_id", "object_id")


@query("stream_tumbling", "select strftime(date_trunc('day', ts), '%Y-%m-%d') as day, event_type, count(*) as n, round(sum(value), 4) + 0.0 as total from events group by event_type, date_trunc('day', ts)")
def stream_tumbling(spark, d):
    # Times without a zone are read as UTC, in which windows of days begin.
    rows = _stream(spark, d).withColumn("ts", F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone()))
    out = folds.tumbling(rows, "ts", "1 day", ["event_type"], "value")
    return folds.drain(out, f"tw_{uuid.uuid4().hex}", "complete").select(F.date_format(F.to_utc_timestamp("start", F.current_timezone()), "yyyy-MM-dd").alias("day"), "event_type", "n", (F.round("total", 4) + 0.0).alias("total"))


@query(
    "stream_session",
    """with g as (select user_id, ts, case when lag(ts) over (partition by user_id order by ts) is null or ts - lag(ts) over (partition by user_id order by ts) >= interval 6 hour then 1 else 0 end as new_ from events),
    s as (select user_id, sum(new_) over (partition by user_id order by ts) as k from g) select user_id, count(*) as n from s group by user_id, k""",
)
def stream_session(spark, d):
    rows = _stream(spark, d).withColumn("ts", F.col("ts").cast("timestamp")).select("ts", "user_id")
    out = folds.sessions(rows, "ts", "6 hours", ["user_id"])
    return folds.drain(out, f"ss_{uuid.uuid4().hex}", "complete").select("user_id", "n")
