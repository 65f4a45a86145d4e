"""Ordered analytics, limits, set operations and text on the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessella.catalogue import query
from tessella.functions import text
from tessella.operators import blocks, windows
from tessella.plans.tables import near, table


def _events(spark, d):
    return table(spark, d, "events").select("user_id", "event_id", "event_type", "value")


@query(
    "ema_scale",
    """with recursive r as (select user_id, event_id, value, row_number() over (partition by user_id order by event_id) as n from events),
    f as (select user_id, event_id, n, value as ema from r where n = 1 union all select r.user_id, r.event_id, r.n, 0.9 * f.ema + 0.1 * r.value from f join r on r.user_id = f.user_id and r.n = f.n + 1)
    select user_id, event_id, round(ema + 1e-8, 5) + 0.0 as ema from f""",
)
def ema_scale(spark, d):
    return windows.ema(_events(spark, d), "user_id", ["event_id"], "value", 0.9).select("user_id", "event_id", near(F.col("ema") + 1e-8, 5).alias("ema"))


@query(
    "carry_forward",
    """select user_id, event_id, coalesce(last_value(case when event_type = 'purchase' then value end ignore nulls) over (partition by user_id order by event_id), 1.0) as scale from events""",
)
def carry_forward(spark, d):
    v = F.when(F.col("event_type") == "purchase", F.col("value"))
    return _events(spark, d).select("user_id", "event_id", windows.carried(v, "user_id", ["event_id"], 1.0).alias("scale"))


@query(
    "traj_length",
    """with s as (select user_id, event_id, sqrt(coalesce(pow(value - lag(value) over w, 2) + pow(event_id - lag(event_id) over w, 2), 0)) as step from events window w as (partition by user_id order by event_id))
    select user_id, event_id, round(sum(step) over (partition by user_id order by event_id rows unbounded preceding), 4) + 0.0 as length from s""",
)
def traj_length(spark, d):
    e = _events(spark, d)
    w = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = e.withColumn("step", windows.path_length([F.col("value"), F.col("event_id").cast("double")], "user_id", ["event_id"]))
    return s.select("user_id", "event_id", near(F.sum("step").over(w), 4).alias("length"))


_NUMBERED = "select user_id, event_id, value, row_number() over (partition by user_id order by event_id) - 1 as n, count(*) over (partition by user_id) as len from events"
_WINDOWED = f"""select r.*, w as window_no, n - w * 7 as place,
    case when w > 0 and n - w * 7 < 3 then (n - w * 7 + 1) / 4.0 when w < last_w and n - w * 7 >= 7 then 1 - (n - w * 7 - 7 + 1) / 4.0 else 1.0 end as weight
    from (select *, cast(greatest(ceil((len - 10) / 7), 0) as bigint) as last_w from ({_NUMBERED})) r, range(5000) t(w)
    where w <= last_w and w * 7 <= n and n < w * 7 + 10"""


def _numbered(spark, d):
    w = Window.partitionBy("user_id")
    return _events(spark, d).withColumns({"n": F.row_number().over(w.orderBy("event_id")) - 1, "len": F.count(F.lit(1)).over(w)})


@query("overlap_windows", f"select user_id, event_id, window_no, cast(place as bigint) as place, round(weight, 6) + 0.0 as weight from ({_WINDOWED})")
def overlap_windows(spark, d):
    out = windows.overlapping(_numbered(spark, d), "n", F.col("len"), 10, 3)
    return out.select("user_id", "event_id", "window_no", F.col("place").cast("long").alias("place"), near(F.col("weight")).alias("weight"))


@query("cross_fade", f"select user_id, event_id, round(sum((value + window_no * 0.5) * weight) / sum(weight), 5) + 0.0 as value from ({_WINDOWED}) group by 1, 2")
def cross_fade(spark, d):
    out = windows.overlapping(_numbered(spark, d), "n", F.col("len"), 10, 3).withColumn("value", F.col("value") + F.col("window_no") * 0.5)
    return windows.cross_faded(out, ["user_id", "event_id"], "value").select("user_id", "event_id", near(F.col("value"), 5).alias("value"))


@query(
    "velocity_interpolate",
    """with k as (select user_id, event_id, value, lead(value) over w as v1, lead(event_id) over w as t1 from events window w as (partition by user_id order by event_id))
    select user_id, event_id, round((v1 - value) / (t1 - event_id + 1e-3), 6) + 0.0 as velocity from k where t1 is not null""",
)
def velocity_interpolate(spark, d):
    w = Window.partitionBy("user_id").orderBy("event_id")
    k = _events(spark, d).select("user_id", "event_id", "value", F.lead("value").over(w).alias("v1"), F.lead("event_id").over(w).alias("t1"))
    return k.where("t1 is not null").select("user_id", "event_id", near((F.col("v1") - F.col("value")) / (F.col("t1") - F.col("event_id") + 1e-3)).alias("velocity"))


@query(
    "velocity_extrapolate",
    """select user_id, event_id, round(value + 0.5 * (value - lag(value) over (partition by user_id order by event_id)), 6) + 0.0 as next_value from events qualify next_value is not null""",
)
def velocity_extrapolate(spark, d):
    w = Window.partitionBy("user_id").orderBy("event_id")
    return _events(spark, d).select("user_id", "event_id", near(F.col("value") + 0.5 * (F.col("value") - F.lag("value").over(w))).alias("next_value")).where("next_value is not null")


@query("periodic_sample", "select user_id, event_id from events where event_id % 10 = 0")
def periodic_sample(spark, d):
    return _events(spark, d).where(windows.sampled(F.col("event_id"), 10)).select("user_id", "event_id")


@query("age_retire", "select o_orderkey, cast((select max(o_orderkey) from orders) - o_orderkey as bigint) as age from orders where (select max(o_orderkey) from orders) - o_orderkey <= 250")
def age_retire(spark, d):
    o = table(spark, d, "orders").select("o_orderkey")
    now = o.agg(F.max("o_orderkey").alias("now"))  # one row
    return o.join(F.broadcast(now)).select("o_orderkey", windows.age(F.col("now"), F.col("o_orderkey")).alias("age")).where("age <= 250")


@query("age_evict", "select o_custkey, o_orderkey from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) <= 3")
def age_evict(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.expr("datediff(date'2100-01-01', o_orderdate)").alias("days"), "o_orderdate")
    w = Window.partitionBy("o_custkey").orderBy(F.col("o_orderdate").desc(), "o_orderkey")
    numbered = o.withColumn("age", F.row_number().over(w))
    return windows.oldest_out(numbered, "o_custkey", "age", ["o_orderkey"], 3).select("o_custkey", "o_orderkey")


@query("topk_per_group", "select o_custkey, o_orderkey, o_totalprice, rank from (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rank from orders) where rank <= 2")
def topk_per_group(spark, d):
    return windows.top_k(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], "o_totalprice", ["o_orderkey"], 2).withColumn("rank", F.col("rank").cast("long"))


@query("memory_bank", "select user_id, event_id, rank from (select *, row_number() over (partition by user_id order by event_id desc) as rank from events) where rank <= 5")
def memory_bank(spark, d):
    return windows.top_k(_events(spark, d), ["user_id"], "event_id", [], 5).select("user_id", "event_id", F.col("rank").cast("long").alias("rank"))


@query(
    "edge_list_sorted",
    "select l_suppkey as i, l_partkey as j, round(avg(l_tax), 6) + 0.0 as weight from lineitem group by 1, 2 order by i, j",
)
def edge_list_sorted(spark, d):
    e = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("i"), F.col("l_partkey").alias("j")).agg(near(F.avg("l_tax")).alias("weight"))
    return e.orderBy("i", "j")


@query(
    "keypoint_nms",
    """with g as (select v, u, sin(v * 1.3) * cos(u * 1.7) + 0.001 * u + 0.0013 * v as s from (select unnest(range(20)) as v), (select unnest(range(28)) as u)),
    m as (select a.v, a.u, any_value(a.s) as s, max(b.s) as m from g a join g b on b.v between a.v - 2 and a.v + 2 and b.u between a.u - 2 and a.u + 2 group by 1, 2),
    p0 as (select v, u, s, s = m as p from m),
    n1 as (select a.v, a.u, any_value(a.s) as s, bool_or(a.p) as p, max(b.p::int) as near_ from p0 a join p0 b on b.v between a.v - 2 and a.v + 2 and b.u between a.u - 2 and a.u + 2 group by 1, 2),
    r1 as (select *, case when near_ > 0 then 0 else s end as rest from n1),
    p1 as (select a.v, a.u, any_value(a.s) as s, any_value(a.p) or (any_value(a.rest) = max(b.rest) and any_value(a.near_) = 0) as p from r1 a join r1 b on b.v between a.v - 2 and a.v + 2 and b.u between a.u - 2 and a.u + 2 group by 1, 2),
    n2 as (select a.v, a.u, any_value(a.s) as s, bool_or(a.p) as p, max(b.p::int) as near_ from p1 a join p1 b on b.v between a.v - 2 and a.v + 2 and b.u between a.u - 2 and a.u + 2 group by 1, 2),
    r2 as (select *, case when near_ > 0 then 0 else s end as rest from n2),
    p2 as (select a.v, a.u, any_value(a.s) as s, any_value(a.p) or (any_value(a.rest) = max(b.rest) and any_value(a.near_) = 0) as p from r2 a join r2 b on b.v between a.v - 2 and a.v + 2 and b.u between a.u - 2 and a.u + 2 group by 1, 2)
    select cast(v as integer) as v, cast(u as integer) as u, round(s, 6) + 0.0 as score from p2 where p""",
)
def keypoint_nms(spark, d):
    from tessella.functions.camera import pixel_grid

    g = pixel_grid(spark, 28, 20).select("v", "u", (F.sin(F.col("v") * 1.3) * F.cos(F.col("u") * 1.7) + 0.001 * F.col("u") + 0.0013 * F.col("v")).alias("score"))
    return windows.peaks(g, [], 2).select("v", "u", near(F.col("score")).alias("score"))


_AB = "select l_suppkey as i, l_partkey % 30 as j, cast(l_quantity as bigint) as val from lineitem where l_returnflag = '{}'"


def _ab(spark, d, flag):
    return table(spark, d, "lineitem").where(F.col("l_returnflag") == flag).select(F.col("l_suppkey").alias("i"), (F.col("l_partkey") % 30).alias("j"), F.col("l_quantity").cast("long").alias("val"))


@query("union_coalesce", f"select i, j, cast(sum(val) as bigint) as val from (select * from ({_AB.format('R')}) union all select i, j, -val from ({_AB.format('A')})) group by 1, 2")
def union_coalesce(spark, d):
    a, b = _ab(spark, d, "R"), _ab(spark, d, "A")
    return blocks.plus(a, b, -1).withColumn("val", F.col("val").cast("long"))


@query("edge_except", f"select i, j from ({_AB.format('R')}) except select i, j from ({_AB.format('A')})")
def edge_except(spark, d):
    return _ab(spark, d, "R").select("i", "j").distinct().join(_ab(spark, d, "A").select("i", "j"), ["i", "j"], "left_anti")


@query("edge_intersect", f"select i, j from ({_AB.format('R')}) intersect select i, j from ({_AB.format('A')})")
def edge_intersect(spark, d):
    return _ab(spark, d, "R").select("i", "j").distinct().join(_ab(spark, d, "A").select("i", "j"), ["i", "j"], "left_semi")


@query("distinct_ids", "select distinct l_suppkey as i from lineitem")
def distinct_ids(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_suppkey").alias("i")).distinct()


@query("schema_union", "select event_id as id, value, null::varchar as name from events union all by name select c_custkey as id, c_name as name from customer")
def schema_union(spark, d):
    a = table(spark, d, "events").select(F.col("event_id").alias("id"), "value")
    b = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return a.unionByName(b, allowMissingColumns=True)


@query("string_kv_parse", "select event_id, trim(split_part(replace(replace(props, '{', ''), '}', ''), ':', 1)) as key, trim(split_part(replace(replace(props, '{', ''), '}', ''), ':', 2)) as val from events")
def string_kv_parse(spark, d):
    k, v = text.key_value(F.regexp_replace("props", "[{}]", ""))
    return table(spark, d, "events").select("event_id", k.alias("key"), v.alias("val"))


@query("phrase_caption", "select p_brand, string_agg(distinct p_type, '. ' order by p_type) || '.' as caption from part group by 1")
def phrase_caption(spark, d):
    return table(spark, d, "part").groupBy("p_brand").agg(text.caption(F.array_sort(F.collect_set("p_type"))).alias("caption"))


@query("phrase_merge", "select l_suppkey as id, last(l_shipdate::date::varchar order by l_orderkey * 10 + l_linenumber, l_partkey) as phrase from lineitem group by 1")
def phrase_merge(spark, d):
    at = F.struct((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("a"), F.col("l_partkey").alias("b"))
    return table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("id")).agg(F.max_by(F.col("l_shipdate").cast("date").cast("string"), at).alias("phrase"))


@query("clock_seconds", "select event_id, hour(ts) * 3600.0::double + minute(ts) * 60 + second(ts) as seconds from events")
def clock_seconds(spark, d):
    return table(spark, d, "events").select("event_id", text.clock_seconds(F.date_format("ts", "HH:mm:ss")).alias("seconds"))


@query(
    "clip_catalogue",
    """select o_orderpriority as link, o_custkey as tar, count(*) as clips, min(o_orderkey) as first_clip from orders where o_orderpriority like '1%' or o_orderpriority like '2%' group by 1, 2""",
)
def clip_catalogue(spark, d):
    o = table(spark, d, "orders").where(F.col("o_orderpriority").startswith("1") | F.col("o_orderpriority").startswith("2"))
    return o.groupBy(F.col("o_orderpriority").alias("link"), F.col("o_custkey").alias("tar")).agg(F.count(F.lit(1)).alias("clips"), F.min("o_orderkey").alias("first_clip"))


@query(
    "blend_weights",
    "select n_nationkey as n, round(list_sum(list_transform(range(1, n_nationkey + 1), lambda i: i / (n_nationkey + 1))), 6) + 0.0 as inner_sum from nation where n_nationkey > 0",
)
def blend_weights(spark, d):
    total = F.aggregate(text.cross_fade_weights(F.col("n_nationkey")), F.lit(0.0), lambda a, x: a + x)
    return table(spark, d, "nation").where("n_nationkey > 0").select(F.col("n_nationkey").alias("n"), near(total).alias("inner_sum"))


_STITCH = """select s_suppkey as stream, w as window_no, p as place, x as pixel, (4 + sin((w * 22 + p) * 0.11 + s_suppkey) + 0.3 * x + 0.01 * x * sin(w * 22 + p)) * (1 + 0.1 * w + 0.01 * (s_suppkey % 5)) + 0.05 * w as value
    from supplier, (select unnest(range(4)) as w), (select unnest(range(32)) as p), (select unnest(range(6)) as x)"""


@query(
    "window_stitch",
    f"""with recursive d as ({_STITCH}), m as (select c.stream, c.window_no, count(*) as n, sum(c.value) as x, sum(c.value * c.value) as xx,
        sum(case when c.place = 0 then f.value else 0 end) as y, sum(case when c.place = 0 then c.value * f.value else 0 end) as xy, sum(c.place) as m, sum(c.place * c.value) as bx, sum(c.place * l.value) as r, sum(c.place * c.value * l.value) as xr
        from d c join d f on f.stream = c.stream and f.pixel = c.pixel and f.window_no = 0 and f.place = 0 join d l on l.stream = c.stream and l.pixel = c.pixel and l.window_no = c.window_no - 1 and l.place = 12
        where c.window_no > 0 and c.place < 2 group by 1, 2),
    t as (select distinct stream, 0::bigint as window_no, 1.0::double as a, 0.0::double as b from d
          union all select stream, window_no, (n * xy2 - x * y2) / (n * xx - x * x), (xx * y2 - x * xy2) / (n * xx - x * x) from (select m.*, m.y + t.a * m.r + t.b * m.m as y2, m.xy + t.a * m.xr + t.b * m.bx as xy2 from t join m on m.stream = t.stream and m.window_no = t.window_no + 1)),
    v as (select d.stream, d.window_no * 22 + d.place as frame_idx, d.pixel, case when d.window_no = 0 then d.value else greatest(d.value * a + b, 0) end as z,
        case when d.window_no > 0 and d.place < 2 then 0 when d.window_no > 0 and d.place < 10 then (d.place - 2) / 7.0::double when d.window_no < 3 and d.place >= 24 then 1 - (d.place - 24) / 7.0::double else 1 end as w from d join t on t.stream = d.stream and t.window_no = d.window_no)
    select stream, frame_idx, pixel, round(sum(z * w), 5) + 0.0 as value from v group by 1, 2, 3""",
)
def window_stitch(spark, d):
    """Windows of 32 predictions with 10 in common, each in a scale of its own, chained to one series."""
    rows = table(spark, d, "supplier").select(F.col("s_suppkey").alias("stream"))
    for name, n in (("window_no", 4), ("place", 32), ("pixel", 6)):
        rows = rows.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    t = F.col("window_no") * 22 + F.col("place")
    value = (4 + F.sin(t * 0.11 + F.col("stream")) + 0.3 * F.col("pixel") + 0.01 * F.col("pixel") * F.sin(t)) * (1 + 0.1 * F.col("window_no") + 0.01 * (F.col("stream") % 5)) + 0.05 * F.col("window_no")
    out = windows.stitched(rows.withColumn("value", value), "stream", ["pixel"], "value")
    return out.select("stream", "frame_idx", "pixel", near(F.col("value"), 5).alias("value"))


@query(
    "shared_scale",
    """with recursive e as (select user_id, value, event_id, row_number() over (partition by user_id order by event_id) - 1 as n, count(*) over (partition by user_id) as len from events),
    w as (select user_id, unnest(range(cast(greatest(ceil((n - 63) / 48.0), 0) as bigint), cast(least(n // 48, greatest(ceil((len - 64) / 48.0), 0)) as bigint) + 1)) as window_no, value, event_id from e),
    s as (select user_id, window_no, case when avg((value > 20)::int) >= 0.05 then quantile_disc(case when value > 20 then (event_id % 100 + 50) / value end, 0.5) end as own from w group by 1, 2),
    f as (select user_id, window_no, own as s from s where window_no = 0 union all select s.user_id, s.window_no, case when s.own is null then f.s when f.s is null then s.own else 0.9 * f.s + 0.1 * s.own end from f join s on s.user_id = f.user_id and s.window_no = f.window_no + 1)
    select user_id, window_no, round(coalesce(s, 1), 6) + 0.0 as scale from f""",
)
def shared_scale(spark, d):
    e = _events(spark, d)
    rows = e.select("user_id", (F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1).cast("long").alias("n"), "value", (F.col("event_id") % 100 + 50).cast("double").alias("t"))
    return windows.shared_scale(rows, "user_id", "n", "value", "t", F.col("value") > 20).select("user_id", "window_no", near(F.col("scale")).alias("scale"))
