"""Joins on the driver's tables: users are streams, events frames, purchases keyframes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessella.catalogue import query
from tessella.functions import camera
from tessella.operators import joins
from tessella.plans.tables import near, table

_KEYFRAMES = "select user_id, event_id, value, row_number() over (partition by user_id order by event_id) - 1 as kf from events where event_type = 'purchase'"


def keyframes(spark, d):
    rows = table(spark, d, "events").where("event_type = 'purchase'").select("user_id", "event_id", "value")
    return rows.withColumn("kf", (F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1).cast("long"))


@query(
    "asof_interpolate",
    f"""with k as (select *, lead(event_id) over w as t1, lead(value) over w as v1 from ({_KEYFRAMES}) window w as (partition by user_id order by event_id))
    select e.event_id, e.user_id, k.event_id as kf0_time, coalesce(k.t1, k.event_id) as kf1_time,
           round(k.value + (coalesce(k.v1, k.value) - k.value) * ((e.event_id - k.event_id) / (coalesce(k.t1, k.event_id) - k.event_id + 1e-3)), 6) + 0.0 as value
    from events e asof join k on e.user_id = k.user_id and e.event_id >= k.event_id""",
)
def asof_interpolate(spark, d):
    frames = table(spark, d, "events").select("event_id", "user_id")
    keys = table(spark, d, "events").where("event_type = 'purchase'").select("user_id", "event_id", F.col("value").alias("v"))
    j = joins.bracketing_keyframes(frames.withColumn("tie", F.lit(0)), keys.withColumn("tie", F.lit(0)), "user_id", "event_id", "tie", ["v"]).where("kf0_time is not null")
    w = (F.col("event_id") - F.col("kf0_time")) / (F.col("kf1_time") - F.col("kf0_time") + 1e-3)
    return j.select("event_id", "user_id", "kf0_time", "kf1_time", near(F.col("kf0_v") + (F.col("kf1_v") - F.col("kf0_v")) * w).alias("value"))


@query(
    "asof_sliced",
    f"""with k as (select *, lead(event_id) over (partition by user_id order by event_id) as t1 from ({_KEYFRAMES}))
    select e.event_id, e.user_id, k.event_id as kf0_time, case when k.event_id is null then null else coalesce(k.t1, k.event_id) end as kf1_time
    from events e asof left join k on e.user_id = k.user_id and e.event_id >= k.event_id""",
)
def asof_sliced(spark, d):
    """The bracketing join with streams cut into slices, as a hot stream needs it."""
    frames = table(spark, d, "events").select("event_id", "user_id").withColumn("tie", F.lit(0))
    keys = table(spark, d, "events").where("event_type = 'purchase'").select("user_id", "event_id").withColumn("tie", F.lit(0))
    j = joins.bracketing_keyframes(frames, keys, "user_id", "event_id", "tie", [], slice_of=F.floor(F.col("_t") / 256))
    return j.select("event_id", "user_id", "kf0_time", "kf1_time")


@query(
    "asof_band_keyframes",
    f"""with k as ({_KEYFRAMES}), n as (select user_id, count(*) as n from k group by user_id),
    b as (select e.event_id, e.user_id, n.n, count(k.kf) as lower from events e join n using (user_id) left join k on k.user_id = e.user_id and k.event_id < e.event_id group by all),
    r as (select *, least(lower + 3, n - 1) as r from b)
    select r.event_id, r.user_id, k.kf, k.event_id as kf_time from r join k on k.user_id = r.user_id and k.kf between greatest(r.r - 6, 0) and r.r""",
)
def asof_band_keyframes(spark, d):
    frames = table(spark, d, "events").select("event_id", "user_id")
    return joins.keyframe_band(frames, keyframes(spark, d), "user_id", "event_id", "kf").select("event_id", "user_id", "kf", "kf_time")


@query("neighbour_edges", f"with k as ({_KEYFRAMES}) select a.user_id, a.kf as i, b.kf as j from k a join k b on a.user_id = b.user_id and abs(a.kf - b.kf) between 1 and 2")
def neighbour_edges(spark, d):
    return joins.neighbour_edges(keyframes(spark, d), "user_id", "kf", 2)


@query(
    "farthest_neighbour",
    f"""with k as ({_KEYFRAMES}), e as (select a.user_id, a.event_id as ti, b.event_id as tj, b.kf as j, a.kf as i from k a join k b on a.user_id = b.user_id and abs(a.kf - b.kf) between 1 and 3)
    select user_id, i, j, gap from (select user_id, i, j, abs(tj - ti) as gap, row_number() over (partition by user_id, i order by abs(tj - ti) desc, j) as r from e) where r = 1""",
)
def farthest_neighbour(spark, d):
    k = keyframes(spark, d)
    e = joins.neighbour_edges(k, "user_id", "kf", 3)
    at = lambda s: k.select("user_id", F.col("kf").alias(s), F.col("event_id").alias(f"t{s}"))
    gaps = e.join(at("i"), ["user_id", "i"]).join(at("j"), ["user_id", "j"]).withColumn("gap", F.abs(F.col("tj") - F.col("ti")))
    return gaps.groupBy("user_id", "i").agg(F.max(F.struct("gap", (-F.col("j")).alias("nj"))).alias("b")).select("user_id", "i", (-F.col("b.nj")).alias("j"), F.col("b.gap").alias("gap"))


def _supply(spark, d, flag):
    return table(spark, d, "lineitem").where(F.col("l_returnflag") == flag).select(F.col("l_suppkey").alias("i"), (F.col("l_partkey") % 50).alias("j"))


_SUPPLY = "select l_suppkey as i, l_partkey % 50 as j from lineitem where l_returnflag = '{}'"


@query("edge_dedupe_anti", f"select distinct i, j from ({_SUPPLY.format('R')}) f where not exists (select 1 from ({_SUPPLY.format('A')}) k where k.i = f.i and k.j = f.j)")
def edge_dedupe_anti(spark, d):
    return joins.new_edges(_supply(spark, d, "R"), _supply(spark, d, "A"))


@query("edge_remove_reindex", f"select i - (i >= 5)::int as i, j - (j >= 5)::int as j, count(*) as n from ({_SUPPLY.format('R')}) where i <> 5 and j <> 5 group by 1, 2")
def edge_remove_reindex(spark, d):
    return joins.without_keyframe(_supply(spark, d, "R"), 5).groupBy("i", "j").agg(F.count(F.lit(1)).alias("n"))


@query("edge_revive", f"select i, j, count(*) as n from (select * from ({_SUPPLY.format('R')}) union all select * from ({_SUPPLY.format('A')}) where i >= 7 and j >= 7) group by i, j")
def edge_revive(spark, d):
    return joins.revived(_supply(spark, d, "R"), _supply(spark, d, "A"), 10).groupBy("i", "j").agg(F.count(F.lit(1)).alias("n"))


@query("edge_split", f"select i, j, count(*) filter (where i > j) as retired, count(*) filter (where not i > j) as kept from ({_SUPPLY.format('R')}) group by i, j")
def edge_split(spark, d):
    kept, gone = joins.split_edges(_supply(spark, d, "R"), F.col("i") > F.col("j"))
    both = kept.withColumn("g", F.lit(0)).unionByName(gone.withColumn("g", F.lit(1)))
    return both.groupBy("i", "j").agg(F.sum("g").alias("retired"), F.sum(1 - F.col("g")).alias("kept"))


@query("fixed_variable_anti", f"select i, j, count(*) as n from ({_SUPPLY.format('R')}) where j not in (select n_nationkey from nation where n_regionkey = 1) group by i, j")
def fixed_variable_anti(spark, d):
    fixed = table(spark, d, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").cast("long").alias("j"))
    return joins.without_fixed(_supply(spark, d, "R"), fixed, "j").groupBy("i", "j").agg(F.count(F.lit(1)).alias("n"))


@query(
    "multiview_edges",
    """with e as (select n_nationkey as i, n_regionkey as j from nation), v as (select unnest(range(3)) as qi),
    x as (select i as pi, qi, case when i = j and i < 3 then (i + 1) % 3 else j end as pj, case when i = j and i < 3 then (qi + 1) % 3 else qi end as qj from e, v)
    select pi, qi, pi * 3 + qi as di, pj, (qj + 1) % 3 as qj, pj * 3 + (qj + 1) % 3 as dj from x""",
)
def multiview_edges(spark, d):
    edges = table(spark, d, "nation").select(F.col("n_nationkey").alias("i"), F.col("n_regionkey").alias("j"))
    grid = camera.pixel_grid(spark, 3, 3).select(F.col("v").alias("pi"), F.col("u").alias("qi"))
    cross = grid.withColumns({"pj": (F.col("pi") + 1) % 3, "qj": (F.col("qi") + 1) % 3})
    return joins.multiview(edges, 3, cross, 1).select("pi", "pj", *[F.col(c).cast("long").alias(c) for c in ("qi", "di", "qj", "dj")])


@query("track_edges", "select n_nationkey as i, cast(n_nationkey - m as integer) as j from nation, (select unnest(range(1, 4)) as m) where n_nationkey - m >= 0")
def track_edges(spark, d):
    return joins.track_edges(table(spark, d, "nation"), "n_nationkey", 4)


@query(
    "best_cross_partner",
    """select l_suppkey, case when p < 950 then l_partkey end as l_partkey, p as l_extendedprice from (
    select l_suppkey, l_partkey, l_extendedprice as p, row_number() over (partition by l_suppkey order by l_extendedprice, l_partkey) as r from lineitem) where r = 1""",
)
def best_cross_partner(spark, d):
    return joins.best_partner(table(spark, d, "lineitem").select("l_suppkey", "l_partkey", "l_extendedprice"), ["l_suppkey"], "l_partkey", "l_extendedprice", 950.0)


_PAIRS = """select o_orderkey as i, lead(o_orderkey) over (partition by o_custkey order by o_orderkey) as j from orders"""


def _order_pairs(spark, d):
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("i"), F.lead("o_orderkey").over(w).alias("j")).where("j is not null")


@query(
    "track_correspond",
    f"""with t as (select l_orderkey as f, l_partkey % 200 as p, l_quantity as x from lineitem), e as (select * from ({_PAIRS}) where j is not null)
    select e.i, e.j, a.p as point, a.x as x_i, b.x as x_j from e join t a on a.f = e.i join t b on b.f = e.j and b.p = a.p""",
)
def track_correspond(spark, d):
    tracks = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("f"), (F.col("l_partkey") % 200).alias("point"), F.col("l_quantity").alias("x"))
    return joins.correspondences(tracks, "f", "point", _order_pairs(spark, d), ["x"])


_PLACES = "select l_returnflag as flag, l_quantity * 0.37 as u, l_discount * 97 + l_tax as v, l_extendedprice as z, l_partkey as p from lineitem"


def _places(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_returnflag").alias("flag"), (F.col("l_quantity") * 0.37).alias("u"), (F.col("l_discount") * 97 + F.col("l_tax")).alias("v"), F.col("l_extendedprice").alias("z"), F.col("l_partkey").alias("p"))


@query(
    "flow_splat",
    f"""with c as (select *, floor(u) as x0, floor(v) as y0 from ({_PLACES})),
    s as (select flag, x0 + dx as x, y0 + dy as y, (case when dx = 1 then u - x0 else 1 - (u - x0) end) * (case when dy = 1 then v - y0 else 1 - (v - y0) end) as w, z
          from c, (select unnest([0, 1]) as dx), (select unnest([0, 1]) as dy)),
    g as (select flag, x, y, sum(w) as weight, sum(w * z) as z from s where x between 0 and 15 and y between 0 and 7 and w > 0 group by 1, 2, 3)
    select flag, cast(x as bigint) as u, cast(y as bigint) as v, round(weight, 5) + 0.0 as weight, round(z / weight, 4) + 0.0 as z from g where weight >= 0.1""",
)
def flow_splat(spark, d):
    out = joins.splat(_places(spark, d), ["flag"], "u", "v", 16, 8, ["z"], least=0.1)
    return out.select("flag", "u", "v", near(F.col("weight"), 5).alias("weight"), near(F.col("z"), 4).alias("z"))


@query(
    "project_map_nearest",
    f"""select flag, u, v, z, p from (select flag, cast(floor(u) as bigint) as u, cast(floor(v) as bigint) as v, z, p,
       row_number() over (partition by flag, floor(u), floor(v) order by z, p) as r from ({_PLACES}) where u > 0 and u < 16 and v > 0 and v < 8 and z > 0) where r = 1""",
)
def project_map_nearest(spark, d):
    return joins.project_map(_places(spark, d), ["flag"], "u", "v", "z", 16, 8, ["p"])


@query(
    "bilinear_sample",
    f"""with c as (select *, floor(u) as x0, floor(v) as y0 from (select distinct p % 100 as k, u, v from ({_PLACES}))),
    s as (select k, u, v, x0 + dx as x, y0 + dy as y, (case when dx = 1 then u - x0 else 1 - (u - x0) end) * (case when dy = 1 then v - y0 else 1 - (v - y0) end) as w
          from c, (select unnest([0, 1]) as dx), (select unnest([0, 1]) as dy))
    select k, round(u, 6) as u, round(v, 6) as v, round(sum(case when x between 0 and 11 and y between 0 and 5 then w * (x * x + 3 * y) else 0 end), 6) + 0.0 as value from s group by k, s.u, s.v""",
)
def bilinear_sample(spark, d):
    grid = camera.pixel_grid(spark, 12, 6).select("u", "v", (F.col("u") * F.col("u") + 3 * F.col("v")).cast("double").alias("value"))
    places = _places(spark, d).select((F.col("p") % 100).alias("k"), "u", "v").distinct()
    return joins.bilinear(grid, places, [], "u", "v", ["value"]).select("k", F.round("u", 6).alias("u"), F.round("v", 6).alias("v"), near(F.col("value")).alias("value"))


_AXES = ["x", "y", "z"]
_EMB = "select vec_id, label, embedding[1]::double as x, embedding[2]::double as y, embedding[3]::double as z, embedding[4]::double as d from embeddings"


def _points(spark, d, where, name):
    e = table(spark, d, "embeddings").where(where)
    return e.select(F.col("vec_id").alias(name), *[e["embedding"][i].cast("double").alias(a) for i, a in enumerate(_AXES)], e["embedding"][3].cast("double").alias("d"))


_KNN = f"""select q.vec_id as query_id, p.vec_id as point_id, (q.x - p.x) * (q.x - p.x) + (q.y - p.y) * (q.y - p.y) + (q.z - p.z) * (q.z - p.z) as d2, q.d as qd, p.d as pd,
    row_number() over (partition by q.vec_id order by (q.x - p.x) * (q.x - p.x) + (q.y - p.y) * (q.y - p.y) + (q.z - p.z) * (q.z - p.z), p.vec_id) as rank
    from (select * from ({_EMB}) where label < 3) q, (select * from ({_EMB}) where label >= 3) p"""


def _knn(spark, d):
    return joins.knn(_points(spark, d, "label < 3", "query_id"), _points(spark, d, "label >= 3", "point_id"), [], _AXES, 5, 0.25, "query_id", "point_id")


@query("knn_join", f"select query_id, point_id, round(d2, 6) + 0.0 as d2, rank from ({_KNN}) where rank <= 5")
def knn_join(spark, d):
    return _knn(spark, d).select("query_id", "point_id", near(F.col("d2")).alias("d2"), F.col("rank").cast("long").alias("rank"))


@query(
    "knn_affine_fill",
    f"""with n as (select query_id, pd as y, pd * 0.5 + rank as x, 1 / greatest(sqrt(d2), 1e-6) as w from ({_KNN}) where rank <= 5),
    s as (select query_id, sum(w) as w, sum(w * x) as x, sum(w * y) as y, sum(w * x * x) as xx, sum(w * x * y) as xy from n group by 1),
    f as (select *, case when abs(w * xx - x * x) > 1e-12 then (w * xy - x * y) / (w * xx - x * x) else 0 end as scale from s)
    select query_id, round(scale, 5) + 0.0 as scale, round((y - scale * x) / w, 5) + 0.0 as shift from f""",
)
def knn_affine_fill(spark, d):
    known = _points(spark, d, "label >= 3", "point_id").select("point_id", F.col("d").alias("y"))
    n = _knn(spark, d).join(known, "point_id").withColumn("x", F.col("y") * 0.5 + F.col("rank"))
    return joins.knn_affine_fill(n, ["query_id"], "x", "y", "d2").select("query_id", near(F.col("scale"), 5).alias("scale"), near(F.col("shift"), 5).alias("shift"))


@query("knn_mean_fill", f"select query_id, round(avg(pd), 6) + 0.0 as value from ({_KNN}) where rank <= 5 group by 1")
def knn_mean_fill(spark, d):
    known = _points(spark, d, "label >= 3", "point_id").select("point_id", F.col("d").alias("y"))
    return _knn(spark, d).join(known, "point_id").groupBy("query_id").agg(near(F.avg("y")).alias("value"))


@query(
    "new_objects",
    """with s as (select l_orderkey as v, l_linenumber as u, l_suppkey as segment from lineitem), t as (select l_orderkey as v, l_linenumber as u from lineitem where l_returnflag = 'R'),
    a as (select segment, count(*) as total, count(*) filter (where not exists (select 1 from t where t.v = s.v and t.u = s.u)) as area from s group by 1)
    select segment, total, area, row_number() over (order by segment) as object_id from a where area >= 20 and area / total >= 0.55 qualify object_id <= 255""",
)
def new_objects(spark, d):
    li = table(spark, d, "lineitem")
    pixels = li.select(F.col("l_orderkey").alias("v"), F.col("l_linenumber").alias("u"), F.col("l_suppkey").alias("segment"))
    tracked = li.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("v"), F.col("l_linenumber").alias("u")).distinct()
    out = joins.new_objects(pixels, tracked, ["v", "u"], "segment", least_area=20, least_share=0.55)
    return out.select("segment", "total", "area", F.col("object_id").cast("long").alias("object_id"))


@query(
    "pair_correlation",
    """select a.vec_id as i, b.vec_id as j, round(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda p: p[1]::double * p[2]::double)) / 16, 5) + 0.0 as corr
    from embeddings a join embeddings b on b.vec_id between a.vec_id + 1 and a.vec_id + 3""",
)
def pair_correlation(spark, d):
    e = table(spark, d, "embeddings")
    edges = joins.band(e.select(F.col("vec_id").alias("i")), e.select(F.col("vec_id").alias("j")), [], "i", "j", 1, 3)
    left, right = e.select(F.col("vec_id").alias("i"), "embedding"), e.select(F.col("vec_id").alias("j"), "embedding")
    return joins.correlation(left, right, edges, "embedding").select("i", "j", near(F.col("corr"), 5).alias("corr"))


@query(
    "corr_top_k",
    """with c as (select a.vec_id as i, b.vec_id as j, list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda p: p[1]::double * p[2]::double)) / 16 as corr from embeddings a join embeddings b on b.vec_id between a.vec_id + 1 and a.vec_id + 8)
    select i, j, round(corr, 5) + 0.0 as corr, rank from (select *, row_number() over (partition by i order by corr desc, j) as rank from c) where rank <= 2""",
)
def corr_top_k(spark, d):
    from tessella.operators.windows import top_k

    e = table(spark, d, "embeddings")
    edges = joins.band(e.select(F.col("vec_id").alias("i")), e.select(F.col("vec_id").alias("j")), [], "i", "j", 1, 8)
    c = joins.correlation(e.select(F.col("vec_id").alias("i"), "embedding"), e.select(F.col("vec_id").alias("j"), "embedding"), edges, "embedding")
    return top_k(c, ["i"], "corr", ["j"], 2).select("i", "j", near(F.col("corr"), 5).alias("corr"), F.col("rank").cast("long").alias("rank"))


@query(
    "multiview_zip",
    """with v as (select event_type, value, row_number() over (partition by event_type order by event_id) as n from events where event_type in ('click', 'view'))
    select a.n as frame_idx, a.value as click, b.value as seen from v a join v b on a.n = b.n where a.event_type = 'click' and b.event_type = 'view'""",
)
def multiview_zip(spark, d):
    w = Window.partitionBy("event_type").orderBy("event_id")
    v = table(spark, d, "events").where("event_type in ('click', 'view')").select("event_type", "value", F.row_number().over(w).cast("long").alias("frame_idx"))
    side = lambda t, n: v.where(F.col("event_type") == t).select("frame_idx", F.col("value").alias(n))
    return side("click", "click").join(side("view", "seen"), "frame_idx")


@query("viewer_outer", "select o.o_orderkey, c.c_name from orders o left join (select * from customer where c_acctbal > 0) c on c.c_custkey = o.o_custkey where o.o_orderkey % 5 = 0")
def viewer_outer(spark, d):
    """Frames with a depth where there is one; temporal subsampling reaches the scan."""
    from tessella.operators.windows import sampled

    orders = table(spark, d, "orders").where(sampled(F.col("o_orderkey"), 5)).select("o_orderkey", "o_custkey")
    some = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return orders.join(some, "o_custkey", "left").select("o_orderkey", "c_name")


@query("splat_in_place", f"""with c as (select *, floor(u + 0.5) as x0, floor(v + 0.5) as y0 from ({_PLACES})),
    s as (select flag, x0 + dx as x, y0 + dy as y, (case when dx = 1 then u - x0 else 1 - (u - x0) end) * (case when dy = 1 then v - y0 else 1 - (v - y0) end) as w, z
          from (select * from c where x0 >= 0 and x0 + 1 < 16 and y0 >= 0 and y0 + 1 < 8), (select unnest([0, 1]) as dx), (select unnest([0, 1]) as dy))
    select flag, cast(x as bigint) as u, cast(y as bigint) as v, round(sum(w), 4) + 0.0 as weight, round(sum(w * z), 1) + 0.0 as z from s group by 1, 2, 3""")
def splat_in_place(spark, d):
    """Shares of rounded corners, some of them negative."""
    out = joins.splat_in_place(_places(spark, d), ["flag"], "u", "v", 16, 8, ["z"])
    return out.select("flag", "u", "v", near(F.col("weight"), 4).alias("weight"), near(F.col("z"), 1).alias("z"))


@query("proximity_edges")
def proximity_edges(spark, d):
    """Edges of a graph for each label: frames are its vectors in order, distances those of their first elements; every seventh pair is known."""
    from tessella.operators import graph

    most, w = 200, Window.partitionBy("label").orderBy("vec_id")
    frames = table(spark, d, "embeddings").where("label is not null").select("label", (F.row_number().over(w) - 1).cast("long").alias("n"), *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(3)])
    sizes = frames.groupBy("label").agg(F.count(F.lit(1)).alias("frames"))
    known = frames.where("n >= 7 and n % 7 = 0").select("label", F.col("n").alias("i"), (F.col("n") - 7).alias("j"))
    # All pairs of the graphs that have room for edges by distance: few frames each, as neighbours fill the others.
    small = frames.join(sizes.where(~graph.filled(F.col("frames"), most)).select("label"), "label")
    a, b = (small.select("label", F.col("n").alias(s), *[F.col(f"e{i}").alias(f"{s}{i}") for i in range(3)]) for s in "ij")
    way = sum(((F.col(f"i{k}") - F.col(f"j{k}")) * (F.col(f"i{k}") - F.col(f"j{k}")) for k in (1, 2)), (F.col("i0") - F.col("j0")) * (F.col("i0") - F.col("j0")))
    pairs = a.join(b, "label").select("label", "i", "j", (F.sqrt(way) * 4).alias("d"))
    return graph.proximity_edges(pairs, known, "label", most=most, limit=6.0, sizes=sizes)
