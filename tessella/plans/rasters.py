"""Pixel operators on rasters, one for each supplier: pixels in closed form of the supplier's key."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.catalogue import query
from tessella.functions.camera import pixel_grid
from tessella.operators import calibrate, pixels
from tessella.plans.tables import near, table

_GRID = "select s_suppkey as k, cast(v as integer) as v, cast(u as integer) as u, (v * 7 + u * 11 + s_suppkey * 5) % 17 as x from supplier, (select unnest(range(16)) as v), (select unnest(range(20)) as u)"


def _grid(spark, d):
    frames = table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"))
    return frames.join(F.broadcast(pixel_grid(spark, 20, 16))).select("k", "v", "u", ((F.col("v") * 7 + F.col("u") * 11 + F.col("k") * 5) % 17).alias("x"))  # the grid is one raster


def _pool(f: str) -> str:
    return f"select a.k, a.v, a.u, {f}(b.x) as x from ({_GRID}) a join ({_GRID}) b on b.k = a.k and b.v between a.v - 1 and a.v + 1 and b.u between a.u - 1 and a.u + 1 group by 1, 2, 3"


@query("mask_erode", _pool("min"))
def mask_erode(spark, d):
    return pixels.eroded(_grid(spark, d), ["k"], "x", 3)


@query("mask_dilate", _pool("max"))
def mask_dilate(spark, d):
    return pixels.dilated(_grid(spark, d), ["k"], "x", 3)


@query(
    "nearest_resize",
    f"select s.k, g.nv as v, g.nu as u, s.x from (select cast(nv as integer) as nv, cast(nu as integer) as nu, cast(least(greatest(round_even((nv + 0.5) * 16 / 11 - 0.5, 0), 0), 15) as integer) as v, cast(least(greatest(round_even((nu + 0.5) * 20 / 9 - 0.5, 0), 0), 19) as integer) as u from (select unnest(range(11)) as nv), (select unnest(range(9)) as nu)) g join ({_GRID}) s on s.v = g.v and s.u = g.u",
)
def nearest_resize(spark, d):
    return pixels.nearest_resized(_grid(spark, d), ["k"], 16, 20, 11, 9).select("k", "v", "u", "x")


@query("raster_crop", f"select k, v - 2 as v, u - 3 as u, x from ({_GRID}) where v >= 2 and v < 12 and u >= 3 and u < 17")
def raster_crop(spark, d):
    return pixels.cropped(_grid(spark, d), 2, 12, 3, 17)


@query(
    "corr_pyramid_lookup",
    f"""with l0 as (select v, u, x from ({_GRID}) where k = 1), l1 as (select v // 2 as v, u // 2 as u, avg(x) as x from l0 group by 1, 2),
    p as (select n_nationkey as k, n_nationkey * 0.7 as cu, n_regionkey * 2.3 as cv from nation),
    w as (select k, level, dv, du, cu / pow(2, level) + du as x, cv / pow(2, level) + dv as y from p, (select unnest([0, 1]) as level), (select unnest(range(-1, 2)) as dv), (select unnest(range(-1, 2)) as du)),
    c as (select *, floor(x) as x0, floor(y) as y0 from w),
    s as (select k, level, dv, du, x0 + ex as sx, y0 + ey as sy, (case when ex = 1 then x - x0 else 1 - (x - x0) end) * (case when ey = 1 then y - y0 else 1 - (y - y0) end) as wt from c, (select unnest([0, 1]) as ex), (select unnest([0, 1]) as ey)),
    g as (select 0 as level, v, u, x from l0 union all select 1, v, u, x from l1)
    select k, s.level, cast(dv as integer) as dv, cast(du as integer) as du, round(sum(coalesce(g.x * wt, 0)), 6) + 0.0 as value from s left join g on g.level = s.level and g.v = s.sy and g.u = s.sx group by 1, 2, 3, 4""",
)
def corr_pyramid_lookup(spark, d):
    levels = pixels.pooled_pyramid(_grid(spark, d).where("k = 1").withColumn("value", F.col("x").cast("double")), [], "value", 2)
    places = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), (F.col("n_nationkey") * 0.7).alias("cu"), (F.col("n_regionkey") * 2.3).alias("cv"))
    return pixels.pyramid_lookup(levels, places, [], "cu", "cv", "value", 1).select("k", "level", "dv", "du", near(F.col("value")).alias("value"))


@query(
    "patch_correlation",
    f"select a.k, a.v, a.u, cast(b.v - a.v as integer) as dv, cast(b.u - a.u as integer) as du, (a.x * b.x + (a.x + 1) * (b.x + 2))::double as corr from ({_GRID}) a join ({_GRID}) b on b.k = a.k and b.v between a.v - 1 and a.v + 1 and b.u between a.u - 1 and a.u + 1",
)
def patch_correlation(spark, d):
    g = _grid(spark, d)
    a = g.select("k", "v", "u", F.array("x", F.col("x") + 1).alias("f"))
    b = g.select("k", "v", "u", F.array("x", F.col("x") + 2).alias("f"))
    return pixels.patch_correlation(a, b, ["k"], "f", 1)


@query(
    "sparse_sample_lidar",
    f"""with r as (select sin(p) as y, cos(p) * sin(w) as x from (select -0.5 + unnest(range(6)) * (1.0 / 5) as p), (select -pi() / 2.1 + unnest(range(200)) * (2 * (pi() / 2.1) / 199) as w)),
    q as (select distinct cast(round_even((16 * x + 10 * z) / (z + 1e-8), 0) as integer) as u, cast(round_even((16 * y + 8 * z) / (z + 1e-8), 0) as integer) as v from (select *, sqrt(1 - x * x - y * y) as z from r))
    select k, v, u, x, false as cover from ({_GRID}) join q using (v, u) where x > 0.0001""",
)
def sparse_sample_lidar(spark, d):
    return pixels.sparse_sample(_grid(spark, d), "LiDAR_6", "x", 20, 16, keys=["k"]).select("k", "v", "u", "x", "cover")


@query("sparse_sample_distance", f"select k, v, u, x, true as cover from ({_GRID}) where x > 3 and x < 12")
def sparse_sample_distance(spark, d):
    """Fewer pixels than are drawn at most, so all of the range stay."""
    return pixels.sparse_sample(_grid(spark, d), "distance_3_12", "x", keys=["k"]).select("k", "v", "u", "x", "cover")


@query(
    "sparse_sample_downscale",
    f"""with g as (select k, v, u, x + 1.5 as x from ({_GRID})), t as (select a, b, a * 15.0 / 3 as y, b * 19.0 / 4 as x, a * 4 as v, b * 4 as u from (select unnest(range(4)) as a), (select unnest(range(5)) as b)),
    c as (select t.*, floor(x) + dx as cu, floor(y) + dy as cv, (case when dx = 1 then x - floor(x) else 1 - (x - floor(x)) end) * (case when dy = 1 then y - floor(y) else 1 - (y - floor(y)) end) as w from t, (select unnest([0, 1]) as dx), (select unnest([0, 1]) as dy))
    select g.k, cast(c.v as integer) as v, cast(c.u as integer) as u, round(sum(g.x * c.w), 6) + 0.0 as x from c join g on g.v = c.cv and g.u = c.cu group by 1, 2, 3""",
)
def sparse_sample_downscale(spark, d):
    """Every pixel is measured, so nothing is filled: corners of the small raster meet those of the large one."""
    out = pixels.sparse_sample(_grid(spark, d).withColumn("x", F.col("x") + 1.5), "downscale_4", "x", 20, 16, keys=["k"])
    return out.select("k", "v", "u", near(F.col("x")).alias("x"))


@query(
    "display_range",
    """with f as (select l_returnflag as k, l_suppkey as f, quantile_cont(case when l_quantity > 0 and l_tax < 0.08 then 1 / l_quantity end, [0.05, 0.95]) as q from lineitem group by 1, 2), b as (select k, min(q[1]) as a, max(q[2]) as b from f group by 1)
    select k, round((a + b) / 2 - (b - a) / 2 * 1.3, 6) + 0.0 as low, round((a + b) / 2 + (b - a) / 2 * 1.3, 6) + 0.0 as high from b""",
)
def display_range(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("k"), F.col("l_suppkey").alias("f"), F.col("l_quantity").alias("z"), (F.col("l_tax") >= 0.08).alias("sky"))
    return pixels.display_range(rows, ["k"], "f", "z", F.col("sky")).select("k", near(F.col("low")).alias("low"), near(F.col("high")).alias("high"))


@query(
    "calibrate_camera",
    "select s_suppkey as stream, round(0.3 * sin(s_suppkey), 4) + 0.0 as roll, round(0.25 * cos(s_suppkey * 2), 4) + 0.0 as pitch, round(400.0 + 13 * (s_suppkey % 37), 3) + 0.0 as focal from supplier",
)
def calibrate_camera(spark, d):
    """Roll, pitch and focal length of a camera for each supplier, found again from the fields that they make."""
    from tessella.functions import camera

    s = F.col("stream")
    cameras = table(spark, d, "supplier").select(F.col("s_suppkey").alias("stream"))
    grid = spark.range(16 * 12).select(((F.col("id") % 16) * 40.0).alias("x"), (F.floor(F.col("id") / 16) * 40.0).alias("y"))
    rows = cameras.join(F.broadcast(grid)).withColumns({"roll": 0.3 * F.sin(s), "pitch": 0.25 * F.cos(s * 2), "focal": 400.0 + 13 * (s % 37)})  # the grid is one image
    g = camera.gravity(F.col("roll"), F.col("pitch"))
    at = (F.col("x") - 320) / F.col("focal"), (F.col("y") - 240) / F.col("focal")
    up = camera.up_field(*at, g)
    seen = rows.select("stream", "x", "y", up[0].alias("up_x"), up[1].alias("up_y"), camera.latitude(*at, g).alias("latitude"), F.lit(1.0).alias("weight"))
    out = calibrate.calibrated(seen, "stream", 640.0, 480.0)
    return out.select("stream", near(F.col("roll"), 4).alias("roll"), near(F.col("pitch"), 4).alias("pitch"), near(F.col("focal"), 3).alias("focal"))
