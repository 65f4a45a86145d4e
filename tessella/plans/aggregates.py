"""Reductions by index, fits and metrics on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.catalogue import query
from tessella.operators import align, scatter
from tessella.operators.quantiles import quantiles
from tessella.plans.tables import near, table

_SRC = "select l_suppkey % 20 as idx, cast(l_quantity as bigint) as q, case when l_orderkey % 97 = 0 then 2.0 else 1.0 end as f, l_orderkey * 10 + l_linenumber as o from lineitem"


def _src(spark, d):
    return table(spark, d, "lineitem").select((F.col("l_suppkey") % 20).alias("idx"), F.col("l_quantity").cast("long").alias("q"), F.when(F.col("l_orderkey") % 97 == 0, 2.0).otherwise(1.0).alias("f"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("o"))


def _dense(expr: str, empty: str) -> str:
    return f"select i as idx, coalesce(v, {empty}) as value from range(25) t(i) left join (select idx, {expr} as v from ({_SRC}) group by 1) on idx = i"


@query("scatter_sum", _dense("cast(sum(q) as bigint)", "0"))
def scatter_sum(spark, d):
    return scatter.scatter(_src(spark, d), "idx", F.col("q"), "sum", 25)


@query("scatter_mul", _dense("product(f)", "1"))
def scatter_mul(spark, d):
    return scatter.scatter(_src(spark, d), "idx", F.col("f"), "mul", 25)


@query("scatter_mean", _dense("cast(floor(sum(q) / greatest(count(q), 1)) as bigint)", "0"))
def scatter_mean(spark, d):
    return scatter.scatter(_src(spark, d), "idx", F.col("q"), "mean", 25, whole=True)


def _arg(f: str, sign: str) -> str:
    return f"""select i as idx, coalesce(v, 0) as value, coalesce(a, (select count(*) from ({_SRC}))) as arg from range(25) t(i)
    left join (select idx, {f}(q) as v, first(o order by q {sign}, o) as a from ({_SRC}) group by 1) on idx = i"""


@query("scatter_min", _arg("min", "asc"))
def scatter_min(spark, d):
    return scatter.scatter(_src(spark, d), "idx", F.col("q"), "min", 25, order="o")


@query("scatter_max", _arg("max", "desc"))
def scatter_max(spark, d):
    return scatter.scatter(_src(spark, d), "idx", F.col("q"), "max", 25, order="o")


@query("scatter_into", f"select i as idx, cast(coalesce(v, 0) + i * 10 as bigint) as value from range(25) t(i) left join (select idx, sum(q) as v from ({_SRC}) group by 1) on idx = i")
def scatter_into(spark, d):
    base = spark.range(25).select(F.col("id").alias("idx"), (F.col("id") * 10).alias("value"))
    return scatter.scatter(_src(spark, d), "idx", F.col("q"), "sum", 25, into=base)


@query("segment_accumulate", f"select idx, cast(sum(q) as bigint) as q from ({_SRC}) where idx in (select n_nationkey from nation where n_regionkey = 2) group by 1")
def segment_accumulate(spark, d):
    wanted = table(spark, d, "nation").where("n_regionkey = 2").select(F.col("n_nationkey").cast("long").alias("idx"))
    return scatter.segment_accumulate(_src(spark, d), "idx", "q", wanted)


@query(
    "prefix_pack",
    """with c as (select l_orderkey, l_returnflag, count(*) as n from lineitem group by 1, 2)
    select l_orderkey, l_returnflag, n, cast(coalesce(sum(n) over (partition by l_orderkey order by l_returnflag rows between unbounded preceding and 1 preceding), 0) as bigint) as start from c""",
)
def prefix_pack(spark, d):
    counts = table(spark, d, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    return scatter.packed(counts, ["l_returnflag"], "n", "l_orderkey")


_DEPTH = "select l_returnflag as k, l_orderkey as id, l_extendedprice / 1000 as s, (l_quantity + l_tax * 10) as t from lineitem"


def _depth(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_returnflag").alias("k"), F.col("l_orderkey").alias("id"), (F.col("l_extendedprice") / 1000).alias("s"), (F.col("l_quantity") + F.col("l_tax") * 10).alias("t"))


def _affine_sql(source: str, x: str, y: str) -> str:
    return f"""with s as (select k, count(*) as n, sum({x}) as x, sum({y}) as y, sum({x} * {x}) as xx, sum({x} * {y}) as xy from ({source}) group by 1)
    select k, round((n * xy - x * y) / (n * xx - x * x), 6) + 0.0 as scale, round((xx * y - x * xy) / (n * xx - x * x), 6) + 0.0 as bias from s"""


def _trim_sql(source: str, x: str, y: str) -> str:
    return f"""select r.* from ({source}) r join (select k, quantile_cont({x}, [0.1, 0.9]) as bx, quantile_cont({y}, [0.1, 0.9]) as by_ from ({source}) group by 1) b using (k)
    where {x} > bx[1] and {x} < bx[2] and {y} > by_[1] and {y} < by_[2]"""


def _shown(df):
    return df.select("k", near(F.col("scale")).alias("scale"), near(F.col("bias")).alias("bias"))


@query("scale_shift_lsq", _affine_sql(_DEPTH, "s", "t"))
def scale_shift_lsq(spark, d):
    return _shown(align.affine(_depth(spark, d), ["k"], F.col("s"), F.col("t")))


@query("quantile_trim_inverse_lsq", _affine_sql(_trim_sql(_DEPTH.replace("from lineitem", ", 1 / (l_quantity + l_tax * 10) as ti from lineitem"), "s", "ti"), "s", "ti"))
def quantile_trim_inverse_lsq(spark, d):
    return _shown(align.inverse_depth_fit(_depth(spark, d), ["k"], "s", "t"))


@query("quantile_trim_lsq", _affine_sql(_trim_sql(_DEPTH, "s", "t"), "s", "t"))
def quantile_trim_lsq(spark, d):
    return _shown(align.depth_fit(_depth(spark, d), ["k"], "s", "t", "affine"))


@query("median_ratio_scale", f"select k, round(quantile_disc(t / s, 0.5), 6) + 0.0 as scale, 0.0::double as bias from ({_trim_sql(_DEPTH, 's', 't')}) group by 1")
def median_ratio_scale(spark, d):
    return _shown(align.depth_fit(_depth(spark, d), ["k"], "s", "t", "median"))


@query("scale_lsq", f"select k, round(sum(t * s) / greatest(sum(s * s), 1e-12), 8) + 0.0 as scale from ({_DEPTH}) group by 1")
def scale_lsq(spark, d):
    return align.scale_only(_depth(spark, d), ["k"], F.col("t"), F.col("s")).select("k", near(F.col("scale"), 8).alias("scale"))


@query(
    "absrel_rmselog_delta1",
    """select l_returnflag as k, round(sum(abs(o - t) / t) / count(*), 6) + 0.0 as abs_rel, round(sqrt(avg(pow(ln(o) - ln(t), 2))), 6) + 0.0 as rmse_log, round(avg((greatest(o / t, t / o) < 1.25)::int), 6) + 0.0 as delta1
    from (select l_returnflag, l_extendedprice as o, l_quantity * p_retailprice as t from lineitem join part on p_partkey = l_partkey) where o > 0 and t > 0 group by 1""",
)
def absrel_rmselog_delta1(spark, d):
    part = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    rows = table(spark, d, "lineitem").join(part, "l_partkey").select(F.col("l_returnflag").alias("k"), F.col("l_extendedprice").alias("o"), (F.col("l_quantity") * F.col("p_retailprice")).alias("t")).where("o > 0 and t > 0")
    m = rows.groupBy("k").agg(*align.depth_metrics(F.col("o"), F.col("t")))
    return m.select("k", *[near(F.col(c)).alias(c) for c in ("abs_rel", "rmse_log", "delta1")])


@query(
    "minmax_normalise",
    """select o_orderkey, round((o_totalprice - lo) / case when hi = lo then 1 else hi - lo end, 6) + 0.0 as normalised from orders join
    (select o_orderpriority, min(o_totalprice) filter (o_orderstatus = 'F') as lo, max(o_totalprice) filter (o_orderstatus = 'F') as hi from orders group by 1) using (o_orderpriority)""",
)
def minmax_normalise(spark, d):
    out = align.normalised(table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice"), ["o_orderpriority"], "o_totalprice", F.col("o_orderstatus") == "F")
    return out.select("o_orderkey", near(F.col("normalised")).alias("normalised"))


@query(
    "coverage_score",
    """select flag, round(sum(hit) / 100.0, 6) + 0.0 as score from (select l_returnflag as flag, floor(u / 5) as a, floor(v / 3) as b, max((l_tax > 0.07)::int) as hit from
    (select *, l_quantity - 1 as u, l_suppkey % 33 as v from lineitem) where u < 50 and v < 30 group by 1, 2, 3) group by 1""",
)
def coverage_score(spark, d):
    px = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("flag"), (F.col("l_quantity") - 1).alias("u"), (F.col("l_suppkey") % 33).alias("v"), (F.col("l_tax") > 0.07).alias("ok"))
    return align.coverage(px, ["flag"], F.col("u"), F.col("v"), F.col("ok"), F.lit(50), F.lit(33)).select("flag", near(F.col("score")).alias("score"))


@query(
    "robust_bbox",
    "select l_returnflag as k, " + ", ".join(f"round(quantile_cont({c}, {q}), 6) + 0.0 as {n}_{c}" for c in ("l_quantity", "l_extendedprice", "l_tax") for n, q in (("low", 0.01), ("high", 0.99))) + " from lineitem group by 1",
)
def robust_bbox(spark, d):
    b = align.box(table(spark, d, "lineitem").withColumnRenamed("l_returnflag", "k"), ["k"], ["l_quantity", "l_extendedprice", "l_tax"])
    return b.select("k", *[near(F.col(c)).alias(c) for c in b.columns if c != "k"])


@query(
    "frame_distance_weighted",
    """select l_suppkey as k, case when count(*) filter (ok) / count(*) < 0.75 then 1000.0 else round(sum(0.3 * a + 0.7 * b) filter (ok) / greatest(count(*) filter (ok), 1), 6) + 0.0 end as distance
    from (select l_suppkey, l_quantity as a, l_discount * 100 as b, l_tax > 0.01 as ok from lineitem) group by 1""",
)
def frame_distance_weighted(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_quantity").alias("a"), (F.col("l_discount") * 100).alias("b"), (F.col("l_tax") > 0.01).alias("ok"))
    out = align.frame_distance(rows, ["k"], F.col("a"), F.col("b"), F.col("ok"))
    return out.select("k", near(F.col("distance")).alias("distance"))


@query(
    "frame_distance_both_ways",
    """with e as (select l_suppkey as i, l_partkey % 10 as j, avg(l_quantity) as d from lineitem group by 1, 2), b as (select i, j, d from e union all select j, i, d from e)
    select i, j, round(avg(d), 6) + 0.0 as distance from b group by 1, 2""",
)
def frame_distance_both_ways(spark, d):
    e = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("i"), (F.col("l_partkey") % 10).alias("j")).agg(F.avg("l_quantity").alias("d"))
    both = e.unionByName(e.select(F.col("j").alias("i"), F.col("i").alias("j"), "d"))
    return both.groupBy("i", "j").agg(near(F.avg("d")).alias("distance"))


@query(
    "median_scale_carry",
    """with f as (select l_suppkey as k, l_orderkey // 100 as f, l_tax > 0.02 as ok, l_extendedprice / l_quantity as r from lineitem),
    g as (select k, f, quantile_disc(case when ok then r end, 0.5) as own, avg(ok::int) as share from f group by 1, 2)
    select k, f, round(coalesce(last_value(case when share >= 0.6 then own end ignore nulls) over (partition by k order by f), 1.0) + 1e-9, 6) + 0.0 as scale from g""",
)
def median_scale_carry(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("k"), F.floor(F.col("l_orderkey") / 100).alias("f"), (F.col("l_tax") > 0.02).alias("ok"), F.col("l_extendedprice").alias("p"), F.col("l_quantity").alias("t"))
    return align.median_scale(rows, ["k"], "f", "p", "t", F.col("ok"), 0.6).select("k", "f", near(F.col("scale") + 1e-9).alias("scale"))


@query("residual_energy", "select l_returnflag as term, round(sum(l_tax * l_quantity * l_quantity), 4) + 0.0 as energy from lineitem group by 1")
def residual_energy(spark, d):
    r = F.col("l_quantity")
    return table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("term")).agg(near(F.sum(F.col("l_tax") * r * r), 4).alias("energy"))


@query(
    "motion_score",
    f"""with t as (select l_orderkey as f, l_partkey % 200 as p, l_returnflag as view_, l_quantity as x from lineitem), e as (select * from (select o_orderkey as i, lead(o_orderkey) over (partition by o_custkey order by o_orderkey) as j from orders) where j is not null),
    m as (select i, j, a.view_, avg(abs(b.x - a.x)) as s from e join t a on a.f = i join t b on b.f = j and b.p = a.p group by 1, 2, 3)
    select i, j, round(min(s), 6) + 0.0 as score from m group by 1, 2""",
)
def motion_score(spark, d):
    """The smallest view's mean displacement of the points that two frames share."""
    from tessella.operators.joins import correspondences
    from tessella.plans.joins import _order_pairs

    tracks = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("f"), (F.col("l_partkey") % 200).alias("p"), F.col("l_quantity").alias("x"), F.col("l_returnflag").alias("w"))
    c = correspondences(tracks, "f", "p", _order_pairs(spark, d), ["x", "w"])
    per = c.groupBy("i", "j", F.col("w_i").alias("view_")).agg(F.avg(F.abs(F.col("x_j") - F.col("x_i"))).alias("s"))
    return per.groupBy("i", "j").agg(near(F.min("s")).alias("score"))


@query("median_of_scales", "select o_orderpriority as k, round(coalesce(quantile_cont(case when o_totalprice > 1000 then o_totalprice / 1000 end, 0.5), 1), 6) + 0.0 as scale from orders group by 1")
def median_of_scales(spark, d):
    good = F.when(F.col("o_totalprice") > 1000, F.col("o_totalprice") / 1000)
    rows = table(spark, d, "orders").select(F.col("o_orderpriority").alias("k"), good.alias("x"))
    return quantiles(rows, ["k"], {"x": F.col("x")}, [0.5]).select("k", near(F.coalesce(F.col("x")[0], F.lit(1.0))).alias("scale"))


@query("sky_fill", "select l_orderkey, l_linenumber, case when l_returnflag = 'N' then least(200.0, (select quantile_cont(l_extendedprice / 1000, 0.99) from lineitem where l_returnflag <> 'N')) else l_extendedprice / 1000 end as depth from lineitem")
def sky_fill(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", (F.col("l_extendedprice") / 1000).alias("depth"))
    level = quantiles(rows.where("l_returnflag <> 'N'"), [], {"depth": F.col("depth")}, [0.99]).select(F.least(F.lit(200.0), F.col("depth")[0]).alias("far"))  # one row
    return rows.join(F.broadcast(level)).select("l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "N", F.col("far")).otherwise(F.col("depth")).alias("depth"))


@query(
    "extrinsic_normalise",
    """with f as (select c_nationkey as k, c_custkey as v, c_acctbal as t, first_value(c_acctbal) over (partition by c_nationkey order by c_custkey) as t0 from customer),
    m as (select k, greatest(quantile_disc(abs(t - t0), 0.5), 0.1) as s from f group by 1) select f.k, f.v, round((t - t0) / s, 6) + 0.0 as t from f join m using (k)""",
)
def extrinsic_normalise(spark, d):
    """Places relative to a stream's first view, divided by their lower median distance."""
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_custkey").alias("v"), F.col("c_acctbal").alias("t"))
    first = c.groupBy("k").agg(F.min_by("t", "v").alias("t0"))
    rel = c.join(first, "k").select("k", "v", (F.col("t") - F.col("t0")).alias("r"))
    m = quantiles(rel, ["k"], {"r": F.abs("r")}, [0.5], lower=True).select("k", F.greatest(F.col("r")[0], F.lit(0.1)).alias("s"))
    return rel.join(m, "k").select("k", "v", near(F.col("r") / F.col("s")).alias("t"))


@query(
    "completion_uncertainty",
    """select o_orderkey, round(case when g > 0 then abs(o_totalprice - g) / g else 0 end, 6) + 0.0 as uncertainty from orders join (select o_orderpriority, avg(o_totalprice) as g from orders group by 1) using (o_orderpriority)""",
)
def completion_uncertainty(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    g = o.groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("g"))
    return o.join(g, "o_orderpriority").select("o_orderkey", near(align.completion_uncertainty(F.col("o_totalprice"), F.col("g"))).alias("uncertainty"))


@query(
    "logit_merge",
    """select l_orderkey, round(min(p), 6) + 0.0 as least, round(ln(least(greatest(product(p), 1e-5), 1 - 1e-5) / (1 - least(greatest(product(p), 1e-5), 1 - 1e-5))), 5) + 0.0 as soft
    from (select l_orderkey, 0.5 + l_tax * 4 as p from lineitem) group by 1""",
)
def logit_merge(spark, d):
    """Background of several engines: the least, and the logit of the product."""
    p = 0.5 + F.col("l_tax") * 4
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min(p).alias("least"), F.product(p).alias("all"))
    a = F.least(F.greatest(F.col("all"), F.lit(1e-5)), F.lit(1 - 1e-5))
    return rows.select("l_orderkey", near(F.col("least")).alias("least"), near(F.log(a / (1 - a)), 5).alias("soft"))


@query("track_merge_later_wins", "select l_suppkey, l_linenumber, last(l_partkey order by l_orderkey, l_partkey) as object_id from lineitem group by 1, 2")
def track_merge_later_wins(spark, d):
    return table(spark, d, "lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.max_by("l_partkey", F.struct("l_orderkey", "l_partkey")).alias("object_id"))


@query("object_bands", "select l_suppkey, cast(floor((l_suppkey - 1) / 10) as bigint) as band, cast(((l_suppkey - 1) % 10 + 10) % 10 + 1 as bigint) as local_id, count(*) as n from lineitem group by 1, 2, 3")
def object_bands(spark, d):
    k = F.col("l_suppkey")
    return table(spark, d, "lineitem").groupBy("l_suppkey", F.floor((k - 1) / 10).alias("band"), (F.pmod(k - 1, F.lit(10)) + 1).alias("local_id")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "depth_consistency",
    """with f as (select l_suppkey as frame, cast(l_quantity as bigint) as u, max(l_extendedprice) / 1000 as z from lineitem group by 1, 2)
    select a.frame, a.u, count(distinct b.frame) filter (abs(b.z - a.z) < 0.4) as hits from f a left join f b on b.frame between a.frame - 3 and a.frame + 3 and b.frame <> a.frame and b.u in (a.u, a.u + 1) group by 1, 2""",
)
def depth_consistency(spark, d):
    """For each pixel the neighbours among the six nearest frames with an agreeing depth at one of its corners."""
    f = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("frame"), F.col("l_quantity").cast("long").alias("u")).agg((F.max("l_extendedprice") / 1000).alias("z"))
    wide = f.select("frame", "u", "z", F.explode(F.expr("sequence(frame - 3, frame + 3)")).alias("other")).where("other <> frame").withColumn("corner", F.explode(F.array(F.col("u"), F.col("u") + 1)))
    have = f.select(F.col("frame").alias("other"), F.col("u").alias("corner"), F.col("z").alias("zz"))
    hit = wide.join(have, ["other", "corner"], "left").groupBy("frame", "u", "other").agg(F.max(F.coalesce(F.abs(F.col("zz") - F.col("z")) < 0.4, F.lit(False)).cast("int")).alias("h"))
    return hit.groupBy("frame", "u").agg(F.sum("h").alias("hits"))


@query(
    "map_point_filter",
    """with p as (select l_suppkey as kf, l_orderkey, l_linenumber, 1 / l_quantity as disp, l_returnflag = 'R' as masked from lineitem)
    select kf, l_orderkey, l_linenumber from (select *, avg(disp) over (partition by kf) as m from p) where disp > 0.5 * m and not masked""",
)
def map_point_filter(spark, d):
    p = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("kf"), "l_orderkey", "l_linenumber", (1 / F.col("l_quantity")).alias("disp"), (F.col("l_returnflag") == "R").alias("masked"))
    mean = p.groupBy("kf").agg(F.avg("disp").alias("m"))
    return p.join(mean, "kf").where("disp > 0.5 * m and not masked").select("kf", "l_orderkey", "l_linenumber")


@query(
    "depth_reliability",
    """with g as (select s_suppkey as k, v, u, 2 + sin(v * 0.9 + s_suppkey) * cos(u * 0.7) as z from supplier, (select unnest(range(24)) as v), (select unnest(range(32)) as u)),
    n as (select a.k, a.v, a.u, any_value(a.z) as z, max(b.z) as hi, min(b.z) as lo, sum(b.z) / 25 as mean from g a join g b on b.k = a.k and b.v between a.v - 2 and a.v + 2 and b.u between a.u - 2 and a.u + 2 group by 1, 2, 3)
    select k, cast(v as integer) as v, cast(u as integer) as u, (hi - lo) / (mean + 1e-6) < 0.6 and z > 0 as reliable from n""",
)
def depth_reliability(spark, d):
    """Relative range of the 5x5 neighbourhood; the mean counts pixels outside as 0."""
    from tessella.functions.camera import pixel_grid

    frames = table(spark, d, "supplier").select(F.col("s_suppkey").alias("k")).join(F.broadcast(pixel_grid(spark, 32, 24)))  # the grid is one raster
    g = frames.select("k", "v", "u", (2 + F.sin(F.col("v") * 0.9 + F.col("k")) * F.cos(F.col("u") * 0.7)).alias("z"))
    spread = g.select("k", F.explode(F.expr("sequence(v - 2, v + 2)")).alias("v"), "u", "z").select("k", "v", F.explode(F.expr("sequence(u - 2, u + 2)")).alias("u"), "z")
    n = spread.groupBy("k", "v", "u").agg(F.max("z").alias("hi"), F.min("z").alias("lo"), (F.sum("z") / 25).alias("mean"))
    return g.join(n, ["k", "v", "u"]).select("k", "v", "u", (((F.col("hi") - F.col("lo")) / (F.col("mean") + 1e-6) < 0.6) & (F.col("z") > 0)).alias("reliable"))
