"""Operators whose answers need linear algebra or an order: sums in Spark, small systems in numpy."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.catalogue import query
from tessella.functions.camera import pixel_grid
from tessella.operators import align, bundle, windows
from tessella.plans.tables import near, table


def _pairs(spark, d):
    e = table(spark, d, "embeddings")
    c = [F.col("embedding")[i].cast("double") for i in range(3)]
    # A known similarity with a little noise from other elements.
    noise = [F.col("embedding")[i + 10].cast("double") * 1e-3 for i in range(3)]
    target = [2.0 * c[1] + 0.5 + noise[0], -2.0 * c[0] - 1.0 + noise[1], 2.0 * c[2] + 0.25 + noise[2]]
    return e.select("label", "vec_id", *[x.alias(f"s{a}") for x, a in zip(c, "xyz", strict=True)], *[x.alias(f"t{a}") for x, a in zip(target, "xyz", strict=True)])


def _eigenvector(source: str, rounds: int = 45) -> str:
    """SQL of the largest eigenvector (v0 .. v3) of a positive 4x4 matrix m00 .. m33 for each label of a source, by squaring it."""
    entry = lambda i, j: f"m{min(i, j)}{max(i, j)}"
    upper = [(i, j) for i in range(4) for j in range(i, 4)]
    names = ", ".join(entry(i, j) for i, j in upper)
    trace = " + ".join(f"m{i}{i}" for i in range(4))
    squares = ", ".join(f"({' + '.join(f'{entry(i, k)} * {entry(k, j)}' for k in range(4))}) / pow({trace}, 2)" for i, j in upper)
    # The column of the largest diagonal entry is the eigenvector up to its length.
    most = f"greatest({', '.join(f'm{i}{i}' for i in range(4))})"
    column = lambda i: "case " + " ".join(f"when m{k}{k} = {most} then {entry(i, k)}" for k in range(4)) + " end"
    return f"""with recursive p as (select label, 0 as n, {names} from ({source}) union all select label, n + 1, {squares} from p where n < {rounds}),
        c as (select label, {", ".join(f"{column(i)} as c{i}" for i in range(4))} from p where n = {rounds})
        select label, {", ".join(f"c{i} / sqrt(c0 * c0 + c1 * c1 + c2 * c2 + c3 * c3) as v{i}" for i in range(4))} from c"""


_PAIRS = """select label, vec_id, embedding[1]::double as x, embedding[2]::double as y, embedding[3]::double as z, 2 * embedding[2]::double + 0.5 + embedding[11]::double * 1e-3 as a,
    -2 * embedding[1]::double - 1 + embedding[12]::double * 1e-3 as b, 2 * embedding[3]::double + 0.25 + embedding[13]::double * 1e-3 as c from embeddings"""


def _horn_sql() -> str:
    """The similarity by Horn's quaternion, an independent way to the singular vectors of the covariance."""
    cov = ", ".join(f"avg({s} * {t}) - avg({s}) * avg({t}) as s{s}{t}" for s in "xyz" for t in "abc")
    moments = f"select label, avg(x) as mx, avg(y) as my, avg(z) as mz, avg(a) as ma, avg(b) as mb, avg(c) as mc, avg(x * x + y * y + z * z) - avg(x) * avg(x) - avg(y) * avg(y) - avg(z) * avg(z) as var, {cov} from ({_PAIRS}) group by 1"
    # Order w, x, y, z; a multiple of the identity makes all eigenvalues positive.
    lift = "+ 2 * sqrt(" + " + ".join(f"s{s}{t} * s{s}{t}" for s in "xyz" for t in "abc") + ")"
    matrix = f"""select label, sxa + syb + szc {lift} as m00, syc - szb as m01, sza - sxc as m02, sxb - sya as m03, sxa - syb - szc {lift} as m11, sxb + sya as m12, sza + sxc as m13,
        syb - sxa - szc {lift} as m22, syc + szb as m23, szc - sxa - syb {lift} as m33 from ({moments})"""
    r = ["1 - 2 * (v2 * v2 + v3 * v3)", "2 * (v1 * v2 - v0 * v3)", "2 * (v1 * v3 + v0 * v2)", "2 * (v1 * v2 + v0 * v3)", "1 - 2 * (v1 * v1 + v3 * v3)", "2 * (v2 * v3 - v0 * v1)", "2 * (v1 * v3 - v0 * v2)", "2 * (v2 * v3 + v0 * v1)", "1 - 2 * (v1 * v1 + v2 * v2)"]
    turned = ", ".join(f"{x} as r{k // 3}{k % 3}" for k, x in enumerate(r))
    along = " + ".join(f"r{i}{j} * s{s}{t}" for i, t in enumerate("abc") for j, s in enumerate("xyz"))
    shown = ", ".join(f"round(r{i}{j}, 5) + 0.0 as r{i}{j}" for i in range(3) for j in range(3))
    moved = ", ".join(f"round(m{t} - scale * (r{i}0 * mx + r{i}1 * my + r{i}2 * mz), 5) + 0.0 as t{'xyz'[i]}" for i, t in enumerate("abc"))
    return f"select label, round(scale, 5) + 0.0 as scale, {shown}, {moved} from (select *, ({along}) / var as scale from (select m.*, {turned} from ({moments}) m join ({_eigenvector(matrix)}) using (label)))"


@query("umeyama", _horn_sql())
def umeyama(spark, d):
    out = align.similarity(_pairs(spark, d), ["label"], ["sx", "sy", "sz"], ["tx", "ty", "tz"])
    return out.select("label", *[near(F.col(c), 5).alias(c) for c in out.columns[1:]])


_UNIT = ", ".join(f"embedding[{i + 1}]::double / sqrt({' + '.join(f'pow(embedding[{k}]::double, 2)' for k in range(1, 5))}) as q{i}" for i in range(4))


@query(
    "rot_average",
    f"""select label, {", ".join(f"round(case when v3 >= 0 then v{i} else -v{i} end, 5) + 0.0 as q{a}" for i, a in enumerate("xyzw"))}
    from ({_eigenvector(f"select label, {', '.join(f'avg(q{i} * q{j}) as m{i}{j}' for i in range(4) for j in range(i, 4))} from (select label, {_UNIT} from embeddings) group by 1")})""",
)
def rot_average(spark, d):
    c = [F.col("embedding")[i].cast("double") for i in range(4)]
    n = F.sqrt(sum((x * x for x in c[1:]), c[0] * c[0]))
    rows = table(spark, d, "embeddings").select("label", *[(x / n).alias(f"q{a}") for x, a in zip(c, "xyzw", strict=True)])
    out = align.rotation_average(rows, ["label"], ["qx", "qy", "qz", "qw"])
    return out.select("label", *[near(F.col(c), 5).alias(c) for c in out.columns[1:]])


@query("ransac_sim3")
def ransac_sim3(spark, d):
    """Models come from a bounded draw of each group, inliers from all of its rows."""
    out = align.ransac_similarity(_pairs(spark, d), ["label"], "vec_id", ["sx", "sy", "sz"], ["tx", "ty", "tz"])
    return out.select("label", *[near(F.col(c), 4).alias(c) for c in ("scale", "tx", "ty", "tz")])


@query(
    "keyframe_select",
    """with recursive r as (select user_id, event_id, value, row_number() over (partition by user_id order by event_id) as n from events),
    f as (select user_id, event_id, n, value as base, true as keep from r where n = 1
          union all select r.user_id, r.event_id, r.n, case when abs(r.value - f.base) > 50 then r.value else f.base end, abs(r.value - f.base) > 50 from f join r on r.user_id = f.user_id and r.n = f.n + 1)
    select user_id, event_id from f where keep""",
)
def keyframe_select(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_id", "value")
    return windows.keyframes(rows, "user_id", ["event_id"], "value", 50.0).select("user_id", "event_id")


@query(
    "greedy_nms",
    """with recursive e as (select l_suppkey, cast(floor(l_orderkey / 50) as bigint) as i, l_partkey % 300 as j, l_tax * 100 + l_discount as dist from lineitem),
    r as (select *, row_number() over (partition by l_suppkey order by dist, i, j) as n from e where dist <= 6),
    f as (select l_suppkey, n, i, j, dist, true as keep, [{'a': i, 'b': j}] as chosen from r where n = 1
          union all select l_suppkey, n, i, j, dist, ok, case when ok then list_append(chosen, {'a': i, 'b': j}) else chosen end
          from (select r.*, f.chosen, len(f.chosen) < 48 and len(list_filter(f.chosen, lambda c: abs(c.a - r.i) <= 2 and abs(c.b - r.j) <= 2)) = 0 as ok from f join r on r.l_suppkey = f.l_suppkey and r.n = f.n + 1))
    select l_suppkey, i, j, dist from f where keep""",
)
def greedy_nms(spark, d):
    e = table(spark, d, "lineitem").select("l_suppkey", F.floor(F.col("l_orderkey") / 50).alias("i"), (F.col("l_partkey") % 300).alias("j"), (F.col("l_tax") * 100 + F.col("l_discount")).alias("dist"))
    return windows.suppressed(e, "l_suppkey", "dist", "i", "j", 2, 48, 6.0)


def closed_graph(spark):
    """Five frames of a 4x5 grid in closed form: pixels, edges, targets, poses, intrinsics."""
    import numpy as np

    grid = pixel_grid(spark, 5, 4).select("v", "u")
    frames = spark.range(5).select(F.col("id").alias("frame_idx"))
    d = 0.72 + 0.015 * F.col("u") + 0.02 * F.col("v") + 0.025 * F.col("frame_idx")
    sensor = F.when(F.col("frame_idx") == 2, 1.015 * d).when(F.col("frame_idx") == 4, 0.985 * d).otherwise(0.0)
    pixels = frames.join(F.broadcast(grid)).select("frame_idx", "v", "u", d.alias("disp"), sensor.alias("disp_sensor"))
    tx, ty, tz = np.linspace(0, 0.08, 5), [0, 0.01, -0.005, 0.015, 0.02], np.linspace(0, 0.025, 5)
    poses = {i: (tx[i], ty[i], tz[i], 0, 0, 0, 1) for i in range(5)}
    pairs = [(1, 0), (2, 0), (3, 1), (4, 2), (0, 2), (3, 3)]
    edges = spark.createDataFrame([(n, i, j) for n, (i, j) in enumerate(pairs)], "edge_id int, i long, j long")
    k = (38 / 8, 38 / 8, 19.5 / 8, 15.5 / 8)
    blank = edges.join(F.broadcast(grid)).select("edge_id", "v", "u", F.lit(0.0).alias("target_u"), F.lit(0.0).alias("target_v"), F.lit(1.0).alias("weight_u"), F.lit(1.0).alias("weight_v"))
    at = bundle.residuals(pixels, blank, edges, bundle._poses(spark, poses), k)
    off = -0.015 + 0.035 * F.col("edge_id") / 5
    x, y = F.col("u"), F.col("v")
    w = 0.2 + 0.03 * (x + y)
    target = at.select("edge_id", "v", "u", (F.col("ru") + 0.01 * F.sin(0.7 * x + 0.2 * y) + off).alias("target_u"), (F.col("rv") - 0.012 * F.cos(0.3 * x - 0.5 * y) - 0.5 * off).alias("target_v"), w.alias("weight_u"), w.alias("weight_v"))
    return pixels, edges, target, poses, k


@query("ba_step")
def ba_step(spark, d):
    pixels, edges, target, poses, k = closed_graph(spark)
    moved, after, _ = bundle.adjust(pixels, edges, target, poses, k, [1, 2, 3, 4], iterations=1, damping=1e-3)
    return after.select("frame_idx", "v", "u", near(F.col("disp"), 6).alias("disp"))
