"""Cameras, rigid transforms and weights; elements of the embeddings serve as coordinates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.catalogue import query
from tessella.functions import camera, lie, robust
from tessella.plans.tables import near, table

# Coordinates of one row: quaternions a and b, translations s and t, a point p.
_E = ", ".join(f"embedding[{i + 1}]::double as e{i}" for i in range(20))
_BASE = f"select vec_id, {_E} from embeddings"
_UNIT = "select *, sqrt(e0*e0 + e1*e1 + e2*e2 + e3*e3) as na, sqrt(e4*e4 + e5*e5 + e6*e6 + e7*e7) as nb from (" + _BASE + ")"
_Q = f"select *, e0/na as ax, e1/na as ay, e2/na as az, e3/na as aw, e4/nb as bx, e5/nb as by_, e6/nb as bz, e7/nb as bw from ({_UNIT})"


def _rows(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(20)])
    c = [F.col(f"e{i}") for i in range(20)]
    na, nb = lie.norm(c[0:4]), lie.norm(c[4:8])
    return e.withColumns({**{f"a_q{x}": c[i] / na for i, x in enumerate("xyzw")}, **{f"b_q{x}": c[4 + i] / nb for i, x in enumerate("xyzw")}, **{f"a_t{x}": c[8 + i] for i, x in enumerate("xyz")}, **{f"b_t{x}": c[11 + i] for i, x in enumerate("xyz")}})


def _point():
    return lie.vec("e14", "e15", "e16")


_MAT = """1 - 2*(y*y + z*z) as m00, 2*(x*y - z*w) as m01, 2*(x*z + y*w) as m02, 2*(x*y + z*w) as m10, 1 - 2*(x*x + z*z) as m11, 2*(y*z - x*w) as m12, 2*(x*z - y*w) as m20, 2*(y*z + x*w) as m21, 1 - 2*(x*x + y*y) as m22"""
_A = f"select vec_id, ax as x, ay as y, az as z, aw as w from ({_Q})"
_NAMES = [f"m{i}{j}" for i in range(3) for j in range(3)]


@query("quat_matrix", "select vec_id, " + ", ".join(f"round({n}, 6) + 0.0 as {n}" for n in _NAMES) + f" from (select vec_id, {_MAT} from ({_A}))")
def quat_matrix(spark, d):
    m = lie.SE3.of("a_").matrix()
    return _rows(spark, d).select("vec_id", *[near(m[i][j]).alias(f"m{i}{j}") for i in range(3) for j in range(3)])


@query("matrix_quat_round_trip", f"select vec_id, round(x * sign(w), 5) + 0.0 as x, round(y * sign(w), 5) + 0.0 as y, round(z * sign(w), 5) + 0.0 as z, round(abs(w), 5) + 0.0 as w from ({_A}) where abs(w) > 1e-4")
def matrix_quat_round_trip(spark, d):
    r = _rows(spark, d).where("abs(a_qw) > 1e-4")
    m = lie.q_matrix(lie.SE3.of("a_").q)
    r = r.select("vec_id", *[m[i][j].alias(f"m{i}{j}") for i in range(3) for j in range(3)])
    q = lie.q_unit(lie.q_of_matrix([[F.col(f"m{i}{j}") for j in range(3)] for i in range(3)]))
    return r.select("vec_id", *[near(c, 5).alias(n) for c, n in zip(q, "xyzw", strict=True)])


_TURN = "ax as x, ay as y, az as z, aw as w"


def _act_sql(px: str, py: str, pz: str, source: str, extra: str = "") -> str:
    """Rotate (px, py, pz) by (x, y, z, w) through the matrix."""
    return f"""select vec_id{extra}, m00*({px}) + m01*({py}) + m02*({pz}) as rx, m10*({px}) + m11*({py}) + m12*({pz}) as ry, m20*({px}) + m21*({py}) + m22*({pz}) as rz from (select *, {_MAT} from ({source}))"""


@query(
    "se3_act",
    f"select vec_id, round(rx + e8, 5) + 0.0 as x, round(ry + e9, 5) + 0.0 as y, round(rz + e10, 5) + 0.0 as z from ({_act_sql('e14', 'e15', 'e16', f'select *, {_TURN} from ({_Q})', ', e8, e9, e10')})",
)
def se3_act(spark, d):
    p = lie.SE3.of("a_").act(_point())
    return _rows(spark, d).select("vec_id", *[near(c, 5).alias(n) for c, n in zip(p, "xyz", strict=True)])


@query(
    "se3_compose",
    f"""with r as ({_act_sql('e11', 'e12', 'e13', f'select *, {_TURN} from ({_Q})', ', e8, e9, e10, ax, ay, az, aw, bx, by_, bz, bw')})
    select vec_id, round(rx + e8, 5) + 0.0 as tx, round(ry + e9, 5) + 0.0 as ty, round(rz + e10, 5) + 0.0 as tz,
      round(aw*bx + ax*bw + ay*bz - az*by_, 5) + 0.0 as qx, round(aw*by_ - ax*bz + ay*bw + az*bx, 5) + 0.0 as qy, round(aw*bz + ax*by_ - ay*bx + az*bw, 5) + 0.0 as qz, round(aw*bw - ax*bx - ay*by_ - az*bz, 5) + 0.0 as qw from r""",
)
def se3_compose(spark, d):
    g = lie.SE3.of("a_").mul(lie.SE3.of("b_"))
    r = _rows(spark, d).select("vec_id", *g.columns())
    return r.select("vec_id", *[near(F.col(c), 5).alias(c) for c in r.columns[1:]])


@query("se3_inverse_identity", "select vec_id, 0.0::double as tx, 0.0::double as ty, 0.0::double as tz, 0.0::double as qx, 0.0::double as qy, 0.0::double as qz, 1.0::double as qw from embeddings")
def se3_inverse_identity(spark, d):
    """A transform composed with its inverse."""
    a = lie.SE3.of("a_")
    r = _rows(spark, d).select("vec_id", *a.mul(a.inv()).columns())
    return r.select("vec_id", *[near(F.col(c), 6).alias(c) for c in r.columns[1:]])


@query(
    "so3_exp",
    f"""with p as (select vec_id, e0 as x, e1 as y, e2 as z, sqrt(e0*e0 + e1*e1 + e2*e2) as t from ({_BASE}))
    select vec_id, round(x * sin(t/2) / t, 6) + 0.0 as qx, round(y * sin(t/2) / t, 6) + 0.0 as qy, round(z * sin(t/2) / t, 6) + 0.0 as qz, round(cos(t/2), 6) + 0.0 as qw from p where t > 1e-6""",
)
def so3_exp(spark, d):
    phi = lie.vec("e0", "e1", "e2")
    q = lie.so3_exp(phi)
    return _rows(spark, d).where(lie.norm(phi) > 1e-6).select("vec_id", *[near(c).alias(f"q{n}") for c, n in zip(q, "xyzw", strict=True)])


@query("se3_exp_log_identity", f"select vec_id, round(e8, 5) + 0.0 as u0, round(e9, 5) + 0.0 as u1, round(e10, 5) + 0.0 as u2, round(e0, 5) + 0.0 as w0, round(e1, 5) + 0.0 as w1, round(e2, 5) + 0.0 as w2 from ({_BASE}) where e0*e0 + e1*e1 + e2*e2 < 9")
def se3_exp_log_identity(spark, d):
    """log(exp(x)) for rotations below pi."""
    r = _rows(spark, d).where("e0*e0 + e1*e1 + e2*e2 < 9")
    r = r.select("vec_id", *lie.SE3.exp(lie.vec("e8", "e9", "e10"), lie.vec("e0", "e1", "e2")).columns())
    tau, phi = lie.SE3.of().log()
    return r.select("vec_id", *[near(c, 5).alias(f"u{i}") for i, c in enumerate(tau)], *[near(c, 5).alias(f"w{i}") for i, c in enumerate(phi)])


@query("sim3_exp_log_identity", f"select vec_id, round(e8, 5) + 0.0 as u0, round(e9, 5) + 0.0 as u1, round(e10, 5) + 0.0 as u2, round(e0, 5) + 0.0 as w0, round(e1, 5) + 0.0 as w1, round(e2, 5) + 0.0 as w2, round(e3, 5) + 0.0 as sigma from ({_BASE}) where e0*e0 + e1*e1 + e2*e2 < 9")
def sim3_exp_log_identity(spark, d):
    r = _rows(spark, d).where("e0*e0 + e1*e1 + e2*e2 < 9")
    g = lie.Sim3.exp(lie.vec("e8", "e9", "e10"), lie.vec("e0", "e1", "e2"), F.col("e3"))
    r = r.select("vec_id", *[c.alias(f"t{i}") for i, c in enumerate(g.t)], *[c.alias(f"q{i}") for i, c in enumerate(g.q)], g.s.alias("s"))
    q = tuple(F.col(f"q{i}") for i in range(4))
    r = r.withColumns({f"phi{i}": c for i, c in enumerate(lie.so3_log(q))})
    tau, phi, sigma = lie.Sim3(lie.vec("t0", "t1", "t2"), q, F.col("s")).log(lie.vec("phi0", "phi1", "phi2"))
    return r.select("vec_id", *[near(c, 5).alias(f"u{i}") for i, c in enumerate(tau)], *[near(c, 5).alias(f"w{i}") for i, c in enumerate(phi)], near(sigma, 5).alias("sigma"))


@query(
    "sim3_act",
    f"select vec_id, round(1.7 * rx + e8, 5) + 0.0 as x, round(1.7 * ry + e9, 5) + 0.0 as y, round(1.7 * rz + e10, 5) + 0.0 as z from ({_act_sql('e14', 'e15', 'e16', f'select *, {_TURN} from ({_Q})', ', e8, e9, e10')})",
)
def sim3_act(spark, d):
    a = lie.SE3.of("a_")
    p = lie.Sim3(a.t, a.q, F.lit(1.7)).act(_point())
    return _rows(spark, d).select("vec_id", *[near(c, 5).alias(n) for c, n in zip(p, "xyz", strict=True)])


@query(
    "se3_adjoint",
    f"""with p as ({_act_sql('e11', 'e12', 'e13', f'select *, {_TURN} from ({_Q})', ', ax as x, ay as y, az as z, aw as w, e8, e9, e10, e14, e15, e16')}),
    t as ({_act_sql('e14', 'e15', 'e16', 'select vec_id, x, y, z, w, e8, e9, e10, e14, e15, e16, rx as fx, ry as fy, rz as fz from p', ', fx, fy, fz, e8, e9, e10')})
    select vec_id, round(rx + e9*fz - e10*fy, 5) + 0.0 as u0, round(ry + e10*fx - e8*fz, 5) + 0.0 as u1, round(rz + e8*fy - e9*fx, 5) + 0.0 as u2, round(fx, 5) + 0.0 as w0, round(fy, 5) + 0.0 as w1, round(fz, 5) + 0.0 as w2 from t""",
)
def se3_adjoint(spark, d):
    tau, phi = lie.SE3.of("a_").adj(_point(), lie.vec("e11", "e12", "e13"))
    return _rows(spark, d).select("vec_id", *[near(c, 5).alias(f"u{i}") for i, c in enumerate(tau)], *[near(c, 5).alias(f"w{i}") for i, c in enumerate(phi)])


_P = f"select vec_id, e14 as x, e15 as y, e16 * 2 + 1 as z from ({_BASE})"


def _p():
    return F.col("e14"), F.col("e15"), F.col("e16") * 2 + 1


_PIN = "case when z < 0.1 then 1 else z end"


@query("pinhole_project", f"select vec_id, round(38 * x / zz + 19.5, 5) + 0.0 as u, round(38 * y / zz + 15.5, 5) + 0.0 as v from (select *, {_PIN} as zz from ({_P}))")
def pinhole_project(spark, d):
    cam = camera.Pinhole(*map(F.lit, (38.0, 38.0, 19.5, 15.5)))
    u, v = cam.project(_p())
    return _rows(spark, d).select("vec_id", near(u, 5).alias("u"), near(v, 5).alias("v"))


@query("mei_project", f"select vec_id, round(38 * x / (zz + 0.3 * r) + 19.5, 5) + 0.0 as u, round(38 * y / (zz + 0.3 * r) + 15.5, 5) + 0.0 as v from (select *, sqrt(x*x + y*y + zz*zz) as r from (select *, {_PIN} as zz from ({_P})))")
def mei_project(spark, d):
    cam = camera.Mei(*map(F.lit, (38.0, 38.0, 19.5, 15.5, 0.3)))
    u, v = cam.project(_p())
    return _rows(spark, d).select("vec_id", near(u, 5).alias("u"), near(v, 5).alias("v"))


@query("mei_unproject_round_trip", f"select vec_id, round(10 + 5 * e0, 4) + 0.0 as u, round(12 + 5 * e1, 4) + 0.0 as v from ({_BASE})")
def mei_unproject_round_trip(spark, d):
    cam = camera.Mei(*map(F.lit, (38.0, 38.0, 19.5, 15.5, 0.3)))
    ray = cam.unproject(10 + 5 * F.col("e0"), 12 + 5 * F.col("e1"))
    u, v = cam.project(ray)
    return _rows(spark, d).select("vec_id", near(u, 4).alias("u"), near(v, 4).alias("v"))


@query("pano_uv", f"select vec_id, round(atan2(x, z) / (2 * pi()) + 0.5, 6) + 0.0 as u, round(acos(-y / sqrt(x*x + y*y + z*z)) / pi(), 6) + 0.0 as v from ({_P})")
def pano_uv(spark, d):
    u, v = camera.panorama_uv(_p())
    return _rows(spark, d).select("vec_id", near(u).alias("u"), near(v).alias("v"))


@query(
    "pinhole_uv_visible",
    f"""select vec_id, case when ok then round(u, 6) + 0.0 else 0.0 end as u, case when ok then round(v, 6) + 0.0 else 0.0 end as v, ok as seen from (select *, z > 0 and u >= 0 and u <= 1 and v >= 0 and v <= 1 as ok from
    (select *, (38 * x / case when z > 0 then z else 1 end + 19.5) / 40 as u, (38 * y / case when z > 0 then z else 1 end + 15.5) / 32 as v from ({_P})))""",
)
def pinhole_uv_visible(spark, d):
    u, v, seen = camera.pinhole_uv(_p(), camera.Pinhole(*map(F.lit, (38.0, 38.0, 19.5, 15.5))), F.lit(40.0), F.lit(32.0))
    return _rows(spark, d).select("vec_id", near(u).alias("u"), near(v).alias("v"), seen.alias("seen"))


def _cameras(spark, d, width, height):
    """Pixels of a raster for each supplier, whose key sets its camera."""
    frames = table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"))
    return frames.join(F.broadcast(camera.pixel_grid(spark, width, height)))  # the grid is one raster


def _pixels_sql(width, height):
    return f"(select s_suppkey as k, cast(v as integer) as v, cast(u as integer) as u from supplier, (select unnest(range({height})) as v), (select unnest(range({width})) as u))"


@query("camera_rays", f"select k, v, u, round((u - 19.5) / f / n, 6) + 0.0 as x, round((v - 15.5) / f / n, 6) + 0.0 as y, round(1 / n, 6) + 0.0 as z from (select *, sqrt(pow((u - 19.5) / f, 2) + pow((v - 15.5) / f, 2) + 1) as n from (select *, 38.0::double + k % 7 as f from {_pixels_sql(40, 32)}))")
def camera_rays(spark, d):
    f = 38.0 + F.col("k") % 7
    p = camera.rays(F.col("u"), F.col("v"), camera.Pinhole(f, f, F.lit(19.5), F.lit(15.5)), unit=True)
    return _cameras(spark, d, 40, 32).select("k", "v", "u", *[near(c).alias(n) for c, n in zip(p, "xyz", strict=True)])


@query("panorama_rays", f"select k, v, u, round(sin(v / 15.0 * pi()) * sin((u / 31.0 - 0.5) * 2 * pi()), 6) + 0.0 as x, round(-cos(v / 15.0 * pi()), 6) + 0.0 as y, round(sin(v / 15.0 * pi()) * cos((u / 31.0 - 0.5) * 2 * pi()), 6) + 0.0 as z from {_pixels_sql(32, 16)}")
def panorama_rays(spark, d):
    p = camera.panorama_rays(F.col("u"), F.col("v"), 32, 16)
    return _cameras(spark, d, 32, 16).select("k", "v", "u", *[near(c).alias(n) for c, n in zip(p, "xyz", strict=True)])


@query("depth_to_points", f"select k, v, u, round((u - 19.5) / f * z, 6) + 0.0 as x, round((v - 15.5) / f * z, 6) + 0.0 as y, z from (select *, 1.0::double + u * 0.1 + v * 0.01 + k as z, 38.0::double + k % 7 as f from {_pixels_sql(40, 32)} where u % 8 = 3 and v % 8 = 3)")
def depth_to_points(spark, d):
    """Points of depth maps on the strided grid: pixels 3, 11, 19 and so on."""
    f = 38.0 + F.col("k") % 7
    cam = camera.Pinhole(f, f, F.lit(19.5), F.lit(15.5))
    g = _cameras(spark, d, 40, 32).where("pmod(u, 8) = 3 and pmod(v, 8) = 3").withColumn("z", 1.0 + F.col("u") * 0.1 + F.col("v") * 0.01 + F.col("k"))
    ray = cam.unproject(F.col("u"), F.col("v"))
    return g.select("k", "v", "u", near(ray[0] * F.col("z")).alias("x"), near(ray[1] * F.col("z")).alias("y"), "z")


@query(
    "distort_points",
    f"""select vec_id, round(x * (1 + 0.1 * r2), 6) + 0.0 as radial, round(x * (1 - 0.1 * r2), 6) + 0.0 as radial_undo, round(case when r2 = 0 then x else x * (1 - sqrt(greatest(0, 1 - 4 * 0.1 * r2))) / (2 * 0.1 * r2) end, 6) + 0.0 as divisional,
    round(x / (1 + 0.1 * r2), 6) + 0.0 as divisional_undo, round(x / (1 + 0.1 * sqrt(1 + r2)), 6) + 0.0 as mei from (select vec_id, e0 as x, e0*e0 + e1*e1 as r2 from ({_BASE}))""",
)
def distort_points(spark, d):
    x, y, k = F.col("e0"), F.col("e1"), F.lit(0.1)
    forms = {"radial": camera.radial, "radial_undo": camera.radial_undo, "divisional": camera.divisional, "divisional_undo": camera.divisional_undo, "mei": camera.mei_distort}
    return _rows(spark, d).select("vec_id", *[near(f(x, y, k)[0]).alias(n) for n, f in forms.items()])


@query(
    "gravity_fields",
    f"""with g as (select vec_id, e0 * 0.4 as r, e1 * 0.3 as p, e2 as x, e3 as y from ({_BASE})), v as (select *, -sin(r) * cos(p) as gx, -cos(r) * cos(p) as gy, sin(p) as gz from g)
    select vec_id, round(r, 5) + 0.0 as roll, round(p, 5) + 0.0 as pitch, round((gx - gz * x) / sqrt(pow(gx - gz * x, 2) + pow(gy - gz * y, 2)), 5) + 0.0 as up_x,
    round(asin(least(greatest((x * gx + y * gy + gz) / sqrt(x*x + y*y + 1), -1 + 1e-6), 1 - 1e-6)), 5) + 0.0 as latitude from v""",
)
def gravity_fields(spark, d):
    g = camera.gravity(F.col("e0") * 0.4, F.col("e1") * 0.3)
    r = _rows(spark, d).select("vec_id", "e2", "e3", *[c.alias(f"g{i}") for i, c in enumerate(g)])
    g = lie.vec("g0", "g1", "g2")
    roll, pitch = camera.roll_pitch(g)
    up, _ = camera.up_field(F.col("e2"), F.col("e3"), g)
    return r.select("vec_id", near(roll, 5).alias("roll"), near(pitch, 5).alias("pitch"), near(up, 5).alias("up_x"), near(camera.latitude(F.col("e2"), F.col("e3"), g), 5).alias("latitude"))


@query(
    "size_rules",
    """with s as (select p_partkey, 200.0::double + p_size * 37 as w, 300.0::double + p_retailprice as h from part), k as (select *, sqrt(384 * 512 / (w * h)) as k from s)
    select p_partkey, cast(floor(w * k) - floor(w * k) % 8 as bigint) as crop_width, cast(floor(h * k) - floor(h * k) % 8 as bigint) as crop_height, round(h / (2 * tan(radians(55.0) / 2)), 4) + 0.0 as focal, round(degrees(2 * atan(w / (2 * h))), 5) + 0.0 as fov from k""",
)
def size_rules(spark, d):
    w, h = 200.0 + F.col("p_size") * 37, 300.0 + F.col("p_retailprice")
    s = camera.standard_size(w, h)
    fov = camera.intrinsics_of_fov(F.radians(F.lit(55.0)), w, h)
    return table(spark, d, "part").select("p_partkey", s["crop_width"].cast("long").alias("crop_width"), s["crop_height"].cast("long").alias("crop_height"), near(fov.fx, 4).alias("focal"), near(camera.fov_degrees(h, w), 5).alias("fov"))


_R = "(value - 40) / 15"


def _weights(name: str, sql: str, f):
    @query(f"robust_weights_{name}", f"select event_id, round({sql}, 6) + 0.0 as weight from (select event_id, {_R} as r from events)")
    def run(spark, d):
        return table(spark, d, "events").select("event_id", ((F.col("value") - 40) / 15).alias("r")).select("event_id", near(f(F.col("r"))).alias("weight"))

    return run


_weights("huber", "case when abs(r) <= 1 then 1 else 1 / greatest(abs(r), 1e-8) end", robust.kernel("huber", 1.0))
_weights("tukey", "pow(greatest(1 - (r / 2) * (r / 2), 0), 2)", robust.kernel("tukey", 2.0))
_weights("gnc", "case when r * r < 4.5 then 1 when r * r <= 18 then greatest(sqrt(9 * 2 / greatest(r * r, 1e-12)) - 1, 0) else 0 end", robust.kernel("gnc-tls", 3.0, mu=1.0))
_weights("gnc_hard", "(r * r < 9)::int", robust.kernel("gnc_tls", 3.0))


@query("huber_loss", f"select event_id, round(case when r > 1 then 2 * sqrt(r) - 1 else r end, 6) + 0.0 as loss, round(case when r > 1 then 1 / sqrt(r) else 1 end, 6) + 0.0 as slope from (select event_id, value * value / 900 as r from events)")
def huber_loss(spark, d):
    loss, slope, _ = robust.huber_loss(F.col("value") * F.col("value") / 900)
    return table(spark, d, "events").select("event_id", near(loss).alias("loss"), near(slope).alias("slope"))


@query("retractions", "select event_id, greatest(case when value > 10 then 0.5 else 0.5 + value end, 1e-3) as disparity, least(greatest(0.5 + value, 1e-3), 10) as track, 0.1 + 0.01 * value as distortion from events")
def retractions(spark, d):
    v, half = F.col("value"), F.lit(0.5)
    return table(spark, d, "events").select("event_id", robust.moved_disparity(half, v).alias("disparity"), robust.moved_track_disparity(half, v).alias("track"), robust.moved_intrinsics(F.lit(100.0), F.lit(0.1), F.lit(0.0), v)[1].alias("distortion"))
