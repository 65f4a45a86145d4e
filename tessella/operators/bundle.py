"""Bundle adjustment of keyframe poses and disparities.

Residuals and derivatives are columns of one row for each edge and pixel. Their
products are formed within the row and summed by edge, for the poses, and by
pixel, for the disparities, which are eliminated there (their block is
diagonal). What comes to the driver are blocks of 6x6 numbers, one for each
edge and each pair of poses that share a pixel, as Arrow columns; the solved
system has six rows for each of at most CAPACITY keyframes, whatever the
number of pixels.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions.camera import Pinhole
from tessella.functions.lie import SE3, scale
from tessella.lineage import cut

CAPACITY = 1024
#: Projections nearer than this are not used.
MIN_DEPTH = 0.25
#: Steps of a disparity above this are ignored.
LARGEST_STEP = 10.0


def _poses(spark, poses: dict[int, tuple]):
    rows = [(int(k), *map(float, v)) for k, v in sorted(poses.items())]
    return spark.createDataFrame(rows, "frame_idx long, tx double, ty double, tz double, qx double, qy double, qz double, qw double")


def residuals(pixels: DataFrame, edge_pixels: DataFrame, edges: DataFrame, poses: DataFrame, k: tuple[float, float, float, float]) -> DataFrame:
    """A row for each edge and pixel: residuals ru, rv, weights wu, wv, and their derivatives.

    pixels (frame_idx, v, u, disp), edges (edge_id, i, j), edge_pixels
    (edge_id, v, u, target_u, target_v, weight_u, weight_v), poses world to
    camera. Derivatives by the left tangents of both poses (ai0.., aj0..) and
    by the disparity (du, dv). Edges of a frame to itself are left out. A pixel
    stands at (u, v), or where pixels have them at (x, y).
    """
    cam = Pinhole(*[F.lit(float(x)) for x in k])
    side = lambda s: poses.select(F.col("frame_idx").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in poses.columns if c != "frame_idx"])
    # A graph has at most CAPACITY poses.
    rows = edge_pixels.join(F.broadcast(edges.where("i <> j")), "edge_id").join(pixels.withColumnRenamed("frame_idx", "i"), ["i", "v", "u"])
    rows = rows.join(F.broadcast(side("i")), "i").join(F.broadcast(side("j")), "j")
    relative = SE3.of("j_").mul(SE3.of("i_").inv())
    rows = rows.select(*[c for c in rows.columns if not c.startswith(("i_", "j_"))], *relative.columns("g_"))
    place = ("x", "y") if "x" in pixels.columns else ("u", "v")
    ray = cam.unproject(*[F.col(c).cast("double") for c in place])
    moved = SE3.of("g_").act(ray, F.col("disp"))
    rows = rows.withColumns({"px": moved[0], "py": moved[1], "pz": moved[2]})
    p = (F.col("px"), F.col("py"), F.col("pz"))
    good = F.col("pz") > MIN_DEPTH
    safe = (p[0], p[1], F.when(good, p[2]).otherwise(1.0))
    u, v = cam.project(safe, limit=False)
    ju, jv = cam.project_jacobian(safe)
    d, o = F.col("disp"), F.lit(0.0)
    # The derivative of a moved homogeneous point by the left tangent of the target pose.
    generators = [(d, o, o), (o, d, o), (o, o, d), (o, -p[2], p[1]), (p[2], o, -p[0]), (-p[1], p[0], o)]
    row = lambda j, g: j[0] * g[0] + j[1] * g[1] + j[2] * g[2]
    out = {"ru": u - F.col("target_u"), "rv": v - F.col("target_v"), "wu": F.when(good, F.col("weight_u")).otherwise(0.0), "wv": F.when(good, F.col("weight_v")).otherwise(0.0)}
    for n, g in enumerate(generators):
        out[f"aj{n}u"], out[f"aj{n}v"] = row(ju, g), row(jv, g)
    t = (F.col("g_tx"), F.col("g_ty"), F.col("g_tz"))
    out["du"], out["dv"] = row(ju, t), row(jv, t)
    rows = rows.withColumns(out)
    # The source pose moves by minus the adjoint: a row a of the target becomes -Ad^T a.
    g = SE3.of("g_")
    back = {}
    for c in "uv":
        tau, phi = g.adj_t(tuple(F.col(f"aj{n}{c}") for n in range(3)), tuple(F.col(f"aj{n}{c}") for n in range(3, 6)))
        for n, x in enumerate((*scale(tau, -1), *scale(phi, -1))):
            back[f"ai{n}{c}"] = x
    return rows.withColumns(back)


def energy(rows: DataFrame) -> float:
    """The weighted sum of squared residuals."""
    return rows.agg(F.sum(F.col("wu") * F.col("ru") * F.col("ru") + F.col("wv") * F.col("rv") * F.col("rv")).alias("e")).first()["e"] or 0.0


def residual_metric(total: float, elements: int) -> float:
    return float(np.sqrt(total / (elements / 2 + 1e-6)) / 16)


def step(pixels: DataFrame, rows: DataFrame, free: list[int], damping: float, eps: float, alpha: float, eta: float, motion_only: bool, limited: list[int] | None = None) -> tuple[dict[int, np.ndarray], DataFrame]:
    """One Gauss-Newton step: tangents of the free poses, and pixels with new disparities.

    alpha weighs the distance to disp_sensor where it is above 0; eta, or the
    column eta of pixels, is added to a disparity's diagonal. limited names the
    frames whose disparities may move; without it all may.
    """
    number = {f: n for n, f in enumerate(sorted(free))}
    size = 6 * len(number)
    if len(number) > CAPACITY:
        raise ValueError(f"a graph has at most {CAPACITY} free poses")
    spark = pixels.sparkSession
    big, rhs = np.zeros((size, size)), np.zeros(size)
    at = lambda n: slice(6 * n, 6 * n + 6)

    # Twelve derivatives of a row by its two poses: their products by edge, the upper half.
    both = [(f"a{s}{m}u", f"a{s}{m}v") for s in "ij" for m in range(6)]
    square = lambda x, y: F.sum(F.col("wu") * F.col(x[0]) * F.col(y[0]) + F.col("wv") * F.col(x[1]) * F.col(y[1]))
    upper = [(x, y) for x in range(12) for y in range(x, 12)]
    right = [F.sum(-(F.col("wu") * F.col(u) * F.col("ru") + F.col("wv") * F.col(v) * F.col("rv"))) for u, v in both]
    sums = rows.groupBy("edge_id", "i", "j").agg(*[square(both[x], both[y]).alias(f"h{x}_{y}") for x, y in upper], *[c.alias(f"g{x}") for x, c in enumerate(right)]).toArrow()
    ends = [[number.get(f) for f in sums[c].to_pylist()] for c in "ij"]
    blocks = np.zeros((sums.num_rows, 12, 12))
    for x, y in upper:
        blocks[:, x, y] = blocks[:, y, x] = sums[f"h{x}_{y}"].to_numpy()
    vectors = np.stack([sums[f"g{x}"].to_numpy() for x in range(12)], axis=1) if sums.num_rows else np.zeros((0, 12))
    for row, pair in enumerate(zip(*ends, strict=True)):
        for p, a in enumerate(pair):
            if a is None:
                continue
            rhs[at(a)] += vectors[row, at(p)]
            for q, b in enumerate(pair):
                if b is not None:
                    big[at(a), at(b)] += blocks[row, at(p), at(q)]
    lead = np.diag(eps + damping * np.diag(big))
    if motion_only:
        dx = _solve(big + lead, rhs)
        return {f: dx[at(n)] for f, n in number.items()}, pixels

    pixel = ["i", "v", "u"]
    if limited is not None:
        rows = rows.where(F.col("i").isin([int(x) for x in limited]))
    c = rows.groupBy(*pixel).agg(F.sum(F.col("wu") * F.col("du") * F.col("du") + F.col("wv") * F.col("dv") * F.col("dv")).alias("c"), F.sum(-(F.col("wu") * F.col("du") * F.col("ru") + F.col("wv") * F.col("dv") * F.col("rv"))).alias("w"))
    sensor = pixels.select(F.col("frame_idx").alias("i"), "v", "u", "disp", "disp_sensor", (F.col("eta") if "eta" in pixels.columns else F.lit(eta)).alias("eta"))
    prior = F.when(F.col("disp_sensor") > 0, alpha).otherwise(0.0)
    c = c.join(sensor, pixel).select(*pixel, (F.col("c") + prior + F.col("eta")).alias("c"), (F.col("w") - prior * (F.col("disp") - F.col("disp_sensor"))).alias("w"))
    ids = spark.createDataFrame([(k, n) for k, n in number.items()] or [(-1, -1)], "frame long, n int")
    mixed = lambda s: [(F.col("wu") * F.col(f"a{s}{m}u") * F.col("du") + F.col("wv") * F.col(f"a{s}{m}v") * F.col("dv")).alias(f"e{m}") for m in range(6)]
    parts = [rows.select(*pixel, F.col(s).alias("frame"), *mixed(s)) for s in "ij"]
    e = parts[0].unionByName(parts[1]).join(F.broadcast(ids), "frame").groupBy(*pixel, "n").agg(*[F.sum(f"e{m}").alias(f"e{m}") for m in range(6)]).join(c, pixel)
    f = e.select(*pixel, F.col("n").alias("k"), *[F.col(f"e{m}").alias(f"f{m}") for m in range(6)])
    shared = e.join(f, pixel).where("n <= k").groupBy("n", "k").agg(*[F.sum(F.col(f"e{x}") * F.col(f"f{y}") / F.col("c")).alias(f"s{x}_{y}") for x in range(6) for y in range(6)]).toArrow()
    for row, (n, k) in enumerate(zip(shared["n"].to_pylist(), shared["k"].to_pylist(), strict=True)):
        block = np.array([[shared[f"s{x}_{y}"][row].as_py() for y in range(6)] for x in range(6)])
        big[at(n), at(k)] -= block
        if n != k:
            big[at(k), at(n)] -= block.T
    for r in e.groupBy("n").agg(*[F.sum(F.col(f"e{m}") * F.col("w") / F.col("c")).alias(f"w{m}") for m in range(6)]).collect():  # a row for each pose
        rhs[at(r["n"])] -= [r[f"w{m}"] for m in range(6)]
    dx = _solve(big + lead, rhs)
    steps = spark.createDataFrame([(n, *map(float, dx[at(n)])) for n in number.values()] or [(-1, *[0.0] * 6)], "n int, " + ", ".join(f"x{m} double" for m in range(6)))
    dot = sum((F.col(f"e{m}") * F.col(f"x{m}") for m in range(1, 6)), F.col("e0") * F.col("x0"))
    back = e.join(F.broadcast(steps), "n").groupBy(*pixel).agg(F.sum(dot).alias("ex"))
    dz = c.join(back, pixel, "left").select(F.col("i").alias("frame_idx"), "v", "u", ((F.col("w") - F.coalesce("ex", F.lit(0.0))) / F.col("c")).alias("dz"))
    moved = pixels.join(dz, ["frame_idx", "v", "u"], "left")
    z = F.when(F.coalesce("dz", F.lit(0.0)) > LARGEST_STEP, F.lit(0.0)).otherwise(F.coalesce("dz", F.lit(0.0)))
    return {k: dx[at(n)] for k, n in number.items()}, moved.withColumn("disp", F.greatest(F.col("disp") + z, F.lit(1e-3))).select(*pixels.columns)


def _solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The solution of a positive definite system; 0 where it is not."""
    if not len(b):
        return b
    try:
        low = np.linalg.cholesky(a)
    except np.linalg.LinAlgError:
        return np.zeros_like(b)
    return np.linalg.solve(low.T, np.linalg.solve(low, b))


def retract(pose: np.ndarray, x: np.ndarray) -> np.ndarray:
    """exp(x) * pose for (t, q) and a tangent (tau, phi)."""
    tau, phi = x[:3], x[3:]
    t = np.linalg.norm(phi)
    k = np.array([[0, -phi[2], phi[1]], [phi[2], 0, -phi[0]], [-phi[1], phi[0], 0]])
    a, b = (0.5, 1 / 6) if t < 1e-6 else ((1 - np.cos(t)) / t**2, (t - np.sin(t)) / t**3)
    q = np.array([*(phi * (0.5 if t < 1e-6 else np.sin(t / 2) / t)), np.cos(t / 2)])
    move = (np.eye(3) + a * k + b * k @ k) @ tau
    qv, p = q[:3], np.asarray(pose, float)
    turned = p[:3] + 2 * np.cross(qv, np.cross(qv, p[:3]) + q[3] * p[:3])
    x2, y2 = p[3:6], p[6]
    new = np.array([*(q[3] * x2 + y2 * qv + np.cross(qv, x2)), q[3] * y2 - qv @ x2])
    return np.array([*(move + turned), *(new / np.linalg.norm(new))])


def adjust(pixels: DataFrame, edges: DataFrame, edge_pixels: DataFrame, poses: dict[int, tuple], k: tuple, free: list[int], iterations: int = 2, damping: float = 1e-4, eps: float = 0.1, alpha: float = 0.001, eta: float = 0.1, motion_only: bool = False, keep=None, limited: list[int] | None = None, kernel=None) -> tuple[dict[int, np.ndarray], DataFrame, list[float]]:
    """Gauss-Newton steps over a graph: new poses, pixels, and the energy before each step.

    keep(df) cuts the lineage of the pixels after a step; without it they are written to the checkpoint folder.
    kernel weighs residuals once more by their size, after the turn's number where it takes one.
    """
    now = {f: np.asarray(p, float) for f, p in poses.items()}
    energies = []
    for _ in range(iterations):
        # Several sums read the residuals; they are kept beside memory on disk until the step is done.
        rows = residuals(pixels, edge_pixels, edges, _poses(pixels.sparkSession, now), k)
        if kernel is not None:
            rows = rows.withColumns({f"w{c}": F.col(f"w{c}") * kernel(F.col(f"r{c}")) for c in "uv"})
        rows = rows.persist()
        energies.append(energy(rows))
        steps, moved = step(pixels, rows, free, damping, eps, alpha, eta, motion_only, limited)
        pixels = pixels if moved is pixels else (keep or cut)(moved)
        rows.unpersist()
        for f, x in steps.items():
            now[f] = retract(now[f], x)
    return now, pixels, energies
