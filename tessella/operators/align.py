"""Scale and shift fits, normalisation and depth metrics, per group of rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.operators.quantiles import quantiles


def _fit(x: Column, y: Column, ok: Column) -> dict[str, Column]:
    k = lambda c: F.sum(F.when(ok, c))
    return {"n": k(F.lit(1.0)), "x": k(x), "y": k(y), "xx": k(x * x), "xy": k(x * y)}


def affine(rows: DataFrame, keys: list[str], x: Column, y: Column, ok: Column | None = None) -> DataFrame:
    """Least squares scale and bias of y on x over the rows that are ok; a singular fit is (1, 0)."""
    s = rows.groupBy(*keys).agg(*[c.alias(n) for n, c in _fit(x, y, F.lit(True) if ok is None else ok).items()])
    det = F.col("n") * F.col("xx") - F.col("x") * F.col("x")
    good = F.coalesce(det != 0, F.lit(False))
    safe = F.when(good, det).otherwise(1.0)
    scale = F.when(good, (F.col("n") * F.col("xy") - F.col("x") * F.col("y")) / safe).otherwise(1.0)
    bias = F.when(good, (F.col("xx") * F.col("y") - F.col("x") * F.col("xy")) / safe).otherwise(0.0)
    return s.select(*keys, scale.alias("scale"), bias.alias("bias"))


def scale_only(rows: DataFrame, keys: list[str], a: Column, b: Column, eps: float = 1e-12) -> DataFrame:
    """The scale of b that comes nearest to a."""
    return rows.groupBy(*keys).agg((F.sum(a * b) / F.greatest(F.sum(b * b), F.lit(eps))).alias("scale"))


def trimmed(rows: DataFrame, keys: list[str], columns: dict[str, Column], low: float = 0.1, high: float = 0.9) -> DataFrame:
    """Rows strictly between two quantiles of each column, taken per group (over its valid values: null ones do not count)."""
    for name, column in columns.items():
        rows = rows.withColumn(f"_t_{name}", column)
    bounds = quantiles(rows, keys, {f"_b_{n}": F.col(f"_t_{n}") for n in columns}, [low, high])
    rows = rows.join(bounds, keys) if keys else rows.join(F.broadcast(bounds))  # without keys the bounds are one row
    for name in columns:
        rows = rows.where((F.col(f"_t_{name}") > F.col(f"_b_{name}")[0]) & (F.col(f"_t_{name}") < F.col(f"_b_{name}")[1]))
    return rows.drop(*[f"_{x}_{n}" for n in columns for x in "tb"])


def inverse_depth_fit(rows: DataFrame, keys: list[str], source_inverse: str, target_depth: str) -> DataFrame:
    """Scale and bias from a source's inverse depth to a target's, without the outer tenths of either."""
    s = F.when(F.col(source_inverse) > 0, F.col(source_inverse))
    t = F.when(F.col(target_depth) > 0, 1 / F.col(target_depth))
    return affine(trimmed(rows, keys, {"s": s, "t": t}), keys, s, t)


def depth_of_fit(source_inverse: Column, scale: Column, bias: Column) -> Column:
    return F.greatest(1 / (source_inverse * scale + bias), F.lit(1e-4))


def depth_fit(rows: DataFrame, keys: list[str], source: str, target: str, mode: str) -> DataFrame:
    """Scale (and bias) between depths without the outer tenths: mode ``median`` takes the lower median of ratios, ``affine`` fits both."""
    s, t = F.when(F.col(source) > 0, F.col(source)), F.when(F.col(target) > 0, F.col(target))
    kept = trimmed(rows, keys, {"s": s, "t": t})
    if mode == "affine":
        return affine(kept, keys, s, t)
    if mode != "median":
        raise ValueError("mode is median or affine")
    return quantiles(kept, keys, {"q": t / s}, [0.5], lower=True).select(*keys, F.col("q")[0].alias("scale"), F.lit(0.0).alias("bias"))


def median_scale(rows: DataFrame, keys: list[str], frame: str, predicted: str, target: str, valid: Column, least: float = 0.05) -> DataFrame:
    """The lower median of predicted / target per frame; a frame with few valid rows keeps the scale before it, at first 1."""
    per = rows.groupBy(*keys, frame).agg(
        F.expr("percentile_disc(0.5) within group (order by _r)").alias("own"), F.avg(F.col("_v").cast("double")).alias("share")
    ) if "_r" in rows.columns else None
    if per is None:
        marked = rows.withColumn("_v", F.coalesce(valid, F.lit(False))).withColumn("_r", F.when(F.col("_v"), F.col(predicted) / F.col(target)))
        return median_scale(marked, keys, frame, predicted, target, valid, least)
    w = Window.partitionBy(*keys).orderBy(frame).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.when(F.col("share") >= least, F.col("own"))
    return per.select(*keys, frame, F.coalesce(F.last(own, ignorenulls=True).over(w), F.lit(1.0)).alias("scale"))


def normalised(rows: DataFrame, keys: list[str], value: str, valid: Column) -> DataFrame:
    """(x - min) / (max - min) over the valid rows of a group; equal values are divided by 1."""
    b = rows.groupBy(*keys).agg(F.min(F.when(valid, F.col(value))).alias("_lo"), F.max(F.when(valid, F.col(value))).alias("_hi"))
    span = F.col("_hi") - F.col("_lo")
    return rows.join(b, keys).withColumn("normalised", (F.col(value) - F.col("_lo")) / F.when(span == 0, 1.0).otherwise(span)).drop("_lo", "_hi")


def completion_uncertainty(near: Column, whole: Column, keys: list[str] | None = None) -> Column:
    """How far a filled depth lies from the globally fitted one, as a share of it; with keys between 0 and 1 over each raster."""
    off = F.when(whole > 0, F.abs(near - whole) / whole).otherwise(0.0)
    if keys is None:
        return off
    w = Window.partitionBy(*keys)
    span = F.max(off).over(w) - F.min(off).over(w)
    return F.when(span > 0, (off - F.min(off).over(w)) / span).otherwise(0.0)


def disparity(depth: Column) -> Column:
    return F.when(depth > 0, 1 / depth).otherwise(0.0)


def depth_metrics(output: Column, target: Column) -> list[Column]:
    """abs_rel, rmse_log and delta1 as aggregates over valid rows."""
    log = F.log(output) - F.log(target)
    return [
        (F.sum(F.abs(output - target) / target) / F.count(F.lit(1))).alias("abs_rel"),
        F.sqrt(F.avg(log * log)).alias("rmse_log"),
        F.avg((F.greatest(output / target, target / output) < 1.25).cast("double")).alias("delta1"),
    ]


def coverage(pixels: DataFrame, keys: list[str], u: Column, v: Column, valid: Column, width: Column, height: Column, cells: int = 10) -> DataFrame:
    """The share of cells x cells fields with a valid pixel; what remains beside whole fields does not count."""
    a, b = F.floor(width / cells), F.floor(height / cells)
    inside = (u < a * cells) & (v < b * cells)
    per = pixels.where(inside).groupBy(*keys, F.floor(u / a).alias("_a"), F.floor(v / b).alias("_b")).agg(F.max(valid.cast("int")).alias("_hit"))
    return per.groupBy(*keys).agg((F.sum("_hit") / float(cells * cells)).alias("score"))


def box(points: DataFrame, keys: list[str], axes: list[str], quantile: float = 0.01) -> DataFrame:
    got = quantiles(points, keys, {a: F.col(a) for a in axes}, [quantile, 1 - quantile])
    return got.select(*keys, *[F.col(a)[i].alias(f"{n}_{a}") for a in axes for i, n in enumerate(("low", "high"))])


def frame_distance(pairs: DataFrame, keys: list[str], full: Column, moved: Column, valid: Column, beta: float = 0.3, least: float = 0.75, far: float = 1000.0) -> DataFrame:
    """beta * mean full flow + (1 - beta) * mean translational flow over valid pixels; too few valid pixels are far apart."""
    mix = beta * full + (1 - beta) * moved
    s = pairs.groupBy(*keys).agg(F.sum(F.when(valid, mix)).alias("_s"), F.count(F.when(valid, F.lit(1))).alias("_n"), F.count(F.lit(1)).alias("_all"))
    return s.select(*keys, F.when(F.col("_n") / F.col("_all") < least, far).otherwise(F.col("_s") / F.greatest(F.col("_n"), F.lit(1))).alias("distance"))


# Similarity between point sets. Sums are gathered by Spark; a group's answer needs nine of them.


def _moments(rows: DataFrame, keys: list[str], source: list[str], target: list[str]) -> DataFrame:
    s, t = [F.col(c) for c in source], [F.col(c) for c in target]
    sums = [F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"ms{i}") for i, c in enumerate(s)], *[F.avg(c).alias(f"mt{i}") for i, c in enumerate(t)], F.sum(sum(c * c for c in s[1:]) + s[0] * s[0]).alias("ss")]
    sums += [F.sum(t[i] * s[j]).alias(f"c{i}{j}") for i in range(3) for j in range(3)]
    return rows.groupBy(*keys).agg(*sums)


def solve_similarity(m: pd.Series, with_scale: bool) -> tuple[float, np.ndarray, np.ndarray]:
    """Scale, rotation and translation from the moments of a group; fewer than three points only move."""
    n = m["n"]
    ms, mt = np.array([m[f"ms{i}"] for i in range(3)]), np.array([m[f"mt{i}"] for i in range(3)])
    if n < 3:
        return 1.0, np.eye(3), mt - ms
    c = np.array([[m[f"c{i}{j}"] for j in range(3)] for i in range(3)]) / n - np.outer(mt, ms)
    var = max(m["ss"] / n - ms @ ms, 1e-12)
    u, d, vt = np.linalg.svd(c)
    sign = np.diag([1.0, 1.0, np.sign(np.linalg.det(u @ vt)) or 1.0])
    r = u @ sign @ vt
    s = float(np.trace(np.diag(d) @ sign) / var) if with_scale else 1.0
    return s, r, mt - s * r @ ms


def similarity(rows: DataFrame, keys: list[str], source: list[str], target: list[str], with_scale: bool = True) -> DataFrame:
    """The similarity that takes the source points of each group nearest to the target points: scale, r00 .. r22, tx, ty, tz."""
    names = [f"r{i}{j}" for i in range(3) for j in range(3)]
    moments = _moments(rows, keys, source, target)
    key_fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in moments.select(*keys).schema.fields)

    def solve(batches):
        for frame in batches:
            got = [solve_similarity(m, with_scale) for _, m in frame.iterrows()]
            out = frame[keys].copy()
            out["scale"] = [g[0] for g in got]
            for k, name in enumerate(names):
                out[name] = [g[1][k // 3, k % 3] for g in got]
            for k, name in enumerate(("tx", "ty", "tz")):
                out[name] = [g[2][k] for g in got]
            yield out

    return moments.mapInPandas(solve, f"{key_fields}, scale double, " + ", ".join(f"{n} double" for n in [*names, "tx", "ty", "tz"]))


def rotation_average(rows: DataFrame, keys: list[str], q: list[str]) -> DataFrame:
    """The rotation nearest to all quaternions of a group (largest eigenvector of their mean outer product), with w >= 0."""
    sums = rows.groupBy(*keys).agg(*[F.avg(F.col(q[i]) * F.col(q[j])).alias(f"m{i}{j}") for i in range(4) for j in range(i, 4)])
    key_fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sums.select(*keys).schema.fields)

    def solve(batches):
        for frame in batches:
            out = frame[keys].copy()
            got = []
            for _, m in frame.iterrows():
                a = np.array([[m[f"m{min(i, j)}{max(i, j)}"] for j in range(4)] for i in range(4)], float)
                v = np.linalg.eigh(a)[1][:, -1]
                got.append(v if v[3] >= 0 else -v)
            for k, name in enumerate(("qx", "qy", "qz", "qw")):
                out[name] = [g[k] for g in got]
            yield out

    return sums.mapInPandas(solve, f"{key_fields}, qx double, qy double, qz double, qw double")


def _apply(model, points: np.ndarray) -> np.ndarray:
    return model[0] * points @ model[1].T + model[2]


def umeyama(source: np.ndarray, target: np.ndarray, with_scale: bool = True):
    m = {"n": len(source), "ss": float((source**2).sum())} | {f"ms{i}": source[:, i].mean() for i in range(3)} | {f"mt{i}": target[:, i].mean() for i in range(3)}
    m |= {f"c{i}{j}": float(target[:, i] @ source[:, j]) for i in range(3) for j in range(3)}
    return solve_similarity(m, with_scale)


#: Points whose distances to all others are held at once.
_NEAR_BLOCK = 256
#: Rows of a group from which models are drawn at most; inliers are counted over all rows.
DRAWN = 1024


def _nearest(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The distance of each point to the nearest other one."""
    out = [np.sqrt(((points[i : i + _NEAR_BLOCK, None, :] - others[None, :, :]) ** 2).sum(-1)).min(axis=1) for i in range(0, len(points), _NEAR_BLOCK)]
    return np.concatenate(out) if out else np.zeros(0)


def candidates(source: np.ndarray, target: np.ndarray, rounds: int = 10, seed: int = 42):
    """The inlier distance (the median distance of the first fit to any target point), the first fit, and fits of drawn halves."""
    n = len(source)
    first = umeyama(source, target)
    limit, rng = float(np.median(_nearest(_apply(first, source), target))), np.random.default_rng(seed)
    picks = [rng.choice(n, max(3, -(-n // 2)), replace=False) if n >= 3 else np.arange(n) for _ in range(rounds)]
    return limit, first, [umeyama(source[p], target[p]) for p in picks]


def ransac(source: np.ndarray, target: np.ndarray, rounds: int = 10, seed: int = 42):
    """The similarity with the most inliers over samples of half the points; errors break ties, and the inliers are fitted again."""
    limit, best, models = candidates(source, target, rounds, seed)
    mark = (-1, 0.0)
    for model in models:
        error = np.linalg.norm(_apply(model, source) - target, axis=1)
        inside = error <= limit
        score = (int(inside.sum()), -float(error[inside].mean()) if inside.any() else 0.0)
        if score > mark:
            mark, best = score, umeyama(source[inside], target[inside]) if inside.sum() >= 3 else model
    return best


def ransac_similarity(rows: DataFrame, keys: list[str], row_id: str, source: list[str], target: list[str], rounds: int = 10, seed: int = 42) -> DataFrame:
    """``ransac`` for groups of any size: scale, r00 .. r22, tx, ty, tz for each group.

    Models come from at most DRAWN rows of a group (all of a smaller one),
    chosen by a hash of row_id; their inliers are counted, and the best
    model's inliers fitted again, over all rows, where they are.
    """
    kinds = dict(rows.dtypes)
    fields = ", ".join(f"`{k}` {kinds[k]}" for k in keys)
    order = Window.partitionBy(*keys).orderBy(F.xxhash64(F.lit(seed), row_id), row_id)
    drawn = rows.select(*keys, row_id, *source, *target).withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= DRAWN).drop("_r")

    def draw(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(row_id)
        limit, first, models = candidates(frame[source].to_numpy(float), frame[target].to_numpy(float), rounds, seed)
        flat = [[float(s), *map(float, r.ravel()), *map(float, t)] for s, r, t in [first, *models]]
        return pd.DataFrame({**{k: [frame[k].iloc[0]] for k in keys}, "limit": [limit], "models": [flat]})

    models = drawn.groupBy(*keys).applyInPandas(draw, f"{fields}, limit double, models array<array<double>>")
    s, t = [F.col(c).cast("double") for c in source], [F.col(c).cast("double") for c in target]

    def error(m: Column) -> Column:
        off = [m[0] * sum((m[1 + 3 * i + j] * s[j] for j in (1, 2)), m[1 + 3 * i] * s[0]) + m[10 + i] - t[i] for i in range(3)]
        return F.sqrt(off[0] * off[0] + off[1] * off[1] + off[2] * off[2])

    met = rows.select(*keys, *source, *target).join(models, keys)
    errors = [error(F.col("models")[n + 1]) for n in range(rounds)]
    score = met.groupBy(*keys).agg(*[F.count(F.when(e <= F.col("limit"), F.lit(1))).alias(f"n{i}") for i, e in enumerate(errors)], *[F.avg(F.when(e <= F.col("limit"), e)).alias(f"e{i}") for i, e in enumerate(errors)])
    # More inliers, then the smaller error, then the earlier draw.
    marks = F.array(*[F.struct(F.col(f"n{i}").alias("n"), (-F.coalesce(F.col(f"e{i}"), F.lit(0.0))).alias("e"), F.lit(-i).alias("i")) for i in range(rounds)])
    best = score.select(*keys, F.array_max(marks).alias("best")).join(models, keys).select(*keys, "limit", F.get("models", 1 - F.col("best.i")).alias("model"), F.col("best.n").alias("inliers"))
    inside = rows.select(*keys, *source, *target).join(best, keys).where(error(F.col("model")) <= F.col("limit"))
    again = similarity(inside, keys, source, target)
    names = [c for c in again.columns if c not in keys]
    own = {n: F.col("model")[i] for i, n in enumerate(names)}
    few = F.col("inliers") < 3
    return best.join(again, keys, "left").select(*keys, *[F.when(few, own[n]).otherwise(F.col(n)).alias(n) for n in names])


def align_translation(source, target, rounds: int = 10):
    """A similarity on the left and a translation in the camera on the right, by turns: arrays (points, rotations) of both sides."""
    (ps, rs), (pt, _) = source, target
    right = np.zeros(3)
    model = umeyama(ps, pt)
    for _ in range(rounds):
        model = umeyama(ps + rs @ right, pt)
        s, r, t = model
        a = s * (r @ rs).reshape(-1, 3)
        b = (pt - (s * ps @ r.T + t)).reshape(-1)
        right = np.linalg.lstsq(a, b, rcond=None)[0]
    return model, right


def pose_average(rows: DataFrame, keys: list[str], t: list[str], q: list[str]) -> DataFrame:
    """The mean translation and the average rotation of the poses of each group: tx, ty, tz, qx, qy, qz, qw."""
    middle = rows.groupBy(*keys).agg(*[F.avg(c).alias(n) for c, n in zip(t, ("tx", "ty", "tz"), strict=True)])
    return middle.join(rotation_average(rows, keys, q), keys)


def median_nearest(points: DataFrame, others: DataFrame, keys: list[str], axes: list[str], point_id: str, other_id: str) -> DataFrame:
    """The median over points of the distance to the nearest other point of the group."""
    from tessella.operators.joins import knn

    near = knn(points, others, keys, axes, 1, None, point_id, other_id)
    return quantiles(near, keys, {"median": F.sqrt("d2")}, [0.5]).select(*keys, F.col("median")[0].alias("median"))


def depth_to_input(depths: DataFrame, cameras: DataFrame, keys: list[str], row_id: str, source: list[str], target: list[str], depth: str, least_views: int = 10) -> DataFrame:
    """Depths divided by the scale that takes predicted camera places (source) to given ones (target); groups of many views are fitted robustly."""
    counts = cameras.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    named = cameras.join(counts, keys)
    many = ransac_similarity(named.where(F.col("_n") >= least_views), keys, row_id, source, target).select(*keys, "scale")
    few = similarity(named.where(F.col("_n") < least_views), keys, source, target).select(*keys, "scale")
    return depths.join(many.unionByName(few), keys).withColumn(depth, F.col(depth) / F.col("scale")).drop("scale")


# Poses as arrays (tx, ty, tz, qx, qy, qz, qw).


def pose_mul(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b for arrays of poses of equal or single length."""
    a, b = np.broadcast_arrays(np.atleast_2d(a), np.atleast_2d(b))
    x, w, y, v = a[:, 3:6], a[:, 6:], b[:, 3:6], b[:, 6:]
    turned = b[:, :3] + 2 * np.cross(x, np.cross(x, b[:, :3]) + w * b[:, :3])
    return np.concatenate((a[:, :3] + turned, w * y + v * x + np.cross(x, y), w * v - (x * y).sum(axis=1, keepdims=True)), axis=1)


def pose_inv(a: np.ndarray) -> np.ndarray:
    a = np.atleast_2d(a)
    x, w = -a[:, 3:6], a[:, 6:]
    return np.concatenate((-(a[:, :3] + 2 * np.cross(x, np.cross(x, a[:, :3]) + w * a[:, :3])), x, w), axis=1)


class GroupParameter:
    """A pose that gradient descent moves on its group: the gradient is a tangent at the present value."""

    def __init__(self, value: np.ndarray):
        self.value = np.asarray(value, float)

    def at(self, tangent: np.ndarray) -> np.ndarray:
        """exp(tangent) * value."""
        from tessella.operators.bundle import retract

        return retract(self.value, tangent)

    def descend(self, gradient: np.ndarray, rate: float) -> None:
        self.value = self.at(-rate * gradient)


def align_full(source: np.ndarray, target: np.ndarray, rounds: int = 200, rate: float = 0.01) -> tuple[np.ndarray, float]:
    """T * source * R nearest to target by gradient descent on the mean squared logarithm of their difference; the poses and the last mean.

    Trajectories that lie far apart should be brought near first, for example by ``align_translation``.
    """
    from tessella.operators.graph import motion

    left, right = GroupParameter(np.array([0, 0, 0, 0, 0, 0, 1.0])), GroupParameter(np.array([0, 0, 0, 0, 0, 0, 1.0]))
    identity = np.array([0, 0, 0, 0, 0, 0, 1.0])

    def cost(t: np.ndarray, r: np.ndarray) -> float:
        off = pose_mul(pose_inv(pose_mul(pose_mul(t, source), r)), target)
        return float(np.mean([(motion(identity, o) ** 2).sum() for o in off]))

    h = 1e-6
    for _ in range(rounds):
        slopes = []
        for p, other in ((left, right), (right, left)):
            value = (lambda x: cost(x, other.value)) if p is left else (lambda x: cost(other.value, x))
            slopes.append(np.array([(value(p.at(h * e)) - value(p.at(-h * e))) / (2 * h) for e in np.eye(6)]))
        left.descend(slopes[0], rate)
        right.descend(slopes[1], rate)
    return pose_mul(pose_mul(left.value, source), right.value), cost(left.value, right.value)
