import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessella import config
from tessella.functions import camera, lie, robust, text
from tessella.operators import align, bundle, joins, scatter, windows
from tessella.plans import solvers
from tessella.sinks import artifacts
from tessella.sources import frames
from tessella.streaming import folds


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def lits(values):
    return tuple(F.lit(float(v)) for v in values)


def fixed(spark, g):
    """A transform with its numbers in place of its expressions, as a projection would give it."""
    row = one(spark, *g.columns())
    return lie.SE3(lits(row[:3]), lits(row[3:]))


# Transforms.


def test_jinv_is_the_inverse_left_jacobian(spark):
    """Against differences of log(exp(h e) * X)."""
    tau, phi = (0.3, -0.2, 0.5), (0.4, 0.9, -0.3)
    g = lie.SE3.exp(tuple(map(F.lit, tau)), tuple(map(F.lit, phi)))
    row = one(spark, *g.columns())
    base = np.array([*tau, *phi])
    h, want = 1e-6, np.zeros((6, 6))
    for k in range(6):
        e = np.zeros(6)
        e[k] = h
        moved = bundle.retract(np.array(row), e)
        frame = spark.createDataFrame([tuple(map(float, moved))], "tx double, ty double, tz double, qx double, qy double, qz double, qw double")
        x = lie.SE3.of().log()
        want[:, k] = (np.array(tuple(frame.select(*x[0], *x[1]).first())) - base) / h
    unit = spark.range(6).select("id", *[F.when(F.col("id") == i, 1.0).otherwise(0.0).alias(f"a{i}") for i in range(6)], *[F.lit(float(v)).alias(f"x{i}") for i, v in enumerate(base)])
    t, p = lie.SE3.of().jinv(lie.vec("a0", "a1", "a2"), lie.vec("a3", "a4", "a5"), (lie.vec("x0", "x1", "x2"), lie.vec("x3", "x4", "x5")))
    for k, got in enumerate(unit.orderBy("id").select(*t, *p).collect()):
        assert np.allclose(tuple(got), want[:, k], atol=2e-5)


def test_transforms_agree(spark):
    a = fixed(spark, lie.SE3.exp(lits((0.1, 0.2, 0.3)), lits((0.5, -0.4, 0.2))))
    p = lits((1.0, -2.0, 3.0))
    m = np.array(one(spark, *[c for r in a.matrix() for c in r]), float).reshape(4, 4)
    assert np.allclose(np.array(one(spark, *a.act(p))), (m @ [1, -2, 3, 1])[:3])
    back = np.array(one(spark, *[c for r in lie.matrix_inverse(a.matrix()) for c in r]), float).reshape(4, 4)
    assert np.allclose(back @ m, np.eye(4), atol=1e-12)
    x = lits((0.3, 0.1, -0.7)), lits((0.2, 0.8, 0.5))
    flat = one(spark, *[c for part in a.adj(*x) for c in part])
    ad = lits(flat[:3]), lits(flat[3:])
    left = fixed(spark, a.mul(fixed(spark, lie.SE3.exp(*x)))).mul(fixed(spark, a.inv()))
    assert np.allclose(one(spark, *left.columns()), one(spark, *lie.SE3.exp(*ad).columns()), atol=1e-9)
    y = lits((0.9, -0.1, 0.4)), lits((0.6, 0.2, -0.3))
    at = a.adj_t(*y)
    assert np.isclose(*one(spark, lie.dot((*ad[0], *ad[1]), (*y[0], *y[1])), lie.dot((*x[0], *x[1]), (*at[0], *at[1]))))
    s = lie.Sim3(a.t, a.q, F.lit(1.5))
    moved = lits(one(spark, *s.inv().act(p)))
    assert np.allclose(one(spark, *s.act(moved)), (1, -2, 3))
    tau, phi = a.log()
    assert np.allclose(one(spark, *tau, *phi), (0.1, 0.2, 0.3, 0.5, -0.4, 0.2))
    assert np.allclose(one(spark, *lie.yaw_pitch(F.lit(0.0), F.lit(0.3))), (np.sin(0.15), 0, 0, np.cos(0.15)))


def test_small_angles(spark):
    z = F.lit(0.0)
    assert one(spark, *lie.SE3.exp((F.lit(1.0), z, z), (z, z, z)).columns()) == (1, 0, 0, 0, 0, 0, 1)
    g = lie.Sim3.exp(lits((1, 2, 0)), lits((1e-9, 0, 0)), F.lit(0.0))
    row = one(spark, *g.t, *g.q, g.s)
    tau, phi, s = lie.Sim3(lits(row[:3]), lits(row[3:7]), F.lit(row[7])).log(lits((1e-9, 0, 0)))
    assert np.allclose(one(spark, *tau, *phi, s), (1, 2, 0, 1e-9, 0, 0, 0))


# Cameras and weights.


def test_camera_models(spark):
    lit = lambda *x: tuple(F.lit(float(v)) for v in x)
    pin, mei = camera.Pinhole(*lit(40, 40, 2, 2)), camera.Mei(*lit(40, 40, 2, 2, 0.2))
    assert np.allclose(one(spark, *pin.project(pin.unproject(*lit(3, 1)))), (3, 1))
    assert np.allclose(one(spark, *pin.project(lit(1, 1, 0.05))), (42, 42))
    for cam in (pin, mei):
        p, h = np.array([0.3, -0.2, 1.7]), 1e-6
        rows = cam.project_jacobian(lit(*p))
        want = [(np.array(one(spark, *cam.project(lit(*(p + h * e)), limit=False))) - np.array(one(spark, *cam.project(lit(*p), limit=False)))) / h for e in np.eye(3)]
        assert np.allclose(np.array(one(spark, *rows[0], *rows[1]), float).reshape(2, 3), np.array(want).T, atol=1e-3)
    u, v = camera.Panorama().project(camera.Panorama().unproject(*lit(0.3, 0.6)))
    assert np.allclose(one(spark, u, v), (0.3, 0.6))
    x, y = camera.mei_undo(*camera.mei_distort(*lit(0.3, -0.4), F.lit(0.2)), F.lit(0.2))
    assert np.allclose(one(spark, x, y), (0.3, -0.4))
    roll, pitch = camera.roll_pitch(camera.gravity(*lit(2.5, 0.4)))
    assert np.allclose(one(spark, roll, pitch), (2.5, 0.4))
    with pytest.raises(ValueError):
        camera.camera("SIMPLE_DIVISIONAL", [])
    w, h = camera.patch_size(F.lit(1280.0), F.lit(720.0))
    w, h = one(spark, w, h)
    assert w % 14 == h % 14 == 0 and w * h <= 255_000


def test_kernels(spark):
    assert one(spark, robust.kernel(None)(F.lit(9.0)), robust.kernel("huber", 2.0)(F.lit(-4.0)), robust.kernel("off")(F.lit(1.0))) == (1, 0.5, 1)
    assert robust.mu_schedule(1, 3, 20) == [1, 3, 9, 20]
    with pytest.raises(ValueError):
        robust.kernel("cauchy")


def test_best_span(spark):
    row = spark.createDataFrame([(["a", "cat", ".", "red", "dog", "."], [0.1, 0.5, 9.0, 0.3, 0.4, 9.0])], "t array<string>, s array<double>").select(text.best_span(F.col("t"), F.col("s"))).first()
    assert row[0] == "red dog"


# Reductions, windows, joins.


@given(st.lists(st.tuples(st.integers(0, 6), st.integers(-50, 50)), max_size=40))
@settings(max_examples=8, deadline=None)
def test_scatter_is_add_at(spark, rows):
    want = np.zeros(8, int)
    for i, x in rows:
        want[i] += x
    df = spark.createDataFrame([(i, x, n) for n, (i, x) in enumerate(rows)], "i long, x long, n long")
    assert [r.value for r in scatter.scatter(df, "i", F.col("x"), "sum", 8).orderBy("i").collect()] == want.tolist()
    low = {r.i: (r.value, r.arg) for r in scatter.scatter(df, "i", F.col("x"), "min", 8, order="n").collect()}
    for i in range(8):
        own = [(x, n) for n, (k, x) in enumerate(rows) if k == i]
        assert low[i] == (min(own) if own else (0, len(rows)))
    with pytest.raises(ValueError):
        scatter.scatter(df, "i", F.col("x"), "median")


def test_order_of_rows_does_not_matter(spark):
    rows = [(s, t, (s * 7 + t * 13) % 11 + 0.0) for s in range(3) for t in range(40)]
    a = windows.ema(spark.createDataFrame(rows, "s long, t long, x double"), "s", ["t"], "x", 0.9)
    b = windows.ema(spark.createDataFrame(rows[::-1], "s long, t long, x double"), "s", ["t"], "x", 0.9)
    assert {(r.s, r.t): round(r.ema, 9) for r in a.collect()} == {(r.s, r.t): round(r.ema, 9) for r in b.collect()}


def test_ema_with_nulls(spark):
    rows = [(0, 0, None), (0, 1, 4.0), (0, 2, None), (0, 3, 8.0)]
    got = {r.t: r.ema for r in windows.ema(spark.createDataFrame(rows, "s long, t long, x double"), "s", ["t"], "x", 0.5).collect()}
    assert got[0] is None and got[1] == 4 and got[3] == 6


@pytest.mark.parametrize("n", [1, 5, 10, 11, 17, 18, 40])
def test_overlap_weights_sum_to_one(spark, n):
    rows = windows.overlapping(spark.range(n).withColumn("len", F.lit(n)), "id", F.col("len"), 10, 3)
    total = {r.id: (r.w, r.k) for r in rows.groupBy("id").agg(F.sum("weight").alias("w"), F.count(F.lit(1)).alias("k")).collect()}
    assert len(total) == n and all(abs(w - 1) < 1e-12 and k <= 2 for w, k in total.values())


def test_band_join_reaches_negative_cells(spark):
    a = spark.createDataFrame([(x,) for x in range(-10, 11)], "a long")
    b = spark.createDataFrame([(x,) for x in range(-10, 11)], "b long")
    got = {(r.a, r.b) for r in joins.band(a, b, [], "a", "b", -2, 1).collect()}
    assert got == {(x, y) for x in range(-10, 11) for y in range(-10, 11) if -2 <= y - x <= 1}


def test_knn_far_queries(spark):
    pts = spark.createDataFrame([(i, float(i), 0.0) for i in range(20)], "p long, x double, y double")
    ask = spark.createDataFrame([(0, -500.0, 3.0), (1, 7.2, 0.0)], "q long, x double, y double")
    got = {(r.q, r["rank"]): r.p for r in joins.knn(ask, pts, [], ["x", "y"], 3, 0.5, "q", "p").collect()}
    assert [got[0, k] for k in (1, 2, 3)] == [0, 1, 2] and [got[1, k] for k in (1, 2, 3)] == [7, 8, 6]


def _joined(plan):
    """Rows that the joins of an executed plan have put out."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return _joined(plan.executedPlan())
    below = [plan.plan()] if name.endswith("QueryStageExec") else [plan.children().apply(i) for i in range(plan.children().size())]
    own = plan.metrics().get("numOutputRows").get().value() if "JoinExec" in name else 0
    return own + sum(map(_joined, below))


def test_knn_of_a_full_cell(spark, monkeypatch):
    """A given cell that holds nearly all points: few pairs a query leave the joins, and all neighbours are found."""
    rows, kept = [], joins.cut

    def cut(df):
        out = kept(df)
        rows.append(_joined(df._jdf.queryExecution().executedPlan()))
        return out

    monkeypatch.setattr(joins, "cut", cut)
    rng = np.random.default_rng(3)
    p, q = np.concatenate((rng.uniform(0.1, 0.9, (4000, 3)), [[3, 3, 3]])), rng.uniform(0.1, 0.9, (1000, 3))
    points = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(p)], "p long, x double, y double, z double")
    asked = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(q)], "q long, x double, y double, z double")
    got = {(r.q, r["rank"]): r.p for r in joins.knn(asked, points, [], ["x", "y", "z"], 5, 1.0, "q", "p").collect()}
    d = ((q[:, None] - p[None]) ** 2).sum(-1)
    assert len(got) == 5000 and all([got[i, r] for r in range(1, 6)] == np.argsort(d[i])[:5].tolist() for i in range(1000))
    assert sum(rows) < 1000 * 4000 / 4


@pytest.mark.parametrize("name", ["knn_affine_fill", "knn_mean_fill"])
def test_fills_of_a_full_cell(spark, monkeypatch, tmp_path, name):
    """The registered fills over vectors that lie in few cells of the given width: the SQL's rows from few pairs a query."""
    import duckdb
    import pandas as pd

    from tessella import catalogue

    rows, kept = [], joins.cut

    def cut(df):
        out = kept(df)
        rows.append(_joined(df._jdf.queryExecution().executedPlan()))
        return out

    monkeypatch.setattr(joins, "cut", cut)
    rng = np.random.default_rng(4)
    e = np.concatenate((rng.normal(0, 0.05, (2000, 4)), [[2, 2, 2, 2]])).astype(np.float32)
    pd.DataFrame({"vec_id": np.arange(len(e)), "label": np.arange(len(e)) % 10, "embedding": list(e)}).to_parquet(tmp_path / "embeddings.parquet")
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet'")
    want = con.sql(catalogue.oracle_sql()[name]).df().sort_values("query_id").to_numpy()
    got = catalogue.queries()[name](spark, str(tmp_path)).toPandas().sort_values("query_id").to_numpy()
    # Sums in another order may round otherwise.
    assert got.shape == want.shape and np.allclose(got, want, rtol=1e-6, atol=2e-5)
    assert 0 < sum(rows) < 600 * 1400 / 4


def test_knn_of_copies(spark, monkeypatch):
    """Points on one place count by their smallest ids, others beside them are found; rows without a place are none."""
    rows = [(i, 0.5, 0.5) for i in range(900, -1, -1)] + [(1000 + i, 0.5 + i / 100, 0.5) for i in range(1, 4)] + [(2000, None, 0.5)]
    points = spark.createDataFrame(rows, "p long, x double, y double")
    asked = spark.createDataFrame([(i, 0.5, 0.5) for i in range(50)] + [(60, 0.53, 0.5), (61, None, 0.0)], "q long, x double, y double")
    read, width = [], joins.cell_width
    monkeypatch.setattr(joins, "cell_width", lambda places, *a: read.append(places.count()) or width(places, *a))
    for cell in (0.25, None):
        got = {}
        for r in sorted(joins.knn(asked, points, [], ["x", "y"], 5, cell, "q", "p").collect(), key=lambda r: (r.q, r["rank"])):
            got.setdefault(r.q, []).append(r.p)
        assert got == {**{i: [0, 1, 2, 3, 4] for i in range(50)}, 60: [1003, 1002, 1001, 0, 1]}
    assert read == [8, 8]


def test_same_edges_of_one_batch(spark):
    e = spark.createDataFrame([(1, 2), (1, 2), (3, 4)], "i long, j long")
    assert joins.new_edges(e, e.where("i = 3")).count() == 1


def test_similarity_and_ransac(spark):
    rng = np.random.default_rng(0)
    s = rng.normal(size=(60, 3))
    q, _ = np.linalg.qr(rng.normal(size=(3, 3)))
    q *= np.sign(np.linalg.det(q))
    t = 1.7 * s @ q.T + [1, -2, 3]
    scale, r, move = align.umeyama(s, t)
    assert np.isclose(scale, 1.7) and np.allclose(r, q) and np.allclose(move, [1, -2, 3])
    bad = t.copy()
    bad[:6] += 50
    model = align.ransac(s, bad, rounds=40)
    assert np.median(np.linalg.norm(model[0] * s @ model[1].T + model[2] - t, axis=1)) < 5
    rows = spark.createDataFrame([(0, *map(float, a), *map(float, b)) for a, b in zip(s, t, strict=True)], "k long, sx double, sy double, sz double, tx double, ty double, tz double")
    got = align.similarity(rows, ["k"], ["sx", "sy", "sz"], ["tx", "ty", "tz"]).first()
    assert np.isclose(got.scale, 1.7) and np.isclose(got.tx, 1)
    eye = np.repeat(np.eye(3)[None], 60, axis=0)
    (_, _, _), right = align.align_translation((s, eye), (s + 0.25, eye))
    assert np.all(np.isfinite(right))


# Bundle adjustment.


def _dense(spark, graph, damping, eps, alpha, eta):
    """The same step from one full system, without elimination."""
    pixels, edges, target, poses, k = graph
    rows = bundle.residuals(pixels, target, edges, bundle._poses(spark, poses), k).toPandas()
    px = pixels.toPandas()
    at = {(r.frame_idx, r.v, r.u): 24 + n for n, r in enumerate(px.itertuples())}
    a, b = np.zeros((24 + len(at),) * 2), np.zeros(24 + len(at))
    for r in rows.to_dict("records"):
        for c in "uv":
            j = np.zeros(len(b))
            for s in "ij":
                if r[s] > 0:
                    j[6 * (r[s] - 1) : 6 * r[s]] += [r[f"a{s}{m}{c}"] for m in range(6)]
            j[at[r["i"], r["v"], r["u"]]] += r[f"d{c}"]
            a += r[f"w{c}"] * np.outer(j, j)
            b -= r[f"w{c}"] * r[f"r{c}"] * j
    n = np.arange(24)
    a[n, n] += eps + damping * a[n, n]
    for r in px.itertuples():
        k = at[r.frame_idx, r.v, r.u]
        a[k, k] += eta
        if r.disp_sensor > 0:
            a[k, k] += alpha
            b[k] -= alpha * (r.disp - r.disp_sensor)
    x = np.linalg.solve(a, b)
    return x, at


def test_step_equals_the_full_solve(spark):
    graph = solvers.closed_graph(spark)
    pixels, edges, target, poses, k = graph
    rows = bundle.residuals(pixels, target, edges, bundle._poses(spark, poses), k).persist()
    steps, after = bundle.step(pixels, rows, [1, 2, 3, 4], 1e-3, 0.1, 0.001, 0.1, False)
    x, at = _dense(spark, graph, 1e-3, 0.1, 0.001, 0.1)
    for f, n in zip((1, 2, 3, 4), range(4), strict=True):
        assert np.allclose(steps[f], x[6 * n : 6 * n + 6], atol=1e-9)
    before = {(r.frame_idx, r.v, r.u): r.disp for r in pixels.collect()}
    linked = {r.i for r in edges.where("i <> j").collect()}
    for r in after.collect():
        if r.frame_idx in linked:
            key = (r.frame_idx, r.v, r.u)
            assert np.isclose(r.disp, before[key] + x[at[key]], atol=1e-9)
    only, same = bundle.step(pixels, rows, [1, 2, 3, 4], 1e-3, 0.1, 0.001, 0.1, True)
    assert {(r.frame_idx, r.v, r.u): r.disp for r in same.collect()} == before and set(only) == {1, 2, 3, 4}


def test_energy_falls(spark):
    pixels, edges, target, poses, k = solvers.closed_graph(spark)
    _, _, energies = bundle.adjust(pixels, edges, target, poses, k, [1, 2, 3, 4], iterations=2, eps=1e-3, keep=lambda p: spark.createDataFrame(p.collect(), p.schema))
    assert energies[1] < energies[0]
    assert bundle.residual_metric(4.0, 200) == pytest.approx((4 / 100) ** 0.5 / 16, rel=1e-6)
    assert (bundle._solve(-np.eye(2), np.ones(2)) == 0).all()


# Sources, sinks, configuration, streams.


def _box(kind, body):
    return struct.pack(">I4s", len(body) + 8, kind) + body


def movie(n=30, width=64, height=48, scale=1000, length=2000):
    tkhd = _box(b"tkhd", b"\0" * 76 + struct.pack(">II", width << 16, height << 16))
    mdhd = _box(b"mdhd", b"\0" * 12 + struct.pack(">II", scale, length) + b"\0" * 4)
    hdlr = _box(b"hdlr", b"\0" * 8 + b"vide" + b"\0" * 12)
    stts = _box(b"stts", b"\0" * 4 + struct.pack(">III", 1, n, 66))
    trak = _box(b"trak", tkhd + _box(b"mdia", mdhd + hdlr + _box(b"minf", _box(b"stbl", stts))))
    return _box(b"ftyp", b"isom") + _box(b"moov", trak)


def test_sources(spark, tmp_path):
    folder = tmp_path / "clip"
    folder.mkdir()
    for i in range(12):
        (folder / f"{i:03d}.{'JPG' if i % 2 else 'png'}").write_bytes(b"x" * (i + 1))
    (folder / "notes.txt").write_text("no image")
    got = frames.frame_folder(spark, str(folder), start=2, end=11, step=3).orderBy("frame_idx").collect()
    assert [(r.stream_id, r.frame_idx, r.length) for r in got] == [("clip", 2, 3), ("clip", 5, 6), ("clip", 8, 9)]
    (tmp_path / "a.mp4").write_bytes(movie())
    (tmp_path / "b.mp4").write_bytes(b"broken")
    rows = {r.stream_id: r for r in frames.movie_list(spark, str(tmp_path), start=5, end=25, step=2).collect()}
    assert (rows["a"].width, rows["a"].height, rows["a"].n_frames, rows["a"].fps) == (64, 48, 10, 7.5) and rows["b"].width is None
    (tmp_path / "names.txt").write_text("1: cat\n2: red dog\n")
    assert {r.instance: r.phrase for r in frames.phrases(spark, str(tmp_path / "names.txt")).collect()} == {1: "cat", 2: "red dog"}
    (tmp_path / "bad.txt").write_text("1: a: b\n")
    with pytest.raises(Exception):
        frames.phrases(spark, str(tmp_path / "bad.txt")).collect()
    with pytest.raises(ValueError):
        frames.make("kafka", spark)
    views = frames.multiview([spark.range(3).selectExpr("'s' as stream_id", "id as frame_idx"), spark.range(2).selectExpr("'s' as stream_id", "id as frame_idx")])
    assert frames.unequal_views(views).first().most == 3


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("s", 0, 1.0, None), ("s", 1, None, 2.0), ("s", 2, 3.0, 4.0)], "stream_id string, frame_idx long, a double, b double")
    artifacts.save_all(rows, str(tmp_path), {"a": ["a"], "b": ["b"]})
    assert {r.inds: r.a for r in spark.read.parquet(str(tmp_path / "a")).collect()} == {0: 1.0, 2: 3.0}
    values = [0.1, 1 / 3, 65504.0, 70000.0, 1e-7, -2.5e-8, 2049.0, 0.0]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(artifacts.half(F.col("v"))).collect()]
    with np.errstate(over="ignore"):
        assert got == np.array(values).astype(np.float16).astype(float).tolist()
    poses = spark.createDataFrame([(0, 1.0, 2.0, 3.0, 0.0, 0.0, 0.0, 1.0)], "inds long, tx double, ty double, tz double, qx double, qy double, qz double, qw double")
    assert artifacts.image_lines(poses).first().value.startswith("1 1.000000000 -0.000000000 -0.000000000 -0.000000000 -1.000000000 -2.000000000 -3.000000000 1 000000.jpg")
    pts = spark.range(50).selectExpr("id % 7 as k", "id as p", "1.0D as x", "2.0D as y", "3.0D as z", "0.5D as r", "0.0D as g", "2.0D as b").repartition(5)
    lines = artifacts.point_lines(pts, ["k", "p"]).orderBy("id").collect()
    assert [r.id for r in lines] == list(range(1, 51)) and lines[0].value == "1 1.000000 2.000000 3.000000 127 0 255 0"


@pytest.mark.parametrize("name", sorted(config.PRESETS))
def test_presets(name):
    assert config.Run(pipeline=config.PRESETS[name]).pipeline.window >= 1


def test_configuration():
    run = config.parsed(config.Run, {"pipeline": {"slam": {"kernel": {"name": "tukey", "threshold": 2.0}}}})
    assert run.pipeline.slam.kernel.name == "tukey" and run.pipeline.slam.buffer == 1024
    for bad in ({"nonsense": 1}, {"pipeline": {"camera_type": "SIMPLE_DIVISIONAL"}}, {"pipeline": {"slam": {"kernel": {"name": "cauchy"}}}}, {"pipeline": {"slam": {"buffer": 0}}}):
        with pytest.raises(ValueError):
            config.parsed(config.Run, bad)
    assert config.solver_for(1, "PINHOLE", False, False, False) == "fused" and config.solver_for(2, "PINHOLE", False, False, False) == "generic"
    with pytest.raises(ValueError):
        config.solver_for(1, "MEI", False, False, False, "fused")


def test_checked_length(spark):
    assert folds.checked_length(spark.range(5), 5).count() == 5
    with pytest.raises(Exception):
        folds.checked_length(spark.range(5), 6).count()


def test_stream_in_several_triggers_equals_batch(spark, tmp_path):
    rows = [(i % 3, i, float((i * 37) % 101)) for i in range(60)]
    schema = "s long, t long, x double"
    for n in range(3):
        spark.createDataFrame(rows[n * 20 : n * 20 + 20], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    batch = windows.keyframes(spark.createDataFrame(rows, schema), "s", ["t"], "x", 30.0).collect()
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = folds.drain(folds.keyframes(stream, "s", ["t"], "x", 30.0), "several_triggers").collect()
    assert {(r.s, r.t) for r in got} == {(r.s, r.t) for r in batch}
