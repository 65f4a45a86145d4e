"""Frames, maps, quantiles, folds and sampling patterns."""

import json
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella import config, models
from tessella.functions import camera, lie
from tessella.operators import align, attributes, calibrate, joins, maps, pixels, quantiles, rasters, windows
from tessella.sinks import artifacts
from tessella.streaming import folds


def test_attributes(spark):
    frames = spark.createDataFrame([(1, 0, [1.0], None), (1, 1, None, "PINHOLE")], "stream long, frame_idx long, pose array<double>, camera_type string")
    assert [r.a for r in frames.select(attributes.attributes(frames).alias("a"), "frame_idx").orderBy("frame_idx").collect()] == [["pose"], ["camera_type"]]
    more = attributes.assigned(frames, spark.createDataFrame([(1, 1, [2.0])], "stream long, frame_idx long, pose array<double>"))
    assert {r.frame_idx: r.pose for r in more.collect()} == {0: None, 1: [2.0]}
    assert attributes.stream_attribute(frames, "pose").columns == ["stream", "frame_idx", "pose"]
    with pytest.raises(ValueError):
        attributes.with_attribute(frames, "colour", F.lit(1))


def test_maps(spark):
    points = spark.createDataFrame([(0, 0, 1.0, 2.0, 3.0), (0, 1, 0.0, 0.0, 1.0), (1, 0, 4.0, 4.0, 4.0)], "keyframe long, view int, x double, y double, z double")
    assert maps.keyframe_points(points, 0).count() == 2 and maps.keyframe_points(points, 0, 1).count() == 1
    assert maps.full_map(points, 2.0).agg(F.sum("x")).first()[0] == 10.0
    poses = spark.createDataFrame([(1.0, 2.0, 4.0)], "tx double, ty double, tz double")
    moved, disps = maps.rescaled(poses, spark.createDataFrame([(0.5,)], "disp double"), 2.0)
    assert tuple(moved.first()) == (2.0, 4.0, 8.0) and disps.first().disp == 0.25
    frames = spark.createDataFrame([(0, 0), (0, 1)], "view int, frame_idx long")
    shared, own = spark.createDataFrame([(0, 38.0)], "view int, fx double"), spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0)], "view int, frame_idx long, fx double")
    assert [r.fx for r in maps.intrinsics_of(frames, shared).collect()] == [38.0, 38.0]
    assert {r.frame_idx: r.fx for r in maps.intrinsics_of(frames, own).collect()} == {0: 1.0, 1: 2.0}
    drawn = maps.drawn(spark.createDataFrame([(0, 0.5, 0.5, 1, "a"), (0, 1.5, 0.5, 2, "b")], "k int, u double, v double, o int, c string"), ["k"], "u", "v", F.col("o"), ["c"], 3, 2, maps.stencil(1))
    assert {(r.v, r.u): r.c for r in drawn.collect()} == {(0, 0): "b", (0, 1): "b", (1, 0): "a", (1, 1): "b", (0, 2): "b"}
    boxes = maps.boxes_of(spark.createDataFrame([([0.1, 0.4], 2.0, 3.0, 2.0, 4.0), ([0.3], 0.0, 0.0, 1.0, 1.0)], "l array<double>, cx double, cy double, w double, h double"), "l")
    assert [(r.x0, r.y0, r.x1, r.y1) for r in boxes.collect()] == [(1.0, 1.0, 3.0, 5.0)]
    sensor = maps.refreshed_sensor(spark.createDataFrame([(0, 0, 0, 1.0), (1, 0, 0, 1.0)], "frame_idx long, v int, u int, disp_sensor double"), spark.createDataFrame([(0, 100.0, 50.0)], "frame_idx long, focal_before double, focal double"))
    assert {r.frame_idx: r.disp_sensor for r in sensor.collect()} == {0: 2.0, 1: 1.0}
    near = maps.window_keyframes(spark.createDataFrame([(0, 5)], "s int, frame_idx long"), spark.createDataFrame([(0, 5), (0, 6), (0, 6)], "s int, kf long"), "s")
    assert [r.kf for r in near.collect()] == [6]


@pytest.mark.parametrize("lower", [False, True])
def test_quantiles_by_counting(spark, monkeypatch, lower):
    monkeypatch.setattr(quantiles, "HELD", 50)
    monkeypatch.setattr(quantiles, "LAST", 8)
    monkeypatch.setattr(quantiles, "BINS", 4)
    rng = np.random.default_rng(1)
    x = {"a": rng.normal(size=1500), "b": np.repeat([1.0, 2.0, 3.0], 100), "c": rng.exponential(size=30), "d": np.full(70, 5.0)}
    rows = [(k, float(v) if i % 11 else None) for k, own in x.items() for i, v in enumerate(own)] + [(None, float(i)) for i in range(100)]
    table = spark.createDataFrame(rows, "k string, x double").repartition(5)
    p = [0.01, 0.1, 0.5, 0.9, 1.0]
    got = {r.k: (r.x, r.y) for r in quantiles.quantiles(table, ["k"], {"x": F.col("x"), "y": -F.col("x")}, p, lower).collect()}
    assert set(got) == {*x, None}
    for k in got:
        own = np.sort([v for key, v in rows if key == k and v is not None])
        for values, shown in zip((own, np.sort(-own)), got[k], strict=True):
            want = [values[max(int(np.ceil(q * len(values) - 1e-12)) - 1, 0)] for q in p] if lower else np.quantile(values, p)
            assert np.allclose(shown, want), (k, shown, want)
    whole = np.array([v for _, v in rows if v is not None])
    assert np.allclose(quantiles.quantiles(table, [], {"x": F.col("x")}, [0.25, 0.99]).first().x, np.quantile(whole, [0.25, 0.99]))


@pytest.mark.parametrize("momentum", [0.0, 0.5, 0.9, 0.999])
def test_ema_of_long_streams(spark, momentum):
    rng = np.random.default_rng(3)
    rows = [(s, i, float(v) if rng.random() > 0.1 else None) for s in (1, None) for i, v in enumerate(rng.normal(size=5000))]
    out = windows.ema(spark.createDataFrame(rows, "s int, i int, x double"), "s", ["i"], "x", momentum).collect()
    got = {(r.s, r.i): r.ema for r in out}
    for s in (1, None):
        now = None
        for i, x in [(i, x) for k, i, x in rows if k == s]:
            now = now if x is None else x if now is None else momentum * now + (1 - momentum) * x
            assert (got[s, i] is None) == (now is None) and (now is None or abs(got[s, i] - now) < 1e-9), (s, i)


def test_ema_meets_blocks_only(spark):
    plan = windows.ema(spark.range(10).selectExpr("id % 2 as s", "id as i", "id * 1.0 as x"), "s", ["i"], "x", 0.9)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan


def test_knn_of_crowds(spark):
    """A dense crowd beside far points: equal to all pairs, from a width that keeps cells small."""
    rng = np.random.default_rng(6)
    p = np.concatenate((rng.normal(size=(1500, 2)) * 1e-3, rng.uniform(-50, 50, (40, 2))))
    q = np.concatenate((p[:60] + 1e-4, rng.uniform(-60, 60, (20, 2))))
    points = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(p)], "p long, x double, y double")
    asked = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(q)], "q long, x double, y double")
    got = joins.knn(asked, points, [], ["x", "y"], 3, None, "q", "p").collect()
    d = ((q[:, None] - p[None]) ** 2).sum(-1)
    assert len(got) == 240 and all(np.isclose(r.d2, np.sort(d[r.q])[r["rank"] - 1], rtol=1e-9, atol=1e-18) for r in got)
    near = align.median_nearest(asked, points, [], ["x", "y"], "q", "p").first()
    assert np.isclose(near.median, np.median(np.sqrt(d.min(axis=1))))


def test_sampling_patterns(spark):
    rows = [(k, v, u, float((v * 7 + u * 11 + k) % 17)) for k in (0, 1) for v in range(60) for u in range(80)]
    table = spark.createDataFrame(rows, "k int, v int, u int, depth double")
    measured = {(k, v, u) for k, v, u, z in rows if z > 0}
    at = lambda df: [(r.k, r.v, r.u) for r in df.collect()]
    drawn = at(pixels.sparse_sample(table, "100", keys=["k"]))
    assert len(drawn) == 200 and set(drawn) <= measured and drawn != at(pixels.sparse_sample(table, "100", keys=["k"], seed=1))
    cube = pixels.sparse_sample(table, "cubic_20", width=80, height=60, keys=["k"]).collect()
    for k in (0, 1):
        own = {(r.v, r.u) for r in cube if r.k == k}
        assert len(own) == 2000 and all(r.cover for r in cube)
        # Some square of 20 by 20 holds no pixel.
        held = np.zeros((60, 80), bool)
        held[tuple(np.array(list(own)).T)] = True
        assert any(not held[a : a + 20, b : b + 20].any() for a in range(40) for b in range(60))
    range_ = pixels.sparse_sample(table, "distance_3_6", keys=["k"]).collect()
    assert {r.depth for r in range_} == {4.0, 5.0} and len(range_) == sum(z in (4.0, 5.0) for *_, z in rows)
    low = pixels.sparse_sample(table, "downscale_10", width=80, height=60, keys=["k"]).collect()
    assert {(r.v, r.u) for r in low} <= {(v, u) for v in range(0, 60, 10) for u in range(0, 80, 10)} and all(r.depth > 0 for r in low)
    keypoints = spark.createDataFrame([(0, float(u) + 0.3, 5.0) for u in range(30)] + [(1, 1.0, 1.0)], "k int, x double, y double")
    seen = pixels.sparse_sample(table, "keypoints", keys=["k"], keypoints=keypoints).collect()
    assert {(r.v, r.u) for r in seen if r.k == 0} == {(5, u) for u in range(30) if (0, 5, u) in measured} and sum(r.k == 1 for r in seen) == 2000
    # The scanner's pixels, point by point.
    want = set()
    for p in np.linspace(-0.5, 0.5, 4):
        for w in np.linspace(-np.pi / 2.1, np.pi / 2.1, 200):
            x, y = np.cos(p) * np.sin(w), np.sin(p)
            z = np.sqrt(1 - x * x - y * y)
            u, v = int(np.round((60 * x + 40 * z) / (z + 1e-8))), int(np.round((60 * y + 30 * z) / (z + 1e-8)))
            if 0 <= u < 80 and 0 <= v < 60:
                want.add((v, u))
    assert {(r.v, r.u) for r in pixels.lidar_pixels(spark, 4, 80, 60).collect()} == want


def test_track_targets(spark):
    seen = spark.createDataFrame([(0, 0, 1, 16.0, 16.0), (0, 1, 1, 24.0, 8.0), (0, 0, 2, 60.0, 60.0)], "view int, frame int, point int, x double, y double")
    terms = spark.createDataFrame([(7, 0, 0, 1), (8, 0, 1, 0)], "term int, view int, source int, target int")
    got = {(r.term, r.v, r.u): (r.target_u, r.target_v, r.weight) for r in joins.track_targets(seen, terms, (64, 64), (8, 8)).collect()}
    assert len(got) == 128 and got[7, 2, 2] == (3.0, 1.0, 1.0) and got[7, 0, 0] == (0.0, 0.0, 0.0) and got[8, 1, 3] == (2.0, 2.0, 1.0)


def test_prefetch():
    made = []

    def items():
        for i in range(40):
            made.append(i)
            yield i

    run = models.prefetched(items(), ahead=4)
    assert next(run) == 0
    time.sleep(0.3)
    assert 2 <= len(made) <= 7
    assert list(run) == list(range(1, 40))

    def broken():
        yield 1
        raise RuntimeError("no more")

    run = models.prefetched(broken())
    assert next(run) == 1
    with pytest.raises(RuntimeError):
        next(run)


def test_cache_warns_of_short_streams(spark):
    with pytest.warns(UserWarning):
        kept, n = models.cached(spark.range(3), expected=5)
    assert n == 3 and kept.unpersist()


def test_schema_of_configurations():
    s = config.schema()
    assert json.loads(json.dumps(s)) == s and s["properties"]["pipeline"]["properties"]["slam"]["properties"]["buffer"] == {"type": "integer", "default": 1024}
    assert s["additionalProperties"] is False


def test_streams_leave_the_driver_alone(spark, tmp_path):
    """Results of streams are tables in the checkpoint folder, and silent streams may time out."""
    spark.createDataFrame([(1, i, float(i % 3)) for i in range(9)], "s long, i long, x double").write.parquet(str(tmp_path / "in"))
    rows = spark.readStream.schema("s long, i long, x double").parquet(str(tmp_path / "in"))
    assert folds.keyframes(rows, "s", ["i"], "x", 1.5, ttl="1 hour").isStreaming
    out = folds.drain(folds.keyframes(rows, "s", ["i"], "x", 1.5), f"t{time.time_ns()}")
    assert sorted(r.i for r in out.collect()) == [0, 2, 3, 5, 6, 8]
    assert not [t for t in spark.catalog.listTables() if t.isTemporary and t.name.startswith("t")]
    assert len(out.inputFiles()) >= 1


def test_new_objects_ranks_few_rows(spark):
    segments = spark.range(4000).selectExpr("id as v", "0 as u", "id % 400 as segment")
    out = joins.new_objects(segments, segments.where("false").select("v", "u"), ["v", "u"], "segment", least_area=1)
    assert [r.segment for r in out.orderBy("object_id").collect()] == list(range(255))
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString() or "GlobalLimit" in out._jdf.queryExecution().optimizedPlan().toString()


def _image(spark, w=9, h=7):
    rng = np.random.default_rng(8)
    x = rng.uniform(0, 1, (h, w))
    return x, spark.createDataFrame([(0, v, u, float(x[v, u]), (v * u) % 5, bool(x[v, u] > 0.3)) for v in range(h) for u in range(w)], "k int, v int, u int, x double, label int, ok boolean")


def test_resized(spark):
    x, rows = _image(spark)
    out = rasters.resized(rows, ["k"], (9, 7), (5, 4), ["x"], ["label"], ["ok"]).collect()
    assert len(out) == 20
    for r in out:
        sy, sx = max((r.v + 0.5) * 7 / 4 - 0.5, 0), max((r.u + 0.5) * 9 / 5 - 0.5, 0)
        y0, x0 = int(sy), int(sx)
        y1, x1 = min(y0 + 1, 6), min(x0 + 1, 8)
        mix = lambda m: (m[y0, x0] * (1 - (sx - x0)) + m[y0, x1] * (sx - x0)) * (1 - (sy - y0)) + (m[y1, x0] * (1 - (sx - x0)) + m[y1, x1] * (sx - x0)) * (sy - y0)  # noqa: E731, B023
        assert np.isclose(r.x, mix(x)) and r.ok == (mix((x > 0.3).astype(float)) > 0.9)
        assert r.label == int(r.v * 7 / 4) * int(r.u * 9 / 5) % 5


def test_views(spark):
    x, rows = _image(spark)
    grid = camera.pixel_grid(spark, 9, 7).select("v", "u")
    same = camera.Pinhole(*map(F.lit, (5.0, 5.0, 4.0, 3.0)))
    at = rasters.rectification(grid, same, same)
    assert all(np.isclose(r.x, r.u - 0.5) and np.isclose(r.y, r.v - 0.5) for r in at.collect())
    mei = camera.Mei(*map(F.lit, (5.0, 5.0, 4.0, 3.0, 0.3)))
    there = rasters.rectification(grid, mei, mei.pinhole()).withColumn("k", F.lit(0))
    seen = rasters.sampled(rows, there, ["k"], "x", "y", 9, 7, nearest=["label"]).collect()
    assert len(seen) == 63
    view = rasters.panorama_view(rows, ["k"], (9, 7), (4, 4), 2.0, (F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)), ["x"], ["label"]).collect()
    assert len(view) == 16 and all(0 <= r.x <= 1 and r.label is not None for r in view)


def test_reprojected(spark):
    """Moved by one pixel, the frame is seen one pixel further; of two depths on one pixel the near one wins."""
    rows = spark.createDataFrame([(0, v, u, 2.0, float(u)) for v in range(4) for u in range(6)], "k int, v int, u int, z double, x double")
    cam = camera.Pinhole(*map(F.lit, (4.0, 4.0, 3.0, 2.0)))
    shown = camera.Pinhole(*map(F.lit, (4.0, 4.0, 3.5, 2.5)))
    move = lie.SE3((F.lit(0.5), F.lit(0.0), F.lit(0.0)), lie.SE3.identity().q)
    got = {(r.v, r.u): r.x for r in rasters.reprojected(rows, ["k"], "z", ["x"], move, cam, shown, 6, 4).collect()}
    assert all(np.isclose(got[v, u], u - 1, atol=1e-4) for v in range(4) for u in range(1, 6))
    two = spark.createDataFrame([(0, 2, 3, 1.0, 1.0), (0, 2, 3, 9.0, 5.0)], "k int, v int, u int, z double, x double")
    near = rasters.reprojected(two, ["k"], "z", ["x"], lie.SE3.identity(), cam, shown, 6, 4).collect()
    assert all(abs(r.x - 1) < 1e-3 for r in near)


def test_fit_mei():
    k, f = calibrate.fit_mei(lambda r: 1.7 / (1 + 0.4 * np.sqrt(1 + r * r)))
    assert np.isclose(k, 0.4, atol=1e-6) and np.isclose(f, 1.7, atol=1e-6)


def test_pose_average_and_scale(spark):
    rng = np.random.default_rng(1)
    q = rng.normal(size=4) * 0.01 + [0, 0, 0, 1]
    q /= np.linalg.norm(q)
    frame = spark.createDataFrame([(0, float(i), 1.0, 2.0, *map(float, q * (-1) ** i)) for i in range(4)], "k int, tx double, ty double, tz double, qx double, qy double, qz double, qw double")
    r = align.pose_average(frame, ["k"], ["tx", "ty", "tz"], ["qx", "qy", "qz", "qw"]).first()
    assert r.tx == 1.5 and np.allclose([r.qx, r.qy, r.qz, r.qw], q)
    cams = [(k, i, *map(float, p), *map(float, 2 * p)) for k, n in ((0, 12), (1, 5)) for i, p in enumerate(rng.normal(size=(n, 3)))]
    cameras = spark.createDataFrame(cams, "k int, n long, sx double, sy double, sz double, tx double, ty double, tz double")
    depths = spark.createDataFrame([(0, 4.0), (1, 6.0)], "k int, z double")
    assert {r.k: round(r.z, 4) for r in align.depth_to_input(depths, cameras, ["k"], "n", ["sx", "sy", "sz"], ["tx", "ty", "tz"], "z").collect()} == {0: 2.0, 1: 3.0}


def test_artifacts_return(spark, tmp_path):
    poses = spark.createDataFrame([(0, 0, 1.0), (1, 0, 2.0)], "view int, inds long, tx double")
    artifacts.save_intermediate(poses, poses, poses, poses.drop("view"), str(tmp_path / "a"), 1, {"done": "yes"})
    assert [r.tx for r in spark.read.parquet(str(tmp_path / "a/pose")).collect()] == [2.0]
    assert {r.name: r.value for r in spark.read.parquet(str(tmp_path / "a/flags")).collect()} == {"view": "1", "done": "yes"}
    points = spark.createDataFrame([("s", 1.0)], "stream_id string, x double")
    artifacts.save_map(points, str(tmp_path / "map"))
    poses.write.parquet(str(tmp_path / "edges"))
    got, edges = artifacts.load_map(spark, str(tmp_path / "map"), str(tmp_path / "edges"))
    assert got.first().x == 1.0 and edges.count() == 2
    artifacts.save_depth(spark.createDataFrame([("s", 0, 1.00049), ("s", 1, None)], "stream_id string, frame_idx long, depth double"), str(tmp_path / "depth"))
    assert [r.depth for r in spark.read.parquet(str(tmp_path / "depth")).collect()] == [float(np.float16(1.00049))]


def test_benchmark_poses(spark, tmp_path):
    from tessella.sources import frames

    np.savez(tmp_path / "one.npz", inds=np.arange(2), data=np.stack([np.eye(4)] * 2), runtime=1.5, keyframe_ids=np.array([0, 1]))
    rows = frames.pose_arrays(spark, str(tmp_path), benchmark=True).orderBy("inds").collect()
    assert [(r.stream_id, r.inds, r.runtime, r.keyframe_ids, r.frame_num, r.qw) for r in rows] == [("one", i, 1.5, [0, 1], None, 1.0) for i in range(2)]


def test_camera_forms(spark):
    cam = camera.Pinhole(*map(F.lit, (50.0, 60.0, 32.0, 24.0)))
    k = F.lit(0.2)
    for model in ("pinhole", "divisional", "mei"):
        u, v, seen = camera.world_to_image((F.lit(0.1), F.lit(-0.2), F.lit(1.0)), cam, model, k)
        x, y = camera.image_to_world(u, v, cam, model, k)
        r = spark.range(1).select(x, y, seen).first()
        assert np.allclose(r[:2], (0.1, -0.2), atol=2e-2 if model == "divisional" else 1e-9) and r[2]
    u, v, seen = camera.display_pixels((F.lit(0.1), F.lit(-0.2), F.lit(1.0)), cam, 64, 48)
    assert tuple(spark.range(1).select(u, v, seen).first()) == (36, 12, True)
    x, y, p = np.array([0.3]), np.array([-0.2]), np.array([0.1, 0.2, np.log(500.0)])
    at = (x * 500 + 320, y * 500 + 240)
    h = 1e-6
    want = [((calibrate.fields(p + h * e, *at, (640.0, 480.0)) - calibrate.fields(p - h * e, *at, (640.0, 480.0))) / (2 * h))[0] for e in np.eye(3)]
    got = camera.field_jacobian(F.lit(0.3), F.lit(-0.2), F.lit(500.0), F.lit(0.1), F.lit(0.2))
    assert all(np.allclose(tuple(spark.range(1).select(*g).first()), w, atol=1e-6) for g, w in zip(got, want, strict=True))


def test_small_forms(spark):
    from tessella.functions import robust

    poses = spark.range(200).select(*lie.SE3.random(0.5, seed=3).columns())
    r = poses.select(F.stddev("tx"), F.min(F.sqrt(F.col("qx") ** 2 + F.col("qy") ** 2 + F.col("qz") ** 2 + F.col("qw") ** 2))).first()
    assert 0.3 < r[0] < 0.8 and np.isclose(r[1], 1)
    assert spark.range(1).select(robust.retracted("dense_disp", F.lit(1.0), F.lit(0.5))).first()[0] == 1.5
    with pytest.raises(ValueError):
        robust.retracted("colour", F.lit(1.0))
    rows = spark.createDataFrame([(0, i) for i in range(7)], "s int, n long")
    assert [(r.chunk, r.full) for r in windows.chunks(rows, "s", "n", 3).orderBy("n").collect()] == [(0, True)] * 3 + [(1, True)] * 3 + [(2, False)]
    assert sorted(r.n for r in windows.with_last(rows.where("n in (0, 3)"), rows, "s", "n").collect()) == [0, 3, 6]
    near = spark.createDataFrame([(0, 2.0, 1.0), (0, 1.0, 1.0), (0, 1.5, 1.0)], "k int, a double, b double")
    assert sorted(r[0] for r in near.select(align.completion_uncertainty(F.col("a"), F.col("b"), ["k"])).collect()) == [0.0, 0.5, 1.0]


def test_pipeline_of_steps(spark):
    class Twice(models.Processor):
        def rows(self, frames, number_of_pass):
            return frames.withColumn("x", F.col("x") * 2)

    frames = spark.createDataFrame([(1, 1.0), (2, 2.0)], "stream int, x double")
    with pytest.raises(ValueError):
        models.Pipeline([], return_payload=True, return_frames=True)
    out = models.Pipeline([Twice()], return_frames=True, should_filter=lambda s: s.where("stream = 2")).run(frames)
    assert [tuple(r) for r in out.collect()] == [(1, 2.0)]
    assert models.Pipeline([Twice()], payload=lambda f: f.count(), return_payload=True).run(frames) == 2
    assert models.Pipeline([Twice()]).run(frames) is None
