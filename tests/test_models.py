import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessella import models
from tessella.operators import calibrate, pixels
from tessella.sources import frames


def test_pose_arrays(spark, tmp_path):
    m = np.stack([np.eye(4), np.eye(4)])
    m[1, :3, :3] = [[0, -1, 0], [1, 0, 0], [0, 0, 1]]
    m[1, :3, 3] = [1, 2, 3]
    np.savez(tmp_path / "clip.npz", inds=np.array([0, 5]), data=m)
    rows = {r.inds: r for r in frames.pose_arrays(spark, str(tmp_path)).collect()}
    assert rows[0].stream_id == "clip" and rows[0].qw == 1
    assert np.allclose(tuple(rows[5])[2:], (1, 2, 3, 0, 0, np.sqrt(0.5), np.sqrt(0.5)))


def test_model_registry(spark):
    def make():
        return lambda values: values.map(lambda x: [2.0 * x, 1.0])

    models.register("double", "METRIC_DEPTH", make)
    with pytest.raises(ValueError):
        models.register("bad", "FEET", make)
    with pytest.raises(ValueError):
        models.depth_type("missing")
    got = pd.Series([1.0, 2.0]).map(lambda x: [2.0 * x, 1.0]).tolist()
    assert make()(pd.Series([1.0, 2.0])).tolist() == got and models.depth_type("double") == "METRIC_DEPTH"

    class Twice(models.Processor):
        passes = 2
        adds = ("x",)

        def rows(self, df, number):
            return df.withColumn("x", F.lit(number))

    assert models.run(spark.range(2), [Twice()]).first().x == 1 and Twice().columns(["id"]) == ["id", "x"]


def test_calibration():
    x, y = (a.ravel() for a in np.meshgrid(np.arange(0, 640, 40.0), np.arange(0, 480, 40.0)))
    seen = calibrate.fields(np.array([0.2, -0.1, np.log(600.0)]), x, y, (640.0, 480.0))
    seen[::17] += 1.0  # outliers
    p, cov, _ = calibrate.solve(x, y, seen, np.ones(len(x)), (640.0, 480.0))
    assert np.allclose(p, [0.2, -0.1, np.log(600.0)], atol=0.05) and (np.diag(cov) > 0).all()
    assert (calibrate.damped_step(-np.eye(2) * 9, np.ones(2), 0.1) == 0).all()


def test_pixels(spark):
    rows = spark.createDataFrame([(0, 0, 0, 1), (0, 0, 1, 2), (1, 0, 0, 1)], "frame_idx int, v int, u int, instance int")
    names = spark.createDataFrame([(0, 1, "sky"), (1, 1, "tree"), (0, 2, "car")], "frame_idx int, instance int, phrase string")
    assert {(r.frame_idx, r.u): r.sky for r in pixels.sky(rows, names, ["frame_idx"]).collect()} == {(0, 0): True, (0, 1): False, (1, 0): False}
    with pytest.raises(ValueError):
        pixels.sparse_sample(rows, "sift")
    assert pixels.sparse_sample(rows, "2").count() == 2
