"""Terms of an adjustment: residual rows with derivatives, for the caller to add to, weigh and solve.

A term names its variables and gives rows as ``bundle.residuals`` does; any
object with ``names``, ``points`` and ``rows`` can take part in ``solve``. The
points of different terms are kept apart by a number in front of their place.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Protocol

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.lineage import cut
from tessella.operators import bundle

Kernel = Callable[[Column], Column]


class Term(Protocol):
    def names(self) -> set[str]: ...

    def points(self) -> DataFrame:
        """frame_idx, v, u, x, y, disp, disp_sensor of the points whose disparities the term moves."""
        ...

    def rows(self, points: DataFrame, poses: DataFrame, k: tuple) -> DataFrame: ...


@dataclass
class DenseFlow:
    """Every pixel of i is seen at its target in j."""

    pixels: DataFrame
    edges: DataFrame
    targets: DataFrame
    kernel: Kernel | None = None

    def names(self) -> set[str]:
        return {"pose", "dense_disp"}

    def points(self) -> DataFrame:
        return self.pixels.select("frame_idx", "v", "u", F.col("u").cast("double").alias("x"), F.col("v").cast("double").alias("y"), "disp", "disp_sensor")

    def rows(self, points: DataFrame, poses: DataFrame, k: tuple) -> DataFrame:
        rows = bundle.residuals(points, self.targets, self.edges, poses, k)
        return rows if self.kernel is None else rows.withColumns({f"w{c}": F.col(f"w{c}") * self.kernel(F.col(f"r{c}")) for c in "uv"})


@dataclass
class TrackFlow(DenseFlow):
    """Tracked points, each with a disparity of its own, are seen at their places in other frames.

    pixels: frame_idx, point, x, y, disp; targets: edge_id, point, target_u, target_v, weight_u, weight_v.
    """

    def names(self) -> set[str]:
        return {"pose", "tracks_disp"}

    def points(self) -> DataFrame:
        return self.pixels.select("frame_idx", F.lit(0).alias("v"), F.col("point").alias("u"), "x", "y", "disp", F.lit(0.0).alias("disp_sensor"))

    def rows(self, points: DataFrame, poses: DataFrame, k: tuple) -> DataFrame:
        own = self.targets.withColumn("v", F.lit(0)).withColumnRenamed("point", "u")
        return DenseFlow(self.pixels, self.edges, own, self.kernel).rows(points, poses, k)


_ROW = ["edge_id", "i", "j", "v", "u", "ru", "rv", "wu", "wv", "du", "dv", *[f"a{s}{m}{c}" for s in "ij" for m in range(6) for c in "uv"]]


def solve(terms: list[Term], poses: dict[int, tuple], k: tuple, free: list[int], iterations: int = 1, damping: float = 1e-3, eps: float = 0.1, alpha: float = 0.001, eta: float = 0.1, motion_only: bool = False) -> tuple[dict[int, np.ndarray], list[DataFrame], list[float]]:
    """Gauss-Newton steps over all terms together: poses, each term's points with new disparities, and the energy before each step."""
    now = {f: np.asarray(p, float) for f, p in poses.items()}
    width = 1 << 20  # rows of a raster that a term may have
    points = None
    for n, t in enumerate(terms):
        own = t.points().withColumn("v", F.col("v") + n * width)
        points = own if points is None else points.unionByName(own)
    energies = []
    for _ in range(iterations):
        table, every = bundle._poses(points.sparkSession, now), None
        for n, t in enumerate(terms):
            mine = points.where((F.col("v") >= n * width) & (F.col("v") < (n + 1) * width)).withColumn("v", F.col("v") - n * width)
            rows = t.rows(mine, table, k).select(*_ROW).withColumn("v", F.col("v") + n * width).withColumn("edge_id", F.col("edge_id") * len(terms) + n)
            every = rows if every is None else every.unionByName(rows)
        every = every.persist()
        energies.append(bundle.energy(every))
        steps, moved = bundle.step(points, every, free, damping, eps, alpha, eta, motion_only)
        points = points if moved is points else cut(moved)
        every.unpersist()
        for f, x in steps.items():
            now[f] = bundle.retract(now[f], x)
    split = [points.where((F.col("v") >= n * width) & (F.col("v") < (n + 1) * width)).withColumn("v", F.col("v") - n * width) for n in range(len(terms))]
    return now, split, energies
