"""Connected components of a distributed edge list by repeated contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm import scratch

#: Links that one task joins at most; its arrays take some 100 bytes a link.
ONE_TASK = 1 << 19


def joined(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids that occur in links (a, b), and the smallest id that each reaches."""
    ids, place = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = place[: len(a)], place[len(a) :]
    root = np.arange(len(ids))
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        a, b = a[apart], b[apart]
        np.minimum.at(root, high[apart], low[apart])
        while len(a) and not np.array_equal(up := root[root], root):
            root = up
    return ids, ids[root]


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [(np.asarray(batch.column("a")), np.asarray(batch.column("b"))) for batch in batches]
    if held:
        ids, component = joined(*map(np.concatenate, zip(*held, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(component)], ["id", "component"])


def components(links: DataFrame) -> DataFrame:
    """For each id that occurs in links (a, b): id and component, the smallest id it reaches.

    Each round points every node at its smallest neighbour, follows the
    pointers to their roots by doubling, and keeps only the links between
    different roots. Tables are written between rounds; nothing is collected
    but counts. A node with very many links meets them in partial minima and
    in joins that adaptive execution can split. Once ONE_TASK links are left
    at most, one task joins them all, which spares the driver the rounds' plans.
    """
    links = scratch.materialize(links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b").distinct(), "links")
    label = None  # id -> component so far
    while True:
        left = links.count()
        if label is not None and not left:
            return label
        if left <= ONE_TASK:
            last = scratch.materialize(links.coalesce(1).transform(scratch.arrow, _joined, "id long, component long"), "labels")
            return last if label is None else _moved(label, last)
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("up"))
        parent = scratch.materialize(parent, "parents")
        while True:
            above = parent.select(F.col("id").alias("up"), F.col("up").alias("top"))
            doubled = scratch.materialize(parent.join(above, "up").select("id", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")), "parents")
            parent = doubled.select("id", "up")
            if not doubled.where("moved").limit(1).count():
                break
        if label is None:
            label = parent.select("id", F.col("up").alias("component"))
        else:
            label = _moved(label, parent.select("id", F.col("up").alias("component")))
        ups = parent.select(F.col("id").alias("a"), F.col("up").alias("ua"))
        links = links.join(ups, "a").join(ups.select(F.col("a").alias("b"), F.col("ua").alias("ub")), "b")
        links = scratch.materialize(links.where("ua <> ub").select(F.col("ua").alias("a"), F.col("ub").alias("b")).distinct(), "links")


def _moved(label: DataFrame, step: DataFrame) -> DataFrame:
    """label (id, component), whose components have become those of step (id, component)."""
    step = step.select(F.col("id").alias("component"), F.col("component").alias("up"))
    return scratch.materialize(label.join(step, "component", "left").select("id", F.coalesce("up", "component").alias("component")), "labels")
