"""Models that the caller brings: a registry, and a column function that loads each once for a worker."""

from __future__ import annotations

import queue
import threading
from collections.abc import Callable, Iterator
from typing import TypeVar

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What a depth model's values mean, and so how their scale may be fixed.
DEPTH_TYPES = ("METRIC_DEPTH", "MODEL_METRIC_DEPTH", "MODEL_METRIC_DISTANCE", "AFFINE_DISP")
_makers: dict[str, tuple[str, Callable[[], Callable[[pd.Series], pd.Series]]]] = {}
_loaded: dict[str, Callable[[pd.Series], pd.Series]] = {}


def register(name: str, depth_type: str, make: Callable[[], Callable[[pd.Series], pd.Series]]) -> None:
    """make() builds the model; it runs once for a worker."""
    if depth_type not in DEPTH_TYPES:
        raise ValueError(f"no depth type {depth_type!r}")
    _makers[name] = (depth_type, make)


def depth_type(name: str) -> str:
    return _maker(name)[0]


def _maker(name: str):
    if name not in _makers:
        raise ValueError(f"no model {name!r}; one of {', '.join(sorted(_makers)) or 'none'}")
    return _makers[name]


def estimate(name: str, value: Column) -> Column:
    """The model's array for each value, in Arrow batches."""
    make = _maker(name)[1]

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if name not in _loaded:
            _loaded[name] = make()
        for batch in batches:
            yield _loaded[name](batch)

    return run(value)


T_ = TypeVar("T_")


def prefetched(items: Iterator[T_], ahead: int = 16) -> Iterator[T_]:
    """Items in order, made by a thread that is up to ahead items in front; its errors appear where its next item would.

    For the inside of mapInPandas and mapInArrow, where reading and a model's work then overlap.
    """
    end = object()
    room: queue.Queue = queue.Queue(maxsize=max(1, ahead))
    stop = threading.Event()

    def put(x) -> bool:
        while not stop.is_set():
            try:
                room.put(x, timeout=0.1)
                return True
            except queue.Full:
                continue
        return False

    def make() -> None:
        try:
            for x in items:
                if not put((None, x)):
                    return
            put((None, end))
        except BaseException as e:  # handed to the reader
            put((e, None))

    threading.Thread(target=make, daemon=True).start()
    try:
        while True:
            error, x = room.get()
            if error is not None:
                raise error
            if x is end:
                return
            yield x
    finally:
        stop.set()


def cached(frames: DataFrame, expected: int | None = None) -> tuple[DataFrame, int]:
    """Frames kept for repeated passes and their number; fewer than expected shorten the stream, with a warning."""
    import warnings

    kept = frames.persist()
    n = kept.count()
    if expected is not None and n < expected:
        warnings.warn(f"the stream ends after {n} of {expected} frames", stacklevel=2)
    return kept, n


class Processor:
    """A step of a frame pipeline: what it does to rows, and to the rate and the columns of the stream."""

    passes = 1
    adds: tuple[str, ...] = ()

    def fps(self, fps: float) -> float:
        return fps

    def columns(self, columns: list[str]) -> list[str]:
        return [*columns, *[c for c in self.adds if c not in columns]]

    def rows(self, frames: DataFrame, number_of_pass: int) -> DataFrame:
        raise NotImplementedError


def run(frames: DataFrame, steps: list[Processor]) -> DataFrame:
    """Frames through all steps, as often as the most demanding step asks; lineage stays lazy."""
    out = frames
    for n in range(max([1, *[s.passes for s in steps]])):
        out = frames if n else out
        for s in steps:
            out = s.rows(out, min(n, s.passes - 1))
    return out


class Pipeline:
    """Steps over the frames of many streams; what is wanted back is one of the payload and the frames.

    should_filter(stream table) names streams to leave out, as rows of ``stream``.
    """

    def __init__(self, steps: list[Processor], payload: Callable[[DataFrame], object] | None = None, return_payload: bool = False, return_frames: bool = False, should_filter: Callable[[DataFrame], DataFrame] | None = None):
        if return_payload and return_frames:
            raise ValueError("either the payload or the frames are returned")
        self.steps, self.payload, self.return_payload, self.return_frames, self.should_filter = steps, payload, return_payload, return_frames, should_filter

    def run(self, frames: DataFrame, stream: str = "stream"):
        if self.should_filter is not None:
            gone = self.should_filter(frames.select(stream).distinct()).select(stream)
            frames = frames.join(gone, stream, "left_anti")
        out = run(frames, self.steps)
        if self.return_payload:
            return self.payload(out) if self.payload else None
        return out if self.return_frames else None
