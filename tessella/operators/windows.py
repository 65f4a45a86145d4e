"""Ordered analytics over streams: windows with overlap, folds, trajectories."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.operators.quantiles import quantiles


def overlapping(rows: DataFrame, number: str, length: Column, window: int, overlap: int) -> DataFrame:
    """Each row in every window that holds it: window_no, place, and weight, the cross-faded share of its value.

    number counts a stream from 0; length is the stream's. Windows begin every
    window - overlap rows; the last is the first that reaches the end. Over
    the overlap of two windows the later one's weight rises by even steps.
    """
    step = window - overlap
    n = F.col(number)
    last = F.greatest(F.ceil((length - window) / step), F.lit(0)).cast("long")
    newest = F.least(F.floor(n / step), last)
    oldest = F.greatest(F.ceil((n - window + 1) / step), F.lit(0)).cast("long")
    out = rows.withColumn("window_no", F.explode(F.sequence(oldest, newest)))
    place = n - F.col("window_no") * step
    head = F.when((F.col("window_no") > 0) & (place < overlap), (place + 1) / float(overlap + 1)).otherwise(1.0)
    tail_place = place - step
    tail = F.when((F.col("window_no") < last) & (tail_place >= 0), 1 - (tail_place + 1) / float(overlap + 1)).otherwise(1.0)
    return out.withColumns({"place": place, "weight": F.when(head < 1, head).otherwise(tail)})


def cross_faded(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Values of overlapping windows put together by their weights."""
    return rows.groupBy(*keys).agg((F.sum(F.col(value) * F.col("weight")) / F.sum("weight")).alias(value))


#: Rows of a stream that are folded by one window sum, and the deepest nesting of such blocks.
_BLOCK, _LEVELS = 64, 5


def _decayed(rows: DataFrame, stream: str, number: str, value: str, momentum: float, level: int = 0) -> DataFrame:
    """rows with s, where s <- momentum * s + value in the order of number, which counts from 0 without gaps."""
    w = Window.partitionBy(stream).orderBy(number)
    if momentum ** (_BLOCK - 1) < 1e-150 or level == _LEVELS:
        # What lies further back has no share left.
        back = sum((momentum**k * F.coalesce(F.lag(value, k).over(w), F.lit(0.0)) for k in range(1, 9)), F.col(value))
        return rows.withColumn("s", back)
    b, own, end = f"_b{level}", f"_own{level}", f"_end{level}"
    at = F.col(number) % _BLOCK
    inner = Window.partitionBy(stream, b).orderBy(number).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn(b, F.floor(F.col(number) / _BLOCK))
    rows = rows.withColumn(own, F.sum(F.col(value) * F.pow(F.lit(momentum), -at)).over(inner) * F.pow(F.lit(momentum), at))
    # The sums at the ends of blocks are a shorter series of the same kind, with the momentum of a whole block.
    ends = rows.groupBy(stream, b).agg(F.max_by(own, number).alias(end))
    ends = _decayed(ends, stream, b, end, momentum**_BLOCK, level + 1)
    ends = ends.select(F.col(stream).alias("_of"), (F.col(b) + 1).alias("_next"), F.col("s").alias("_carry"))
    rows = rows.join(ends, F.col(stream).eqNullSafe(F.col("_of")) & (F.col(b) == F.col("_next")), "left")
    return rows.withColumn("s", F.col(own) + F.coalesce("_carry", F.lit(0.0)) * F.pow(F.lit(momentum), at + 1)).drop(b, own, "_of", "_next", "_carry")


def ema(rows: DataFrame, stream: str, order: list[str], value: str, momentum: float) -> DataFrame:
    """s <- m * s + (1 - m) * x in order, seeded by the first value; nulls keep s.

    A window sum over a block of rows, weighted by powers of the momentum; the
    blocks' ends are folded the same way, level by level, so no row meets more
    than a block and the time is linear in the stream's length.
    """
    w = Window.partitionBy(stream).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = F.sum(F.when(F.col(value).isNotNull(), 1).otherwise(0)).over(w)
    k = rows.withColumn("_k", seen)
    some = k.where(F.col(value).isNotNull()).select(F.col(stream).alias("_stream"), (F.col("_k") - 1).alias("_i"), F.when(F.col("_k") == 1, F.col(value)).otherwise((1 - momentum) * F.col(value)).alias("_x"))
    folded = _decayed(some, "_stream", "_i", "_x", momentum).select("_stream", (F.col("_i") + 1).alias("_at"), F.col("s").alias("ema"))
    return k.join(folded, F.col(stream).eqNullSafe(F.col("_stream")) & (F.col("_k") == F.col("_at")), "left").drop("_k", "_stream", "_at")


def stitched(rows: DataFrame, stream: str, pixel: list[str], value: str, length: int = 32, overlap: int = 10, blend: int = 8, anchors: tuple[int, int] = (0, 12)) -> DataFrame:
    """Predictions of overlapping windows as one series: stream, frame_idx, pixel, value.

    rows (stream, window_no, place, pixel, value), a window every length -
    overlap frames. The first overlap - blend frames of a window repeat two
    frames: the first window's first and the last window's at the second
    anchor. A least squares line takes them to those two, the second as it was
    fitted itself, so scales chain from window to window. Fitted values stay
    at 0 or above; over the next blend frames the new window fades in, from a
    weight of 0 to 1.

    Sums of each window's pixels come from Spark; a chain folds six numbers a window.
    """
    align = overlap - blend
    if align != len(anchors):
        raise ValueError("overlap - blend frames have an anchor each")
    kind = dict(rows.dtypes)[stream]
    own = rows.where(F.col("window_no") > 0).select(stream, "window_no", "place", *pixel, F.col(value).alias("_x")).where(F.col("place") < align)
    first = rows.where((F.col("window_no") == 0) & (F.col("place") == anchors[0])).select(stream, *pixel, F.col(value).alias("_first"))
    last = rows.where(F.col("place") == anchors[1]).select(stream, (F.col("window_no") + 1).alias("window_no"), *pixel, F.col(value).alias("_last"))
    met = own.join(first, [stream, *pixel]).join(last, [stream, "window_no", *pixel])
    a, b, x = F.col("place") == 0, F.col("place") == 1, F.col("_x")
    total = lambda ok, c: F.coalesce(F.sum(F.when(ok, c)), F.lit(0.0))
    sums = met.groupBy(stream, "window_no").agg(F.count(F.lit(1)).alias("n"), F.sum(x).alias("x"), F.sum(x * x).alias("xx"), total(a, F.col("_first")).alias("y"), total(a, x * F.col("_first")).alias("xy"), total(b, F.lit(1.0)).alias("m"), total(b, x).alias("bx"), total(b, F.col("_last")).alias("r"), total(b, x * F.col("_last")).alias("xr"))

    def chain(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("window_no")
        scale, shift, out = 1.0, 0.0, []
        for w in frame.itertuples():
            y, xy = w.y + scale * w.r + shift * w.m, w.xy + scale * w.xr + shift * w.bx
            det = w.n * w.xx - w.x * w.x
            scale, shift = ((w.n * xy - w.x * y) / det, (w.xx * y - w.x * xy) / det) if det else (1.0, 0.0)
            out.append((w.window_no, scale, shift))
        return pd.DataFrame({stream: frame[stream].to_numpy(), "window_no": [o[0] for o in out], "_scale": [o[1] for o in out], "_shift": [o[2] for o in out]})

    # A row for each window of a stream.
    fits = sums.groupBy(stream).applyInPandas(chain, f"`{stream}` {kind}, window_no long, _scale double, _shift double")
    fitted = rows.join(fits, [stream, "window_no"], "left")
    shown = F.when(F.col("_scale").isNull(), F.col(value)).otherwise(F.greatest(F.col(value) * F.col("_scale") + F.col("_shift"), F.lit(0.0)))
    newest = rows.groupBy(stream).agg(F.max("window_no").alias("_newest"))
    place, late = F.col("place"), F.col("window_no") > 0
    step = length - overlap
    rise = lambda p: (p - align) / float(blend - 1)
    weight = F.when(late & (place < align), 0.0).when(late & (place < overlap), rise(place)).when((F.col("window_no") < F.col("_newest")) & (place >= step + align), 1 - rise(place - step)).otherwise(1.0)
    parts = fitted.join(newest, stream).select(stream, (F.col("window_no") * step + place).alias("frame_idx"), *pixel, (shown * weight).alias("_v"))
    return parts.groupBy(stream, "frame_idx", *pixel).agg(F.sum("_v").alias(value))


def shared_scale(rows: DataFrame, stream: str, number: str, predicted: str, target: str, valid: Column, window: int = 64, overlap: int = 16, momentum: float = 0.9, least: float = 0.05) -> DataFrame:
    """The scale of overlapping windows that smooths from window to window: stream, window_no, scale.

    A window's own scale is the lower median of target over predicted on its
    valid rows; with too few of them it keeps the last one. Scales are smoothed
    by ``ema`` in the order of windows, the first own one being the start, and
    1 before it.
    """
    length = F.max(number).over(Window.partitionBy(stream)) + 1
    placed = overlapping(rows.withColumn("_length", length), number, F.col("_length"), window, overlap)
    ok = F.coalesce(valid, F.lit(False))
    ratio = F.when(ok, F.col(target) / F.col(predicted))
    per = placed.groupBy(stream, "window_no").agg(F.avg(ok.cast("double")).alias("_share"))
    own = quantiles(placed, [stream, "window_no"], {"_q": ratio}, [0.5], lower=True)
    scales = per.join(own, [stream, "window_no"]).withColumn("_own", F.when(F.col("_share") >= least, F.col("_q")[0]))
    return ema(scales.select(stream, "window_no", "_own"), stream, ["window_no"], "_own", momentum).select(stream, "window_no", F.coalesce("ema", F.lit(1.0)).alias("scale"))


def carried(value: Column, stream: str, order: list[str], default) -> Column:
    """The last value that is not null, at first a default."""
    w = Window.partitionBy(stream).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.coalesce(F.last(value, ignorenulls=True).over(w), F.lit(default))


def path_length(point: list[Column], stream: str, order: list[str]) -> Column:
    """The length of the way from the stream's first point."""
    w = Window.partitionBy(stream).orderBy(*order)
    step = sum(((p - F.lag(p).over(w)) * (p - F.lag(p).over(w)) for p in point[1:]), (point[0] - F.lag(point[0]).over(w)) * (point[0] - F.lag(point[0]).over(w)))
    return F.sqrt(F.coalesce(step, F.lit(0.0)))


def age(update: Column, born: Column) -> Column:
    return update - born


def sampled(number: Column, gap: int) -> Column:
    """Every gap-th row from the first."""
    return F.pmod(number, F.lit(gap)) == 0


def key_folds(batches: Iterator[pd.DataFrame], stream: str, value: str, threshold: float) -> Iterator[pd.DataFrame]:
    """Rows of sorted streams whose value lies more than a threshold from the last row that was kept; the first is kept."""
    state: dict = {}
    for frame in batches:
        keep = []
        for s, x in zip(frame[stream].tolist(), frame[value].tolist(), strict=True):
            if s not in state:
                state.clear()  # streams come one after the other
                state[s] = x
                keep.append(True)
            else:
                keep.append(abs(x - state[s]) > threshold)
                if keep[-1]:
                    state[s] = x
        yield frame[keep]


def keyframes(rows: DataFrame, stream: str, order: list[str], value: str, threshold: float) -> DataFrame:
    """Keyframe selection as a fold in order: constant state for a stream of any length."""
    return rows.repartition(stream).sortWithinPartitions(stream, *order).mapInPandas(lambda b: key_folds(b, stream, value, threshold), rows.schema)


def chunks(rows: DataFrame, stream: str, number: str, size: int) -> DataFrame:
    """Rows with the chunk they are handled in, and whether it is full; the last one of a stream is handled as it is."""
    last = F.max(number).over(Window.partitionBy(stream))
    chunk = F.floor(F.col(number) / size)
    return rows.withColumn("chunk", chunk).withColumn("full", (F.col("chunk") + 1) * size <= last + 1)


def with_last(chosen: DataFrame, rows: DataFrame, stream: str, order: str) -> DataFrame:
    """The chosen rows of each stream and its last row, which always counts."""
    ends = rows.groupBy(stream).agg(F.max(order).alias(order))
    last = rows.join(ends, [stream, order])
    return chosen.unionByName(last.join(chosen.select(stream, order), [stream, order], "left_anti"))


def suppressed(edges: DataFrame, stream: str, score: str, i: str, j: str, radius: int, most: int, limit: float) -> DataFrame:
    """Greedy choice by ascending score: an edge falls if a chosen one lies within the radius at both ends; ties go by (i, j).

    One stream's edges meet in one sorted run; the state is its chosen edges, most at once.
    """
    from collections import defaultdict

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, chosen, count = object(), defaultdict(list), 0
        for frame in batches:
            keep = []
            for s, a, b, d in zip(frame[stream].tolist(), frame[i].tolist(), frame[j].tolist(), frame[score].tolist(), strict=True):
                if s != now:
                    now, chosen, count = s, defaultdict(list), 0
                cell = (a // (radius + 1), b // (radius + 1))
                near = any(abs(a - x) <= radius and abs(b - y) <= radius for p in (-1, 0, 1) for q in (-1, 0, 1) for x, y in chosen[cell[0] + p, cell[1] + q])
                ok = d <= limit and count < most and not near
                keep.append(ok)
                if ok:
                    chosen[cell].append((a, b))
                    count += 1
            yield frame[keep]

    return edges.repartition(stream).sortWithinPartitions(stream, score, i, j).mapInPandas(run, edges.schema)


def oldest_out(edges: DataFrame, stream: str, age_of: str, tie: list[str], most: int) -> DataFrame:
    """The youngest edges of each stream, most of them at most."""
    w = Window.partitionBy(stream).orderBy(F.col(age_of), *tie)
    return edges.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= most).drop("_r")


def top_k(rows: DataFrame, keys: list[str], score: str, tie: list[str], k: int) -> DataFrame:
    """The k best rows of each key, best first; the limit is pushed below the shuffle as a window group limit."""
    w = Window.partitionBy(*keys).orderBy(F.col(score).desc(), *tie)
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def peaks(scores: DataFrame, keys: list[str], radius: int, value: str = "score") -> DataFrame:
    """Pixels (keys, u, v) that are the largest of their square neighbourhood, with two rounds that revive pixels beside suppressed ones."""

    def pooled(rows: DataFrame, column: Column, name: str) -> DataFrame:
        around = lambda c: F.explode(F.sequence(F.col(c) - radius, F.col(c) + radius)).alias(c)
        spread = rows.select(*keys, column.alias("_x"), around("v"), "u").select(*keys, "_x", "v", around("u"))
        return rows.join(spread.groupBy(*keys, "u", "v").agg(F.max("_x").alias(name)), [*keys, "u", "v"])

    rows = pooled(scores, F.col(value), "_m").withColumn("_peak", F.col(value) == F.col("_m")).drop("_m")
    for _ in range(2):
        rows = pooled(rows, F.col("_peak").cast("double"), "_near")
        rows = rows.withColumn("_rest", F.when(F.col("_near") > 0, 0.0).otherwise(F.col(value)))
        rows = pooled(rows, F.col("_rest"), "_m")
        rows = rows.withColumn("_peak", F.col("_peak") | ((F.col("_rest") == F.col("_m")) & (F.col("_near") == 0))).drop("_near", "_rest", "_m")
    return rows.where("_peak").drop("_peak")
