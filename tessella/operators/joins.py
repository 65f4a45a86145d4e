"""Joins of frames, keyframes, edges, pixels and points.

Ordered joins are windows over one stream's rows: the rows are hashed by
stream and sorted once. Band joins are equi-joins on a cell of the ordered key,
so no plan needs a cartesian product. A stream is a natural unit of work, but
where one stream holds very many rows pass ``slice_of``: rows and the
keyframes around a slice are then joined slice by slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.lineage import cut


def bracketing_keyframes(frames: DataFrame, keyframes: DataFrame, stream: str, time: str, tie: str, values: list[str], slice_of: Column | None = None) -> DataFrame:
    """Each frame with its last keyframe at or before it and the next one (itself where there is none).

    Adds kf0_time, kf1_time and kf0_<v>, kf1_<v>; frames before the first
    keyframe have nulls. Equal times go by the tie column. slice_of is a
    coarser, monotone column of the time; the last keyframe before and the
    first after every slice are carried into it.
    """
    kf = keyframes.select(stream, F.col(time).alias("_t"), F.col(tie).alias("_tie"), F.struct(F.col(time).alias("time"), *[F.col(v) for v in values]).alias("kf"))
    following = Window.partitionBy(stream).orderBy("_t", "_tie")
    kf = kf.withColumn("pair", F.struct(F.col("kf").alias("a"), F.coalesce(F.lead("kf").over(following), F.col("kf")).alias("b")))
    own = frames.select(stream, F.col(time).alias("_t"), F.col(tie).alias("_tie"), F.struct(*frames.columns).alias("row"))
    both = own.withColumn("pair", F.lit(None).cast(kf.schema["pair"].dataType)).withColumn("first", F.lit(1)).unionByName(kf.select(stream, "_t", "_tie", F.lit(None).cast(own.schema["row"].dataType).alias("row"), "pair", F.lit(0).alias("first")))
    keys = [stream]
    if slice_of is not None:
        both = both.withColumn("_slice", slice_of)
        last = both.groupBy(stream, "_slice").agg(F.max_by("pair", F.when(F.col("pair").isNotNull(), F.struct("_t", "_tie"))).alias("_last"))
        before = Window.partitionBy(stream).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        carried = last.withColumn("_before", F.last("_last", ignorenulls=True).over(before)).select(stream, "_slice", "_before")
        both = both.join(carried, [stream, "_slice"])
        keys.append("_slice")
    w = Window.partitionBy(*keys).orderBy("_t", "first", "_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = F.last("pair", ignorenulls=True).over(w)
    joined = both.withColumn("p", F.coalesce(found, F.col("_before")) if slice_of is not None else found).where("row is not null")
    extra = [F.col(f"p.{s}.{f}").alias(f"kf{n}_{f}") for n, s in enumerate("ab") for f in ("time", *values)]
    return joined.select("row.*", *extra)


def band(left: DataFrame, right: DataFrame, keys: list[str], a: str, b: str, low: int, high: int) -> DataFrame:
    """Pairs of equal keys with low <= b - a <= high, by cells of the ordered key; column names of both sides are kept apart by the caller."""
    width = max(1, high - low)
    first, last = F.floor((F.col(a) + low) / width), F.floor((F.col(a) + high) / width)
    probe = left.withColumn("_cell", F.explode(F.sequence(first, last)))
    build = right.withColumn("_cell", F.floor(F.col(b) / width))
    return probe.join(build, [*keys, "_cell"]).where(F.col(b).between(F.col(a) + low, F.col(a) + high)).drop("_cell")


def keyframe_band(frames: DataFrame, keyframes: DataFrame, stream: str, time: str, number: str, around: int = 3) -> DataFrame:
    """Every frame with the 2 * around + 1 keyframes about its lower bound: r = min(bound + around, last), l = max(r - 2 * around, 0).

    keyframes number their stream from 0 without gaps in time order.
    """
    kf = keyframes.select(stream, F.col(time).alias("_t"), F.col(number).alias("kf"))
    own = frames.select(stream, F.col(time).alias("_t"), F.struct(*frames.columns).alias("row"), F.lit(None).cast("long").alias("kf"))
    both = own.unionByName(kf.select(stream, "_t", F.lit(None).cast(own.schema["row"].dataType).alias("row"), F.col("kf").cast("long").alias("kf")))
    ahead = Window.partitionBy(stream).orderBy(F.col("_t").desc(), F.col("row").isNotNull().cast("int")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = kf.groupBy(stream).agg(F.count(F.lit(1)).alias("n"))
    placed = both.withColumn("bound", F.min("kf").over(ahead)).where("row is not null").join(counts, stream)
    r = F.least(F.coalesce("bound", "n") + around, F.col("n") - 1)
    spans = placed.select("row.*", F.explode(F.sequence(F.greatest(r - 2 * around, F.lit(0)), r)).alias("kf"))
    return spans.join(kf.select(stream, F.col("kf"), F.col("_t").alias("kf_time")), [stream, "kf"])


def neighbour_edges(keyframes: DataFrame, stream: str, number: str, radius: int, own: bool = False) -> DataFrame:
    """Directed edges (i, j) of a stream with least < |i - j| <= radius; with own also i = j."""
    j = keyframes.select(stream, F.col(number).alias("j"))
    i = keyframes.select(stream, F.col(number).alias("i"))
    found = band(i, j, [stream], "i", "j", -radius, radius)
    return found if own else found.where("i <> j")


def new_edges(fresh: DataFrame, *known: DataFrame, keys: tuple[str, ...] = ("i", "j")) -> DataFrame:
    """Edges that are neither known nor repeated in the batch itself."""
    out = fresh.dropDuplicates(list(keys))
    for table in known:
        out = out.join(table.select(*keys), list(keys), "left_anti")
    return out


def split_edges(edges: DataFrame, gone: Column) -> tuple[DataFrame, DataFrame]:
    """What stays and what is retired."""
    return edges.where(~gone), edges.where(gone)


def without_keyframe(edges: DataFrame, ix: int) -> DataFrame:
    """Edges that do not touch a keyframe, with the later numbers moved down."""
    shift = lambda c: F.when(F.col(c) >= ix, F.col(c) - 1).otherwise(F.col(c)).alias(c)
    kept = edges.where((F.col("i") != ix) & (F.col("j") != ix))
    return kept.select(*[shift(c) if c in ("i", "j") else F.col(c) for c in edges.columns])


def revived(active: DataFrame, inactive: DataFrame, t0: int, back: int = 3) -> DataFrame:
    """Active edges and the inactive ones with both ends from t0 - back."""
    return active.unionByName(inactive.where((F.col("i") >= t0 - back) & (F.col("j") >= t0 - back)))


def without_fixed(blocks: DataFrame, fixed: DataFrame, key: str) -> DataFrame:
    """Jacobian blocks of variables that are not fixed."""
    return blocks.join(fixed.select(key), key, "left_anti")


def multiview(edges: DataFrame, views: int, cross: DataFrame | None = None, view_offset: int = 0) -> DataFrame:
    """Edges (i, j) as (pi, qi, di, pj, qj, dj) for each view; an edge to itself goes to the partner of cross (pi, qi, pj, qj)."""
    wide = edges.select("*", F.explode(F.sequence(F.lit(0), F.lit(views - 1))).alias("qi"))
    out = wide.select(F.col("i").alias("pi"), "qi", F.col("j").alias("pj"), F.col("qi").alias("qj"), *[c for c in edges.columns if c not in ("i", "j")])
    if cross is not None:
        partner = cross.select("pi", "qi", F.col("pj").alias("_pj"), F.col("qj").alias("_qj"))
        joined = out.join(partner, ["pi", "qi"], "left")
        own = F.col("pi") == F.col("pj")
        out = joined.withColumns({"pj": F.when(own, F.coalesce("_pj", "pj")).otherwise(F.col("pj")), "qj": F.when(own, F.coalesce("_qj", "qj")).otherwise(F.col("qj"))}).drop("_pj", "_qj")
    out = out.withColumn("qj", F.pmod(F.col("qj") + view_offset, F.lit(views)))
    return out.withColumns({"di": F.col("pi") * views + F.col("qi"), "dj": F.col("pj") * views + F.col("qj")})


def track_edges(frames: DataFrame, number: str, length: int) -> DataFrame:
    """(i, i - m - 1) for m < length - 1, within the frames."""
    return frames.select(F.col(number).alias("i"), F.explode(F.sequence(F.lit(1), F.lit(length - 1))).alias("m")).select("i", (F.col("i") - F.col("m")).alias("j")).where("j >= 0")


def best_partner(distances: DataFrame, keys: list[str], partner: str, distance: str, limit: float) -> DataFrame:
    """The nearest partner of each key where it is near enough; ties go to the smaller partner."""
    best = distances.groupBy(*keys).agg(F.min(F.struct(F.col(distance).alias("d"), F.col(partner).alias("p"))).alias("b"))
    return best.select(*keys, F.when(F.col("b.d") < limit, F.col("b.p")).alias(partner), F.col("b.d").alias(distance))


def correspondences(tracks: DataFrame, frame: str, point: str, edges: DataFrame, values: list[str]) -> DataFrame:
    """For each edge (i, j) the points that both frames have, with the values of either."""
    a = tracks.select(F.col(frame).alias("i"), point, *[F.col(v).alias(f"{v}_i") for v in values])
    b = tracks.select(F.col(frame).alias("j"), point, *[F.col(v).alias(f"{v}_j") for v in values])
    return edges.select("i", "j").join(a, "i").join(b, ["j", point])


def splat(points: DataFrame, keys: list[str], u: str, v: str, width: int, height: int, values: list[str], weight: str | None = None, least: float = 0.0) -> DataFrame:
    """Values spread over the four pixels around each place by bilinear shares, and divided by the shares' sum; pixels below a least sum go."""
    x0, y0 = F.floor(F.col(u)), F.floor(F.col(v))
    corner = lambda dx, dy: F.struct((x0 + dx).alias("x"), (y0 + dy).alias("y"), ((F.col(u) - x0 if dx else 1 - (F.col(u) - x0)) * (F.col(v) - y0 if dy else 1 - (F.col(v) - y0)) * (F.col(weight) if weight else F.lit(1.0))).alias("w"))
    spread = points.withColumn("_c", F.explode(F.array(*[corner(dx, dy) for dy in (0, 1) for dx in (0, 1)])))
    inside = spread.where(F.col("_c.x").between(0, width - 1) & F.col("_c.y").between(0, height - 1) & (F.col("_c.w") > 0))
    sums = inside.groupBy(*keys, F.col("_c.x").alias("u"), F.col("_c.y").alias("v")).agg(F.sum("_c.w").alias("weight"), *[F.sum(F.col(c) * F.col("_c.w")).alias(c) for c in values])
    return sums.where(F.col("weight") >= least).select(*keys, "u", "v", "weight", *[(F.col(c) / F.col("weight")).alias(c) for c in values])


def splat_in_place(points: DataFrame, keys: list[str], u: str, v: str, width: int, height: int, values: list[str]) -> DataFrame:
    """Sums of values and weights over the four pixels from the rounded place on: keys, u, v, weight, values.

    Places are image coordinates whose first pixel is floor(x + 0.5), so the
    shares of a place lie between -0.5 and 1.5 and some are negative; places
    with a pixel outside are left out.
    """
    x0, y0 = F.floor(F.col(u) + 0.5), F.floor(F.col(v) + 0.5)
    inside = points.where((x0 >= 0) & (x0 + 1 < width) & (y0 >= 0) & (y0 + 1 < height))
    fx, fy = F.col(u) - x0, F.col(v) - y0
    corner = lambda dx, dy: F.struct((x0 + dx).alias("x"), (y0 + dy).alias("y"), ((fx if dx else 1 - fx) * (fy if dy else 1 - fy)).alias("w"))
    spread = inside.withColumn("_c", F.explode(F.array(*[corner(dx, dy) for dx in (0, 1) for dy in (0, 1)])))
    return spread.groupBy(*keys, F.col("_c.x").alias("u"), F.col("_c.y").alias("v")).agg(F.sum("_c.w").alias("weight"), *[F.sum(F.col(c) * F.col("_c.w")).alias(c) for c in values])


def track_targets(observations: DataFrame, terms: DataFrame, size: tuple[int, int], field: tuple[int, int], least: float = 0.1) -> DataFrame:
    """Where tracked points say that pixels go: term, v, u, target_u, target_v, weight.

    observations (view, frame, point, x, y) of images of a size (width,
    height); terms (term, view, source, target). The flow of the points that
    both frames hold is splatted on a field (width, height); pixels that no
    point weighs enough stay where they are, with weight 0.
    """
    kx, ky = field[0] / size[0], field[1] / size[1]
    side = lambda f, n: observations.select("view", F.col("frame").alias(f), "point", (F.col("x") * kx).alias(f"{n}x"), (F.col("y") * ky).alias(f"{n}y"))
    both = terms.join(side("source", "s"), ["view", "source"]).join(side("target", "t"), ["view", "target", "point"])
    flow = both.select("term", "sx", "sy", (F.col("tx") - F.col("sx")).alias("fx"), (F.col("ty") - F.col("sy")).alias("fy"))
    sums = splat_in_place(flow, ["term"], "sx", "sy", *field, ["fx", "fy"])
    spark = observations.sparkSession
    grid = spark.range(field[0] * field[1]).select(F.floor(F.col("id") / field[0]).alias("v"), (F.col("id") % field[0]).alias("u"))
    every = terms.select("term").join(F.broadcast(grid))  # the grid is one field
    good = F.coalesce(F.col("weight") >= least, F.lit(False))
    moved = lambda at, f: F.col(at) + F.when(good, F.col(f) / F.col("weight")).otherwise(0.0)
    return every.join(sums, ["term", "v", "u"], "left").select("term", "v", "u", moved("u", "fx").alias("target_u"), moved("v", "fy").alias("target_v"), F.when(good, F.col("weight")).otherwise(0.0).alias("weight"))


def project_map(points: DataFrame, keys: list[str], u: str, v: str, depth: str, width: int, height: int, values: list[str]) -> DataFrame:
    """The nearest point of each pixel that sees any; equal depths go to the smaller values."""
    seen = points.where((F.col(u) > 0) & (F.col(u) < width) & (F.col(v) > 0) & (F.col(v) < height) & (F.col(depth) > 0))
    at = [F.floor(F.col(u)).alias("u"), F.floor(F.col(v)).alias("v")]
    best = seen.groupBy(*keys, *at).agg(F.min(F.struct(F.col(depth).alias("_d"), *values)).alias("b"))
    return best.select(*keys, "u", "v", F.col("b._d").alias(depth), *[F.col(f"b.{c}").alias(c) for c in values])


def bilinear(grid: DataFrame, places: DataFrame, keys: list[str], u: str, v: str, values: list[str]) -> DataFrame:
    """Values of a grid (keys, u, v) between its pixels; places (keys, u, v columns by name); corners outside count 0."""
    x0, y0 = F.floor(F.col(u)), F.floor(F.col(v))
    fx, fy = F.col(u) - x0, F.col(v) - y0
    corner = lambda dx, dy: F.struct((x0 + dx).alias("u"), (y0 + dy).alias("v"), ((fx if dx else 1 - fx) * (fy if dy else 1 - fy)).alias("w"))
    wide = places.withColumn("_row", F.struct(*places.columns)).withColumn("_c", F.explode(F.array(*[corner(dx, dy) for dy in (0, 1) for dx in (0, 1)])))
    ask = wide.select("_row", *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_c.u").alias("_u"), F.col("_c.v").alias("_v"), F.col("_c.w").alias("_w"))
    have = grid.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("u").cast("long").alias("_u"), F.col("v").cast("long").alias("_v"), *[F.col(c).alias(f"_g_{c}") for c in values])
    got = ask.join(have, [*[f"_k{i}" for i in range(len(keys))], "_u", "_v"], "left")
    return got.groupBy("_row").agg(*[F.sum(F.coalesce(F.col(f"_g_{c}") * F.col("_w"), F.lit(0.0))).alias(c) for c in values]).select("_row.*", *values)


#: Points of the fullest cell at the first width that is tried, per neighbour wanted.
_FULL = 32


def cell_width(points: DataFrame, keys: list[str], axes: list[str], k: int, widest: float, halvings: int = 10) -> float:
    """The largest of widest / 2, / 4, ... whose fullest cell holds few points; each width is counted in one pass."""
    at = F.struct(F.col("_w"), *[F.floor(F.col(f"p_{a}") / F.col("_w")).alias(a) for a in axes])
    wide = points.withColumn("_w", F.explode(F.array(*[F.lit(widest / 2**n) for n in range(1, halvings + 1)])))
    full = wide.groupBy(*keys, at.alias("_cell")).agg(F.count(F.lit(1)).alias("n")).groupBy("_cell._w").agg(F.max("n").alias("n")).collect()
    fine = [r["_w"] for r in full if r["n"] <= _FULL * k]
    return max(fine) if fine else widest / 2**halvings


def knn(queries: DataFrame, points: DataFrame, keys: list[str], axes: list[str], k: int, cell: float | None, query_id: str, point_id: str) -> DataFrame:
    """The k nearest points (squared distance) of each query, exactly, up to three axes.

    Both sides meet in cells of a grid and in the cells around. Only pairs within
    a cell's width are kept, so a query with k of them has its neighbours; the
    others are asked again with cells four times as wide, until all have their
    neighbours or the keys hold too few points. The first width is the cell, or
    half of the extent without one, halved until even the fullest cell holds few
    places, so crowds are settled among near points and only far queries ask
    again. Of points on one place the k smallest ids are read. Ties go to the
    smaller point id; rows without a place have no neighbours and are none.
    """
    dist = lambda: sum(((F.col(f"q_{a}") - F.col(f"p_{a}")) * (F.col(f"q_{a}") - F.col(f"p_{a}")) for a in axes[1:]), (F.col(f"q_{axes[0]}") - F.col(f"p_{axes[0]}")) * (F.col(f"q_{axes[0]}") - F.col(f"p_{axes[0]}")))
    q = queries.dropna(subset=axes).select(*keys, F.col(query_id), *[F.col(a).alias(f"q_{a}") for a in axes])
    p = points.dropna(subset=axes).select(*keys, F.col(point_id), *[F.col(a).alias(f"p_{a}") for a in axes])
    place = Window.partitionBy(*keys, *[f"p_{a}" for a in axes]).orderBy(point_id)
    p = cut(p.withColumn("_n", F.row_number().over(place)).where(F.col("_n") <= k).drop("_n"))
    bounds = p.agg(*[F.max(f"p_{a}").alias(f"hi_{a}") for a in axes], *[F.min(f"p_{a}").alias(f"lo_{a}") for a in axes]).first()
    qb = q.agg(*[F.max(f"q_{a}").alias(f"hi_{a}") for a in axes], *[F.min(f"q_{a}").alias(f"lo_{a}") for a in axes]).first()
    widest = max([1e-12] + [max(bounds[f"hi_{a}"], qb[f"hi_{a}"]) - min(bounds[f"lo_{a}"], qb[f"lo_{a}"]) for a in axes if bounds[f"hi_{a}"] is not None and qb[f"hi_{a}"] is not None])
    cell = cell_width(p, keys, axes, k, widest if cell is None else 2 * cell)
    done = None
    while True:
        grid = [F.floor(F.col(f"p_{a}") / cell).alias(f"c_{a}") for a in axes]
        near = q
        for a in axes:
            base = F.floor(F.col(f"q_{a}") / cell)
            near = near.withColumn(f"c_{a}", F.explode(F.sequence(base - 1, base + 1)))
        pairs = near.join(p.select("*", *grid), [*keys, *[f"c_{a}" for a in axes]]).select(*keys, query_id, point_id, dist().alias("d2"))
        if cell <= widest:
            # A hair less than the width, for places that rounding moves across a border.
            pairs = pairs.where(F.col("d2") <= (cell * (1 - 1e-6)) ** 2)
        own = Window.partitionBy(*keys, query_id)
        ranked = pairs.withColumn("rank", F.row_number().over(own.orderBy("d2", point_id))).where(F.col("rank") <= k)
        if cell > widest:
            return ranked if done is None else done.unionByName(ranked)
        # Computed once, at most k rows for each query.
        ranked = cut(ranked.withColumn("_n", F.count(F.lit(1)).over(own)))
        final = ranked.where(F.col("_n") == k).drop("_n")
        done = final if done is None else done.unionByName(final)
        q = cut(q.join(final.select(*keys, query_id), [*keys, query_id], "left_anti"))
        if q.isEmpty():
            return done
        cell *= 4


def knn_affine_fill(neighbours: DataFrame, keys: list[str], x: str, y: str, d2: str) -> DataFrame:
    """Scale and shift of a weighted least squares line through the neighbours of each key; weights are inverse distances."""
    w = 1 / F.greatest(F.sqrt(d2), F.lit(1e-6))
    s = neighbours.groupBy(*keys).agg(F.sum(w).alias("w"), F.sum(w * F.col(x)).alias("x"), F.sum(w * F.col(y)).alias("y"), F.sum(w * F.col(x) * F.col(x)).alias("xx"), F.sum(w * F.col(x) * F.col(y)).alias("xy"))
    det = F.col("w") * F.col("xx") - F.col("x") * F.col("x")
    fit = F.abs(det) > 1e-12
    scale = F.when(fit, (F.col("w") * F.col("xy") - F.col("x") * F.col("y")) / F.when(fit, det).otherwise(1.0)).otherwise(0.0)
    return s.select(*keys, scale.alias("scale"), ((F.col("y") - scale * F.col("x")) / F.col("w")).alias("shift"))


def new_objects(segments: DataFrame, tracked: DataFrame, pixel: list[str], segment: str, least_area: int = 200, least_share: float = 0.8, most: int = 255) -> DataFrame:
    """Segments that lie mostly on untracked pixels, numbered after the tracked ones."""
    on = segments.join(tracked.select(*pixel, F.lit(1).alias("_t")), pixel, "left")
    areas = on.groupBy(segment).agg(F.count(F.lit(1)).alias("total"), F.sum(F.when(F.col("_t").isNull(), 1).otherwise(0)).alias("area"))
    kept = areas.where((F.col("area") >= least_area) & (F.col("area") / F.col("total") >= least_share))
    # The first ones are found without a global sort; as many rows as numbers are ranked.
    return kept.orderBy(segment).limit(most).withColumn("object_id", F.row_number().over(Window.orderBy(segment)))


def dot_product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def correlation(a: DataFrame, b: DataFrame, edges: DataFrame, feature: str, scale: float = 16.0) -> DataFrame:
    """Scaled dot products of the features of each edge (i, j); only the listed pairs are formed."""
    left = a.withColumnRenamed(feature, "_fa")
    right = b.withColumnRenamed(feature, "_fb")
    return edges.join(left, "i").join(right, "j").withColumn("corr", dot_product(F.col("_fa"), F.col("_fb")) / scale).drop("_fa", "_fb")
