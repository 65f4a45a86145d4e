"""Keyframe graphs: edges by proximity, and updates around a network that the caller brings.

A graph has at most ``bundle.CAPACITY`` keyframes, so its list of edges is a
small table of the driver; everything that grows with pixels (places, targets,
weights, disparities) is a DataFrame. The network is a function from the rows
of all edges' pixels to their answers, for example a registered model in Arrow
batches: it sees edge_id, i, j, v, u, at_u and at_v (where the pixel is seen
now), flow_u and flow_v (its way there) and rest_u and rest_v (what the last
target lies beyond it), and gives edge_id, v, u, delta_u, delta_v, weight_u,
weight_v. With a column eta it also sets the damping of the source's pixels.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.camera import Pinhole
from tessella.functions.lie import SE3
from tessella.lineage import cut
from tessella.operators import align, bundle

Network = Callable[[DataFrame], DataFrame]
#: Motion features are cut off here.
FAR_MOTION = 64.0


def _diamond(distances: np.ndarray, i: int, j: int, first: int, back: int, nms: int) -> None:
    """Bar the pairs around an edge; the wider it spans, the more of them, up to nms steps."""
    reach = max(min(abs(i - j) - 2, nms), 0)
    for a in range(max(i - reach, first), min(i + reach, first + len(distances) - 1) + 1):
        left = reach - abs(a - i)
        low, high = max(j - left, back), min(j + left, back + distances.shape[1] - 1)
        if low <= high:
            distances[a - first, low - back : high - back + 1] = np.inf


def choose_edges(distances: np.ndarray, known: Iterable[tuple[int, int]], first: int, back: int, radius: int, nms: int, limit: float, most: int, cross_view: bool = False) -> list[tuple[int, int]]:
    """Edges of a graph, in order: those between neighbours, then pairs by ascending distance that no chosen edge bars.

    distances[i - first, j - back] for frames i from first and j from back on.
    A pair looks back by at least radius frames and is added both ways.
    """
    d = distances.astype(float).copy()
    frames = first + len(d)
    for i, j in known:
        _diamond(d, i, j, first, back, nms)
    i, j = np.meshgrid(np.arange(first, frames), np.arange(back, back + d.shape[1]), indexing="ij")
    d[(i - radius < j) | (d > limit)] = np.inf
    edges: list[tuple[int, int]] = []
    for a in range(first, frames):
        if cross_view:
            edges.append((a, a))
            if back <= a:
                d[a - first, a - back] = np.inf
        for b in range(max(a - radius - 1, 0), a):
            edges += [(a, b), (b, a)]
            if back <= b:
                d[a - first, b - back] = np.inf
    order = np.argsort(d, axis=None, kind="stable")
    for at in order:
        a, b = divmod(int(at), d.shape[1])
        if not d[a, b] <= limit:
            continue  # barred by now
        if len(edges) > most:
            break
        a, b = a + first, b + back
        edges += [(a, b), (b, a)]
        _diamond(d, a, b, first, back, nms)
    return edges


def filled(frames: Column, most: int, first: int = 0, radius: int = 2, cross_view: bool = False) -> Column:
    """Whether the edges between neighbours of so many frames are more than most, so that ``choose_edges`` takes none by distance."""
    reach = max(radius + 1, 0)
    n = F.greatest(frames.cast("long"), F.lit(first).cast("long"))
    # Frames before the reach see one another, later ones as many as the reach.
    upto = F.least(n, F.lit(reach)) * (F.least(n, F.lit(reach)) - 1) / 2 + F.greatest(n - reach, F.lit(0)) * reach
    before = min(first, reach) * (min(first, reach) - 1) // 2 + max(first - reach, 0) * reach
    return (upto - before) * 2 + (n - first) * int(cross_view) > most


def _neighbours(sizes: DataFrame, stream: str, first: int, radius: int, cross_view: bool) -> DataFrame:
    """stream, i, j and _at (their order) of the edges between neighbours of graphs (stream, frames)."""
    reach = max(radius + 1, 0)
    a, none = F.col("_a"), F.expr("cast(array() as array<struct<i: bigint, j: bigint>>)")
    edge = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    back = F.transform(F.sequence(F.greatest(a - reach, F.lit(0)), a - 1), lambda b: F.array(edge(a, b), edge(b, a)))
    edges = F.concat(F.array(edge(a, a)) if cross_view else none, F.when((a > 0) & F.lit(reach > 0), F.flatten(back)).otherwise(none))
    frames = sizes.where(F.col("frames") > first).select(stream, F.explode(F.sequence(F.lit(first).cast("long"), F.col("frames") - 1)).alias("_a"))
    return frames.select(stream, "_a", F.posexplode(edges).alias("_k", "_e")).select(stream, "_e.i", "_e.j", F.struct("_a", "_k").alias("_at"))


def proximity_edges(distances: DataFrame, known: DataFrame, stream: str, first: int = 0, back: int = 0, radius: int = 2, nms: int = 2, limit: float = 16.0, most: int = 48, cross_view: bool = False, sizes: DataFrame | None = None) -> DataFrame:
    """``choose_edges`` for every stream of distances (stream, i, j, d): stream, n (the order), i, j without those of known (stream, i, j).

    sizes (stream, frames) has the graphs' numbers of frames, by default as many
    as distances shows. Where the edges between neighbours are more than most
    (``filled``), none is chosen by distance: they are listed whatever the
    graph's size, and its distances are not read, so they may be left out. Of
    the others the unit of work is one graph, at most CAPACITY frames.
    """
    kind = dict(distances.dtypes)[stream]
    if sizes is None:
        sizes = distances.groupBy(stream).agg((F.max(F.greatest("i", "j")) + 1).alias("frames"))
    sizes = sizes.select(stream, F.col("frames").cast("long").alias("frames"))
    full = filled(F.col("frames"), most, first, radius, cross_view)

    def run(frame: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        frames = int(have._frames.max())
        if frames > bundle.CAPACITY:
            raise ValueError(f"a graph has at most {bundle.CAPACITY} frames")
        d = np.full((max(frames - first, 0), max(frames - back, 0)), np.inf)
        own = frame[(frame.i >= first) & (frame.j >= back)]
        d[own.i.to_numpy() - first, own.j.to_numpy() - back] = own.d.to_numpy()
        old = have[have._frames < 0]
        held = list(zip(old._i.tolist(), old._j.tolist(), strict=True))
        got = list(dict.fromkeys(choose_edges(d, held, first, back, radius, nms, limit, most, cross_view)))
        fresh = [e for e in got if e not in set(held)]
        return pd.DataFrame({stream: [have._stream.iloc[0]] * len(fresh), "n": range(len(fresh)), "i": [e[0] for e in fresh], "j": [e[1] for e in fresh]})

    other = known.select(F.col(stream).alias("_stream"), F.col("i").cast("long").alias("_i"), F.col("j").cast("long").alias("_j"))
    listed = _neighbours(sizes.where(full), stream, first, radius, cross_view)
    listed = listed.join(other, F.col(stream).eqNullSafe(F.col("_stream")) & (F.col("i") == F.col("_i")) & (F.col("j") == F.col("_j")), "left_anti")
    order = Window.partitionBy(stream).orderBy("_at")
    listed = listed.select(stream, (F.row_number().over(order) - 1).alias("n"), "i", "j")
    # The open graphs: their number of frames comes with the known edges.
    room = sizes.where(~full).select(F.col(stream).alias("_open"), "frames")
    among = lambda rows, name: rows.join(room, F.col(name).eqNullSafe(F.col("_open")), "left_semi")
    with_frames = among(other, "_stream").withColumn("_frames", F.lit(-1).cast("long")).union(room.select("_open", F.lit(0).cast("long"), F.lit(0).cast("long"), "frames"))
    groups = among(distances.select(stream, "i", "j", "d"), stream).groupBy(stream).cogroup(with_frames.groupBy("_stream"))
    return listed.unionByName(groups.applyInPandas(run, f"`{stream}` {kind}, n int, i long, j long"))


def places(pixels: DataFrame, pairs: DataFrame, poses: DataFrame, k: tuple) -> DataFrame:
    """Where the pixels of i are seen from j, for pairs with columns i and j: at_u, at_v, and only moved, not turned: move_u, move_v; good: in front of the camera both times."""
    cam = Pinhole(*[F.lit(float(x)) for x in k])
    side = lambda s: poses.select(F.col("frame_idx").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in poses.columns if c != "frame_idx"])
    # Pairs and poses of one graph.
    rows = pixels.withColumnRenamed("frame_idx", "i").join(F.broadcast(pairs), "i").join(F.broadcast(side("i")), "i").join(F.broadcast(side("j")), "j")
    relative = SE3.of("j_").mul(SE3.of("i_").inv())
    rows = rows.select(*[c for c in rows.columns if not c.startswith(("i_", "j_"))], *relative.columns("g_"))
    ray = cam.unproject(F.col("u").cast("double"), F.col("v").cast("double"))
    turned = SE3.of("g_").act(ray, F.col("disp"))
    moved = SE3(SE3.of("g_").t, SE3.identity().q).act(ray, F.col("disp"))
    rows = rows.withColumns({f"{n}{a}": x for n, p in (("_p", turned), ("_m", moved)) for a, x in zip("xyz", p, strict=True)})
    good = (F.col("_pz") > bundle.MIN_DEPTH) & (F.col("_mz") > bundle.MIN_DEPTH)
    at = lambda n: cam.project((F.col(f"{n}x"), F.col(f"{n}y"), F.when(F.col(f"{n}z") > bundle.MIN_DEPTH, F.col(f"{n}z")).otherwise(1.0)), limit=False)
    (u, v), (mu, mv) = at("_p"), at("_m")
    return rows.withColumns({"at_u": u, "at_v": v, "move_u": mu, "move_v": mv, "good": good}).drop(*[f"{n}{a}" for n in ("_p", "_m") for a in "xyz"], *[c for c in rows.columns if c.startswith("g_")])


def frame_distances(pixels: DataFrame, pairs: DataFrame, poses: DataFrame, k: tuple, beta: float = 0.3) -> DataFrame:
    """i, j, d: the mean way of i's pixels to j, turned and moved, mixed with the way by the move alone."""
    rows = places(pixels, pairs, poses, k)
    way = lambda a, b: F.hypot(F.col(a) - F.col("u"), F.col(b) - F.col("v"))
    return align.frame_distance(rows, ["i", "j"], way("at_u", "at_v"), way("move_u", "move_v"), F.col("good"), beta).withColumnRenamed("distance", "d")


class Graph:
    """Edges between keyframes with targets and weights for every pixel, and their updates.

    pixels (frame_idx, v, u, disp, disp_sensor, and masked where some are),
    poses by frame, world to camera.
    """

    def __init__(self, pixels: DataFrame, poses: dict[int, tuple], k: tuple, network: Network, most: int = 48, cross_view: bool = False):
        self.spark, self.pixels, self.k, self.network = pixels.sparkSession, pixels, k, network
        self.poses = {f: np.asarray(p, float) for f, p in poses.items()}
        self.most, self.cross_view = most, cross_view
        self.edges: dict[tuple[int, int], int] = {}  # edge -> its number
        self.age: dict[tuple[int, int], int] = {}
        self.inactive: dict[tuple[int, int], int] = {}
        self.numbers = 0
        self.flow: DataFrame | None = None  # edge_id, v, u, target_u, target_v, weight_u, weight_v

    @property
    def frames(self) -> int:
        return max(self.poses, default=-1) + 1

    def table(self, edges: dict[tuple[int, int], int]) -> DataFrame:
        return self.spark.createDataFrame([(n, i, j) for (i, j), n in edges.items()], "edge_id int, i long, j long")

    def _places(self, edges: dict[tuple[int, int], int]) -> DataFrame:
        return places(self.pixels, self.table(edges), bundle._poses(self.spark, self.poses), self.k)

    def add(self, pairs: Iterable[tuple[int, int]], evict: bool = False) -> None:
        """New edges start at the present places with weight 0; with evict the oldest make room and stay as inactive ones."""
        fresh = [e for e in dict.fromkeys(pairs) if e not in self.edges and e not in self.inactive]
        if not fresh:
            return
        over = len(self.edges) + len(fresh) - self.most
        if evict and self.most > 0 and over > 0 and self.edges:
            by_age = sorted(self.edges, key=lambda e: self.age[e])
            self.remove(set(by_age[max(self.most - len(fresh), 0) :]), store=True)
        new = {e: self.numbers + n for n, e in enumerate(fresh)}
        self.numbers += len(new)
        start = self._places(new).select("edge_id", "v", "u", F.col("at_u").alias("target_u"), F.col("at_v").alias("target_v"), F.lit(0.0).alias("weight_u"), F.lit(0.0).alias("weight_v"))
        self.flow = cut(start if self.flow is None else self.flow.unionByName(start))
        self.edges |= new
        self.age |= dict.fromkeys(new, 0)

    def remove(self, gone: set[tuple[int, int]], store: bool = False) -> None:
        for e in [e for e in self.edges if e in gone]:
            number = self.edges.pop(e)
            del self.age[e]
            if store:
                self.inactive[e] = number

    def drop_keyframe(self, ix: int) -> None:
        """Take a keyframe out; later ones move down by one, with their edges, poses and pixels."""
        down = lambda e: tuple(x - (x >= ix) for x in e)
        kept = lambda table: {down(e): n for e, n in table.items() if ix not in e}
        self.edges, self.age, self.inactive = kept(self.edges), kept(self.age), kept(self.inactive)
        self.poses = {f - (f > ix): p for f, p in self.poses.items() if f != ix}
        f = F.col("frame_idx")
        self.pixels = cut(self.pixels.where(f != ix).withColumn("frame_idx", F.when(f > ix, f - 1).otherwise(f)))

    def neighbours(self, first: int, last: int, radius: int) -> None:
        low = 0 if self.cross_view else 1
        self.add([(i, j) for i in range(first, last) for j in range(first, last) if low <= abs(i - j) <= radius])

    def proximity(self, first: int = 0, back: int = 0, radius: int = 2, nms: int = 2, beta: float = 0.25, limit: float = 16.0, evict: bool = False) -> None:
        first, back = max(first, 0), max(back, 0)
        frames = self.frames
        pairs = self.spark.createDataFrame([(i, j) for i in range(first, frames) for j in range(back, frames) if j <= i - radius] or [(-1, -1)], "i long, j long")
        d = np.full((frames - first, frames - back), np.inf)
        for r in frame_distances(self.pixels, pairs, bundle._poses(self.spark, self.poses), self.k, beta).collect():  # pairs of one graph
            d[r["i"] - first, r["j"] - back] = r["d"]
        self.add(choose_edges(d, [*self.edges, *self.inactive], first, back, radius, nms, limit, self.most, self.cross_view), evict)

    def _ask(self) -> None:
        """One answer of the network for all active edges, which become new targets and weights."""
        now = self._places(self.edges)
        masked = F.col("masked") if "masked" in self.pixels.columns else F.lit(False)
        near = lambda c: F.greatest(F.least(c, F.lit(FAR_MOTION)), F.lit(-FAR_MOTION))
        asked = now.select("edge_id", "i", "j", "v", "u", "at_u", "at_v", masked.alias("masked")).join(self.flow, ["edge_id", "v", "u"])
        seen = asked.select("edge_id", "i", "j", "v", "u", "at_u", "at_v", near(F.col("at_u") - F.col("u")).alias("flow_u"), near(F.col("at_v") - F.col("v")).alias("flow_v"), near(F.col("target_u") - F.col("at_u")).alias("rest_u"), near(F.col("target_v") - F.col("at_v")).alias("rest_v"))
        answer = cut(self.network(seen))
        both = asked.select("edge_id", "i", "v", "u", "at_u", "at_v", "masked").join(answer, ["edge_id", "v", "u"])
        weight = lambda c: F.when(F.col("masked"), 0.0).otherwise(F.col(c)).alias(c)
        fresh = both.select("edge_id", "v", "u", (F.col("at_u") + F.col("delta_u")).alias("target_u"), (F.col("at_v") + F.col("delta_v")).alias("target_v"), weight("weight_u"), weight("weight_v"))
        # Inactive edges keep their last targets.
        held = self.spark.createDataFrame([(n,) for n in self.inactive.values()] or [(-1,)], "edge_id int")
        if "eta" in answer.columns:
            eta = both.groupBy(F.col("i").alias("frame_idx"), "v", "u").agg(F.avg("eta").alias("_eta"))
            old = F.col("eta") if "eta" in self.pixels.columns else F.lit(1e-6)
            names = [c for c in self.pixels.columns if c != "eta"]
            self.pixels = cut(self.pixels.join(eta, ["frame_idx", "v", "u"], "left").select(*names, F.coalesce("_eta", old).alias("eta")))
        self.flow = cut(fresh.unionByName(self.flow.join(F.broadcast(held), "edge_id", "left_semi")))

    def _adjust(self, edges: dict, first: int, last: int, iterations: int, damping: float, eps: float, motion_only: bool, limited: bool) -> float:
        free = [f for f in range(first, last) if f in self.poses]
        frames = free if limited else None
        self.poses, self.pixels, energies = bundle.adjust(self.pixels, self.table(edges), self.flow, self.poses, self.k, free, iterations, damping, eps, motion_only=motion_only, limited=frames)
        return energies[0] if energies else 0.0

    def update(self, first: int | None = None, last: int | None = None, iterations: int = 3, use_inactive: bool = False, motion_only: bool = False, fixed_motion: bool = False, limited: bool = False) -> float:
        """The network's answer and an adjustment of frames from first to last; inactive edges near them may take part. Gives the energy before it."""
        ends = [x for e in self.edges for x in e]
        first = max(1, min(i for i, _ in self.edges) + 1) if first is None else first
        last = max(ends) + 1 if last is None else last
        self._ask()
        edges = dict(self.edges)
        if use_inactive:
            edges |= {e: n for e, n in self.inactive.items() if min(e) >= first - 3}
        energy = self._adjust(edges, first, first if fixed_motion else last, iterations, 1e-3, 0.1, motion_only, limited)
        for e in self.age:
            self.age[e] += 1
        return energy

    def update_batch(self, iterations: int, steps: int) -> list[float]:
        """All keyframes but the first, with the network asked before each of the steps."""
        energies = []
        for _ in range(steps):
            self._ask()
            energies.append(self._adjust(self.edges, 1, self.frames, iterations, 1e-5, 1e-2, False, False))
        return energies


class Frontend:
    """Keyframes as they come: a start with warmup frames, then a window of recent ones for each new keyframe."""

    def __init__(self, graph: Graph, warmup: int = 8, window: int = 25, radius: int = 2, nms: int = 1, limit: float = 16.0, beta: float = 0.3, keyframe_limit: float = 4.0, max_age: int = 25, turns: tuple[int, int, int] = (8, 4, 2), iterations: int = 3, known_poses: bool = False):
        self.graph, self.warmup, self.window, self.radius, self.nms, self.limit, self.beta = graph, warmup, window, radius, nms, limit, beta
        self.keyframe_limit, self.max_age, self.turns, self.iterations, self.known_poses = keyframe_limit, max_age, turns, iterations, known_poses
        self.started, self.done = False, 0  # keyframes that have been through an update

    def append(self, pose, pixels: DataFrame) -> bool:
        """A new keyframe (v, u, disp, disp_sensor); its pose, or None to follow the last motion. False where it replaced the one before it."""
        g = self.graph
        ix = g.frames
        g.poses[ix] = np.asarray(self.next_pose() if pose is None else pose, float)
        own = pixels.withColumn("frame_idx", F.lit(ix).cast("long"))
        g.pixels = cut(g.pixels.unionByName(own, allowMissingColumns=True).select(*g.pixels.columns))
        if self.started:
            return self._advance()
        if g.frames >= self.warmup:
            self._start()
        return True

    def next_pose(self) -> np.ndarray:
        """Half of the last motion once more."""
        last = max(self.graph.poses)
        if last < 1:
            return self.graph.poses[last]
        a, b = self.graph.poses[last - 1], self.graph.poses[last]
        return bundle.retract(b, 0.5 * motion(a, b))

    def _start(self) -> None:
        g = self.graph
        g.neighbours(0, g.frames, 3)
        for _ in range(self.turns[0]):
            g.update(1, iterations=self.iterations, use_inactive=True, fixed_motion=self.known_poses)
        g.proximity(radius=2, nms=2, limit=self.limit)
        for _ in range(self.turns[0]):
            g.update(1, iterations=self.iterations, use_inactive=True, fixed_motion=self.known_poses)
        self.started, self.done = True, g.frames
        g.remove({e for e in g.edges if e[0] < self.warmup - 4}, store=True)

    def _advance(self) -> bool:
        g = self.graph
        newest = g.frames - 1
        g.remove({e for e in g.edges if g.age[e] > self.max_age}, store=True)
        g.proximity(newest - 4, newest + 1 - self.window, self.radius, self.nms, self.beta, self.limit, evict=True)
        for _ in range(self.turns[1]):
            g.update(iterations=self.iterations, use_inactive=True, fixed_motion=self.known_poses)
        pair = self.graph.spark.createDataFrame([(newest - 2, newest - 1), (newest - 1, newest - 2)], "i long, j long")
        ways = [r["d"] for r in frame_distances(g.pixels, pair, bundle._poses(g.spark, g.poses), g.k, self.beta).collect()]
        new = not ways or float(np.mean(ways)) >= self.keyframe_limit
        if new:
            for _ in range(self.turns[2]):
                g.update(iterations=self.iterations, use_inactive=True, fixed_motion=self.known_poses)
        else:
            g.drop_keyframe(newest - 1)
        self.done = g.frames
        return new


def motion(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The tangent (tau, phi) that takes pose a to pose b."""
    turn = lambda q, v: v + 2 * np.cross(q[:3], np.cross(q[:3], v) + q[3] * v)
    back = np.array([*-a[3:6], a[6]])
    q = np.array([*(b[6] * back[:3] + back[3] * b[3:6] + np.cross(b[3:6], back[:3])), b[6] * back[3] - b[3:6] @ back[:3]])
    q = q if q[3] >= 0 else -q
    t = b[:3] - turn(q, a[:3])
    sine = np.linalg.norm(q[:3])
    angle = 2 * np.arctan2(sine, q[3])
    phi = q[:3] * (angle / sine if sine > 1e-9 else 2.0)
    k = np.array([[0, -phi[2], phi[1]], [phi[2], 0, -phi[0]], [-phi[1], phi[0], 0]])
    c = 1 / 12 if angle < 1e-4 else (1 - angle / 2 / np.tan(angle / 2)) / angle**2
    return np.concatenate(((np.eye(3) - k / 2 + c * k @ k) @ t, phi))


def backend(graph: Graph, steps: int = 12, iterations: int = 8, radius: int = 2, nms: int = 3, limit: float = 22.0, beta: float = 0.3, edges_per_keyframe: int = 16) -> list[float]:
    """A fresh graph over all keyframes, chosen by proximity, and steps of all of them; without edges sensor depths stand in."""
    whole = Graph(graph.pixels, graph.poses, graph.k, graph.network, edges_per_keyframe * graph.frames, graph.cross_view)
    whole.proximity(radius=radius, nms=nms, limit=limit, beta=beta)
    if whole.edges:
        energies = whole.update_batch(iterations, steps)
    else:
        energies = []
        whole.pixels = whole.pixels.withColumn("disp", F.when(F.col("disp_sensor") > 0, F.col("disp_sensor")).otherwise(F.col("disp")))
    graph.poses, graph.pixels = whole.poses, whole.pixels
    return energies


def infill(graph: Graph, keyframe_times: list[float], times: list[float], pixels: DataFrame, turns: int = 10, dense: bool = False) -> tuple[list[np.ndarray], DataFrame | None]:
    """Poses of the frames between keyframes: constant velocity between the two around each, then updates that leave the keyframes alone.

    pixels (frame_idx from 0 in the order of times, v, u, disp, disp_sensor)
    count with dense, which moves disparities too; otherwise only poses move.
    """
    n = graph.frames
    left = np.searchsorted(keyframe_times, times, side="right") - 1
    left = np.clip(left, 0, n - 1)
    right = np.minimum(left + 1, n - 1)
    own = dict(graph.poses)
    for m, (a, b) in enumerate(zip(left, right, strict=True)):
        span = keyframe_times[b] - keyframe_times[a] + 1e-3
        own[n + m] = bundle.retract(graph.poses[a], motion(graph.poses[a], graph.poses[b]) * ((times[m] - keyframe_times[a]) / span))
    names = graph.pixels.columns
    fresh = pixels.withColumn("frame_idx", F.col("frame_idx") + n)
    if dense:
        mean = graph.pixels.groupBy("frame_idx").agg(F.avg("disp").alias("_mean"))
        at = graph.spark.createDataFrame([(n + m, int(a)) for m, a in enumerate(left)], "frame_idx long, _left long")  # a row for each frame of a chunk
        fresh = fresh.join(F.broadcast(at), "frame_idx").join(mean.withColumnRenamed("frame_idx", "_left"), "_left")
        fresh = fresh.withColumn("disp", F.when(F.col("disp_sensor") > 0, F.col("disp_sensor")).otherwise(F.col("_mean")))
    whole = Graph(cut(graph.pixels.unionByName(fresh, allowMissingColumns=True).select(*names)), own, graph.k, graph.network, 0)
    pairs = [(int(k), n + m) for side in (left, right) for m, k in enumerate(side)]
    whole.add([*pairs, *([(j, i) for i, j in pairs] if dense else [])])
    for _ in range(turns):
        whole.update(n, n + len(times), motion_only=not dense, limited=True)
    return [whole.poses[n + m] for m in range(len(times))], whole.pixels.where(F.col("frame_idx") >= n) if dense else None
