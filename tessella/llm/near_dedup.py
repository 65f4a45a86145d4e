"""Near-duplicate documents by banded MinHash, odd-sketch verification and exact confirmation.

Every document gets SAMPLES MinHash samples of its distinct word shingles.
Bands of them bring similar documents together; the samples are also folded
into an odd sketch, a bitmap in which each (sample number, sample) flips one
bit. The population count of the XOR of two sketches estimates the similarity
of a candidate pair; pairs far below the threshold go, all others are confirmed
on their full shingle sets.

Documents with equal shingle sets (by SHA-256 of the whole set) are one node. A
bucket does not emit all its pairs: first each member meets the bucket's
smallest id only, and the confirmed links are contracted to components. Where
more than BLOCK members of a bucket stay outside of its largest component, all
that are apart from it meet one of them, drawn by chance, and so on while that
finds links. Then the members outside of the largest component, in blocks,
meet the other members, in blocks, and only links that join components leave
their task. So no link between components is lost except where the bands or
the sketch miss a pair: a pair at the threshold shares no band with a chance
of about (1 - t**6)**36, 4e-8 at 0.85, and exceeds the sketch's bound about as
rarely.

Defined results: a null text, an empty one and one without words have 0
shingles and no links; a text of fewer than ``width`` words is one shingle;
texts are read whole, however long, and their sets confirmed whole; a null
doc_id is linked with nothing and stays; doc_id identifies a document, so rows
that repeat it are one node; of equally similar documents every one is linked,
and the smallest doc_id names the component; an empty table gives an empty
result; only ``doc_id`` and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm import scratch
from tessella.llm.components import components
from tessella.llm.textkit import mix, shingles, texts_words

ROWS, BANDS = 6, 36
SAMPLES = ROWS * BANDS
SKETCH_WORDS = 8
SKETCH_BITS = 64 * SKETCH_WORDS
#: Standard deviations of the estimate that the sketch's bound lies below the threshold.
SLACK = 5.5
_WIDE = 4096
#: Members of one block of a large bucket, and rounds in which a member drawn by chance meets the others at most.
BLOCK, DRAWS = 512, 8

_rng = np.random.Generator(np.random.PCG64(20240229))
_MULTIPLY = _rng.integers(0, 1 << 31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)
_SIGNATURE = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, " + ", ".join(f"s{i} long" for i in range(SKETCH_WORDS))


def minhash(hashes: np.ndarray) -> np.ndarray:
    """The SAMPLES smallest values of as many permutations of 32-bit foldings of the hashes."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full(SAMPLES, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(short), _WIDE):
        x = short[i : i + _WIDE]
        np.minimum(out, (_MULTIPLY[:, None] * x[None, :] + _ADD[:, None]).min(axis=1), out=out)
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One key for each band of samples (documents x SAMPLES); keys of different bands differ."""
    rows = samples.reshape(len(samples), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2]).copy()
    for i in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, i])
    return key.view(np.int64)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps (documents x SKETCH_WORDS) of the numbered samples."""
    numbered = samples.astype(np.uint64) | (np.arange(samples.shape[1], dtype=np.uint64) << np.uint64(32))
    at = (mix(numbered + np.uint64(0x51ED270B)) % np.uint64(SKETCH_BITS)).astype(np.int64)
    flips = np.zeros((len(samples), SKETCH_BITS), np.uint8)
    np.add.at(flips, (np.arange(len(samples))[:, None], at), 1)
    return np.packbits(flips & 1, axis=1, bitorder="little").view(np.int64)


def sketch_bound(threshold: float) -> int:
    """The largest XOR population count that a pair at the threshold is expected to show."""
    sd = math.sqrt(threshold * (1 - threshold) / SAMPLES)
    least = max(0.0, threshold - SLACK * sd)
    return math.ceil(SKETCH_BITS / 2 * (1 - math.exp(-4 * SAMPLES * (1 - least) / SKETCH_BITS)) + 2)


def _sign(width: int):
    names = [x.split()[0] for x in _SIGNATURE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for i, j, hashes, first in texts_words(batch.column("text")):
                samples = np.full((j - i, SAMPLES), np.iinfo(np.uint32).max, np.uint32)
                counts, digest = np.zeros(j - i, np.int64), np.zeros((j - i, 2), np.int64)
                for d in range(j - i):
                    own = shingles(hashes[first[d] : first[d + 1]], width)
                    counts[d] = len(own)
                    if len(own):
                        samples[d] = minhash(own)
                        digest[d] = np.frombuffer(hashlib.sha256(own).digest(), np.int64, 2)
                bands = band_keys(samples)
                sketch = odd_sketches(samples)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, BANDS, dtype=np.int32)), pa.array(bands.ravel()))
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(counts), pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy()), lists, *[pa.array(np.ascontiguousarray(sketch[:, k])) for k in range(SKETCH_WORDS)]], names)

    return run


def signatures(docs: DataFrame, width: int = 5) -> DataFrame:
    """doc_id, n_shingles, a 128-bit digest of the shingle set, band keys and odd sketch."""
    return _texts(docs).transform(scratch.arrow, _sign(width), _SIGNATURE)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for i, j, hashes, first in texts_words(batch.column("text")):
                blobs = [shingles(hashes[first[d] : first[d + 1]], width).tobytes() for d in range(j - i)]
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(blobs, pa.binary())], ["doc_id", "blob"])

    return run


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, of two sorted sets."""
    both = np.concatenate((x, y))
    both.sort(kind="stable")
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= percent * (len(both) - common)


def _confirm(percent: int):
    """Pairs with both sets to those with 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for r, (x, y) in enumerate(zip(batch.column("blob_a"), batch.column("blob_b"), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                keep[r] = similar(x, y, percent)
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])

    return run


def _side(sig: DataFrame, name: str) -> DataFrame:
    return sig.select(F.col("doc_id").alias(name), F.col("n_shingles").alias(f"n_{name}"), *[F.col(f"s{i}").alias(f"s{i}_{name}") for i in range(SKETCH_WORDS)])


def _likely(percent: int) -> str:
    """What two documents with similar sets satisfy: sizes that allow the similarity, and near sketches."""
    distance = " + ".join(f"bit_count(s{i}_a ^ s{i}_b)" for i in range(SKETCH_WORDS))
    return f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b) and {distance} <= {sketch_bound(percent / 100)}"


def _confirmed(docs: DataFrame, pairs: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar. Only texts that occur in pairs are fetched."""
    ids = scratch.materialize(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    sets = scratch.materialize(scratch.only(_texts(docs), ids, "doc_id").transform(scratch.arrow, _sets(width), "doc_id long, blob binary"), "sets")
    left = sets.select(F.col("doc_id").alias("a"), F.col("blob").alias("blob_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("blob").alias("blob_b"))
    found = pairs.join(left, "a").join(right, "b").select("a", "b", "blob_a", "blob_b").transform(scratch.arrow, _confirm(percent), "a long, b long")
    return scratch.materialize(found, "links")


_PLACE = "key long, low int, high int, role int, id long"


def _block_pairs(rows: DataFrame) -> DataFrame:
    """Members of apart buckets dealt to pairs of blocks (low, high): role 1 outside of the largest component, role 0 all of them.

    Rows have out, the number of members outside, and members. A member is
    copied once for each block of those outside, one outside also once for each block of members.
    """
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    every = lambda n: F.sequence(F.lit(0), blocks(n) - 1)
    own = lambda n: F.pmod(F.xxhash64(F.lit(n), "id"), blocks(n)).cast("int")
    outside = F.col("part") != F.col("largest")
    tests = rows.where(outside).withColumn("role", F.lit(1)).withColumn("low", own("out")).withColumn("high", F.explode(every("members")))
    others = rows.withColumn("role", F.lit(0)).withColumn("high", own("members")).withColumn("low", F.explode(every("out")))
    return tests.unionByName(others).withColumn("outside", outside).drop("out", "members", "largest")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of rows with equal (key, low, high) of a sorted partition."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        place = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in ("key", "low", "high")], axis=1)
        starts = [0, *(np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1).tolist(), len(place)]
        for i, j in zip(starts, starts[1:], strict=False):
            if held and tuple(place[i]) != last:
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(i, j - i))
            last = tuple(place[i])
    if held:
        yield pa.concat_tables(held)


def _near_pairs(group: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a group that may be linked across parts: their numbers, and the distances of their sketches."""
    role, part, n, ids = (group[c].to_numpy().astype(np.int64) for c in ("role", "part", "n_shingles", "id"))
    outside = np.asarray(group["outside"])
    sketch = np.stack([group[f"s{i}"].to_numpy() for i in range(SKETCH_WORDS)], axis=1).view(np.uint64)
    x, y = np.flatnonzero(role == 1), np.flatnonzero(role == 0)
    distance = np.zeros((len(x), len(y)), np.int64)
    for k in range(SKETCH_WORDS):
        distance += np.bitwise_count(sketch[x, k][:, None] ^ sketch[y, k][None, :])
    a, b = n[x][:, None], n[y][None, :]
    fine = (distance <= sketch_bound(percent / 100)) & (part[x][:, None] != part[y][None, :]) & (100 * np.minimum(a, b) >= percent * np.maximum(a, b))
    # Two that are both outside meet twice.
    fine &= ~outside[y][None, :] | (ids[x][:, None] < ids[y][None, :])
    r, c = np.nonzero(fine)
    return x[r], y[c], distance[r, c]


def _near_members(percent: int):
    """The members of groups that have a likely partner in another part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            x, y, _ = _near_pairs(group, percent)
            if len(x):
                yield from group.select([c.split()[0] for c in _PLACE.split(", ")]).take(np.unique(np.concatenate((x, y)))).combine_chunks().to_batches()

    return run


def _links_between(percent: int):
    """Confirmed links that join parts within a group; pairs whose parts are joined already need no test."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            x, y, distance = _near_pairs(group, percent)
            key = group["key"][0].as_py()
            bands = np.stack(group["bands"].to_numpy())
            band = int((bands[0] == key).argmax())
            # A pair is tested in the first of its common bands.
            first = ~(bands[x, :band] == bands[y, :band]).any(axis=1) if band else np.ones(len(x), bool)
            x, y, distance = x[first], y[first], distance[first]
            ids, part = group["id"].to_pylist(), group["part"].to_pylist()
            sets = [np.frombuffer(b, np.uint64) for b in group["blob"].to_pylist()]
            up: dict[int, int] = {}

            def root(p: int, up=up) -> int:
                while p in up:
                    p = up[p]
                return p

            found: tuple[list[int], list[int]] = ([], [])
            for k in np.argsort(distance, kind="stable").tolist():
                i, j = int(x[k]), int(y[k])
                p, q = root(part[i]), root(part[j])
                if p != q and similar(sets[i], sets[j], percent):
                    up[max(p, q)] = min(p, q)
                    found[0].append(ids[i])
                    found[1].append(ids[j])
            if found[0]:
                yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64())], ["a", "b"])

    return run


def _apart(buckets: DataFrame, label: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of buckets (key, id, part), and the buckets (key, largest, members, out) that hold several parts."""
    named = buckets.join(label.withColumnRenamed("component", "part"), "id", "left").select("key", "id", F.coalesce("part", "id").alias("part"))
    named = scratch.materialize(named, "named")
    sizes = named.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"))
    apart = sizes.groupBy("key").agg(F.max(F.struct("n", "part")).alias("most"), F.sum("n").alias("members"))
    apart = apart.select("key", F.col("most.part").alias("largest"), "members", (F.col("members") - F.col("most.n")).alias("out")).where("out > 0")
    return named, scratch.materialize(apart, "apart")


def near_groups(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when their sets of width-word shingles have
    100 * intersection >= percent * union; component_id is the smallest doc_id
    that a document reaches by links.
    """
    sig = scratch.materialize(signatures(docs, width), "signatures")
    whole = sig.where("n_shingles > 0 and doc_id is not null")
    classes = scratch.materialize(whole.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("node")), "classes")
    nodes = whole.join(classes, ["set_a", "set_b"]).where("doc_id = node").drop("node").dropDuplicates(["doc_id", "set_a", "set_b"])
    nodes = scratch.materialize(nodes, "nodes")

    members = nodes.select(F.explode("bands").alias("key"), F.col("doc_id").alias("id"))
    shared = members.groupBy("key").agg(F.min("id").alias("centre"), F.max("id").alias("last")).where("centre < last").select("key", "centre")
    buckets = scratch.materialize(members.join(shared, "key"), "buckets")

    likely = _likely(percent)
    stars = buckets.where("id <> centre").select(F.col("id").alias("a"), F.col("centre").alias("b")).distinct()
    stars = stars.join(_side(nodes, "a"), "a").join(_side(nodes, "b"), "b").where(likely).select("a", "b")
    stars = scratch.materialize(stars, "stars")
    links = _confirmed(docs, stars, percent, width)
    label = components(links)

    # Members of one bucket that the first links leave apart.
    for draw in range(DRAWS + 1):
        named, apart = _apart(buckets, label)
        wide = apart.where(F.col("out") > BLOCK)
        if draw == DRAWS or not wide.limit(1).count():
            break
        drawn = named.join(wide, "key").where("part <> largest").groupBy("key").agg(F.min(F.struct(F.xxhash64(F.lit(draw), "id"), "id", "part")).alias("one"))
        meet = named.join(drawn, "key").where("part <> one.part").select(F.col("id").alias("a"), F.col("one.id").alias("b")).distinct()
        meet = meet.join(_side(nodes, "a"), "a").join(_side(nodes, "b"), "b").where(likely).select("a", "b")
        more = _confirmed(docs, scratch.materialize(meet, "stars"), percent, width)
        if not more.limit(1).count():
            break
        links = links.unionByName(more)
        label = components(links)
    sketches = nodes.select(F.col("doc_id").alias("id"), "n_shingles", *[f"s{i}" for i in range(SKETCH_WORDS)])
    open_ = scratch.materialize(_block_pairs(named.join(apart, "key").join(sketches, "id")), "open")
    active = open_.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high").transform(scratch.arrow, _near_members(percent), _PLACE)
    active = scratch.materialize(active, "active")
    if active.limit(1).count():
        ids = scratch.materialize(active.select(F.col("id").alias("doc_id")).distinct(), "ids")
        sets = scratch.only(_texts(docs), ids, "doc_id").transform(scratch.arrow, _sets(width), "doc_id long, blob binary").withColumnRenamed("doc_id", "id")
        bands = nodes.select(F.col("doc_id").alias("id"), "bands")
        full = active.join(open_, ["key", "low", "high", "role", "id"]).join(sets, "id").join(bands, "id")
        found = full.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high").transform(scratch.arrow, _links_between(percent), "a long, b long")
        more = scratch.materialize(found, "links")
        if more.limit(1).count():
            label = components(links.unionByName(more))

    of_class = classes.join(label.withColumnRenamed("id", "node"), "node", "left").select("set_a", "set_b", F.coalesce("component", "node").alias("reached"))
    out = sig.join(of_class.withColumn("some", F.lit(True)), (sig["set_a"] == of_class["set_a"]) & (sig["set_b"] == of_class["set_b"]) & (sig["n_shingles"] > 0) & sig["doc_id"].isNotNull(), "left")
    component = F.coalesce("reached", "doc_id").alias("component_id")
    return out.select("doc_id", "n_shingles", component, F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_copies(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """The documents with one of each group of near duplicates, all columns kept."""

    def one(rows: DataFrame) -> DataFrame:
        gone = near_groups(rows, percent, width).where("not kept").select("doc_id").distinct()
        return scratch.without(rows, scratch.materialize(gone, "near-copies"), "doc_id")

    return scratch.by_row(docs, one, nulls_first=False)
