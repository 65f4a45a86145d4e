"""Documents that hold passages of a benchmark, by spaced seeds and substitution-tolerant verification.

Words are lower-cased and cut at spaces, punctuation and symbols; in scripts
that are written without spaces each character is a word. A passage leaks
where WINDOW aligned words of a document and an item (all words of a shorter
item, without exception below five words) agree in at least 80 %. The masks of
the spaced seeds ignore fixed word positions; every way to substitute as many
words of a window as are allowed leaves one mask intact somewhere in it, so no
such window is missed. Items of few words have masks of their own, which are
looked up only where the benchmark holds such items. Hashes of both sides are
joined and the words around each hit are compared.

The benchmark's seeds reach the corpus scan as a bitmap of at most 2**LARGEST
bits; rows that pass it by chance fall out in the join. Each hit carries only
the words that a window of its mask can hold, equal surroundings of a seed meet
equal surroundings in the benchmark once, however many documents and items hold
them, and the verified ones find their documents and items again by a join.

Defined results: null or empty texts and items without words give no rows;
texts are read whole, however long, in blocks; a null doc_id or item_id is
reported as null; repeated rows count once; of windows that agree equally well
all count, for the outermost words; an empty table on either side gives an
empty result; of both tables only the id and ``text`` are read, so other
columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm import scratch
from tessella.llm.textkit import PUNCTUATION, mix, of_all_scripts, texts_words

WINDOW, LEAST, PERCENT = 13, 1, 80
#: Fixed masks by the least number of words of an item: together they survive any allowed substitutions
#: in so many words (none below five, one below ten, two beyond).
MASKS = {
    1: ("1",),
    2: ("11",),
    3: ("111",),
    4: ("1111",),
    5: ("111", "1101"),
    6: ("1111", "11011"),
    7: ("11011",),
    8: ("111011", "110111"),
    10: ("111011", "1101011", "1110011"),
    11: ("1101011", "1110011"),
    13: ("11101011", "11001111"),
}
SPAN = 2 * WINDOW - 1
#: The bitmap's size in bits, as powers of two.
SMALLEST, LARGEST = 16, 28
_STEP = np.uint64(0x9E3779B97F4A7C15)
_NONE_TEST, _NONE_ITEM = np.uint64(0), np.uint64(1)


def needed(words: int) -> int:
    """Words of a window that have to agree."""
    return -(-PERCENT * words // 100)


def masks_of(words: int) -> list[tuple[int, ...]]:
    """The masks, as word offsets, that find an item of so many words."""
    return [tuple(i for i, c in enumerate(m) if c == "1") for m in MASKS[max(n for n in MASKS if n <= words)]]


def reach(mask: tuple[int, ...]) -> int:
    """Words of the longest window that the mask has to find."""
    return max(n for n in range(LEAST, WINDOW + 1) if mask in masks_of(n))


def _seeds(hashes: np.ndarray, text_of: np.ndarray, mask: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which a mask fits into one text, and the hashes of the words it looks at."""
    span = mask[-1] + 1
    n = len(hashes) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.full(n, hash_of(mask), np.uint64)
    for i in mask:
        total = total * _STEP + hashes[i : i + n]
    fits = text_of[:n] == text_of[span - 1 :]
    at = np.flatnonzero(fits)
    return at, mix(total[at])


def hash_of(mask: tuple[int, ...]) -> np.uint64:
    return np.uint64(sum((i + 1) * 31**k for k, i in enumerate(mask)) % (1 << 61) + len(mask))


def _around(hashes: np.ndarray, first: np.ndarray, text_of: np.ndarray, at: np.ndarray, none: np.uint64, wide: int) -> np.ndarray:
    """The SPAN words around each position, with none outside of its text and of windows of so many words."""
    step = np.arange(-(WINDOW - 1), WINDOW)
    places = at[:, None] + step[None, :]
    inside = (places >= first[text_of[at]][:, None]) & (places < first[text_of[at] + 1][:, None]) & (np.abs(step) < wide)[None, :]
    return np.where(inside, hashes[np.clip(places, 0, len(hashes) - 1)], none)


_HIT = "id long, place int, words int, seed long, around binary"
_HIT_NAMES = [x.split()[0] for x in _HIT.split(", ")]


def _hits(masks: list[tuple[int, ...]], bitmap, bits: int, none: np.uint64):
    """Rows (id, text) to rows of seeds; with a bitmap only those that it holds."""
    #: Whether a mask is one of those of an item's number of words.
    used = {m: np.array([n >= LEAST and m in masks_of(n) for n in range(WINDOW + 1)]) for m in masks}
    wide = {m: reach(m) for m in masks}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None if bitmap is None else bitmap.value
        low, fold = np.uint64((1 << bits) - 1), np.uint64(32)
        for batch in batches:
            ids = batch.column("id")
            for i, j, hashes, first in texts_words(batch.column("text"), PUNCTUATION, of_all_scripts):
                hashes = np.maximum(hashes, np.uint64(2))
                count = np.diff(first)
                text_of = np.repeat(np.arange(j - i), count)
                for mask in masks:
                    at, seed = _seeds(hashes, text_of, mask)
                    if held is None:
                        ok = used[mask][np.minimum(count[text_of[at]], WINDOW)]
                    else:
                        ok = (held[seed & low] & held[(seed >> fold) & low]).astype(bool)
                    at, seed = at[ok], seed[ok]
                    if not len(at):
                        continue
                    where = text_of[at]
                    around = np.ascontiguousarray(_around(hashes, first, text_of, at, none, wide[mask]))
                    blobs = pa.Array.from_buffers(pa.binary(8 * SPAN), len(at), [None, pa.py_buffer(around.view(np.uint8))]).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays([ids.slice(i, j - i).take(pa.array(where)), pa.array((at - first[where]).astype(np.int32)), pa.array(count[where].astype(np.int32)), pa.array(seed.view(np.int64)), blobs], _HIT_NAMES)

    return run


_WINDOW = "seed long, around binary, item_around binary, item_words int, matched int, start int, stop int"


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of surroundings with a window that agrees: words that match in the best, first and last word of all, from the seed's place."""
    for batch in batches:
        if not batch.num_rows:
            continue
        test = np.frombuffer(b"".join(batch.column("around").to_pylist()), np.uint64).reshape(-1, SPAN)
        item = np.frombuffer(b"".join(batch.column("item_around").to_pylist()), np.uint64).reshape(-1, SPAN)
        size = np.asarray(batch.column("item_words"))
        same = (test == item).astype(np.int16)
        inside = ((test != _NONE_TEST) & (item != _NONE_ITEM)).astype(np.int16)
        best, start, stop = np.full(len(size), -1), np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        for w in np.unique(size):
            rows = np.flatnonzero(size == w)
            total = lambda x: np.cumsum(np.pad(x[rows], ((0, 0), (1, 0))), axis=1)
            hit, whole = total(same), total(inside)
            at = np.arange(WINDOW - int(w), WINDOW)  # windows that hold the seed's place
            got = np.where(whole[:, at + int(w)] - whole[:, at] == w, hit[:, at + int(w)] - hit[:, at], -1)
            fine = got >= needed(int(w))
            best[rows], start[rows], stop[rows] = got.max(axis=1), at[fine.argmax(axis=1)], at[len(at) - 1 - fine[:, ::-1].argmax(axis=1)] + int(w) - 1
        keep = best >= np.array([needed(int(w)) for w in size])
        mask = pa.array(keep)
        own = [batch.column(c).filter(mask) for c in ("seed", "around", "item_around", "item_words")]
        numbers = [pa.array(x[keep].astype(np.int32)) for x in (best, start - (WINDOW - 1), stop - (WINDOW - 1))]
        yield pa.RecordBatch.from_arrays([*own, *numbers], [x.split()[0] for x in _WINDOW.split(", ")])


def _rows(table: DataFrame, key: str) -> DataFrame:
    return table.select(F.col(key).cast("long").alias("id"), F.lower(F.col("text").cast("string")).alias("text")).where("text is not null and text <> ''")


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item that share a passage: doc_id, item_id, matched, first_word, last_word.

    matched is the largest number of agreeing words in one window; first_word
    and last_word enclose all windows of the pair in the document.
    """
    spark = docs.sparkSession
    every = sorted({m for n in range(LEAST, WINDOW + 1) for m in masks_of(n)})
    seeds = scratch.materialize(_rows(benchmark, "item_id").transform(scratch.arrow, _hits(every, None, 0, _NONE_ITEM), _HIT), "item-seeds")
    # The masks of short items count only where there are such items.
    sizes = [r.n for r in seeds.select(F.least("words", F.lit(WINDOW)).alias("n")).distinct().collect()]
    masks = sorted({m for n in sizes for m in masks_of(n)})
    bits = min(LARGEST, max(SMALLEST, (64 * seeds.count()).bit_length()))
    low = F.lit((1 << bits) - 1)
    places = seeds.select(F.explode(F.array(F.col("seed").bitwiseAND(low), F.shiftrightunsigned("seed", 32).bitwiseAND(low))).alias("bit"))
    words = places.select(F.shiftright("bit", 5).alias("w"), F.expr("shiftleft(1L, cast(bit & 31 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    # At most 2**(LARGEST - 5) rows of two numbers, whatever the benchmark.
    got = words.toPandas()
    packed = np.zeros(1 << (bits - 5), np.uint32)
    packed[got.w.to_numpy(np.int64)] = got.b.to_numpy(np.int64).astype(np.uint32)
    bitmap = spark.sparkContext.broadcast(_Bitmap(packed))
    hits = scratch.materialize(_rows(docs, "doc_id").transform(scratch.arrow, _hits(masks, bitmap, bits, _NONE_TEST), _HIT), "hits")

    size = F.least("words", F.lit(WINDOW)).alias("item_words")
    items = seeds.select("seed", F.col("around").alias("item_around"), size, F.col("id").alias("item_id")).distinct()
    tests = hits.select("seed", "around").distinct()
    pairs = tests.join(items.select("seed", "item_around", "item_words").distinct(), "seed").select("seed", "around", "item_around", "item_words")
    found = scratch.materialize(pairs.transform(scratch.arrow, _verify, _WINDOW), "windows")
    named = found.join(items, ["seed", "item_around", "item_words"]).groupBy("seed", "around", "item_id").agg(F.max("matched").alias("matched"), F.min("start").alias("start"), F.max("stop").alias("stop"))
    out = hits.select("seed", "around", F.col("id").alias("doc_id"), "place").join(named, ["seed", "around"])
    first, last = (F.col("place") + F.col("start")).cast("long"), (F.col("place") + F.col("stop")).cast("long")
    return out.groupBy("doc_id", "item_id").agg(F.max("matched").cast("long").alias("matched"), F.min(first).alias("first_word"), F.max(last).alias("last_word"))


class _Bitmap:
    """Bits that are looked up by arrays of numbers."""

    def __init__(self, packed: np.ndarray):
        self.packed = packed

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return (self.packed[at >> np.uint64(5)] >> (at & np.uint64(31)).astype(np.uint32)) & np.uint32(1)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any passage of the benchmark, all columns kept."""

    def one(rows: DataFrame) -> DataFrame:
        gone = overlaps(rows, benchmark).select("doc_id").distinct()
        return scratch.without(rows, scratch.materialize(gone, "contaminated"), "doc_id")

    return scratch.by_row(docs, one, nulls_first=True)
