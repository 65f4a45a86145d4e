"""Tokenise whole documents and pack their pieces into sequences by bulk-synchronous best fit.

A round sorts the pieces that are left and the gaps of all sequences by length
and sweeps them from the largest: every piece goes to its successor, the
smallest gap that holds it and that no longer piece has taken; which of equal
pieces meets which of equal gaps is decided by rank. Then the gaps are updated
and the next round begins, until no piece is left. Where nothing fits, as many
sequences are opened as the pieces need at least. The long pieces, of which a
sequence holds one, go before all others.

Lengths are whole numbers up to the capacity, so equal lengths form runs, and a
round sorts, sweeps and ranks runs, at most some thousands whatever the number
of documents. The sweep is a bracket matching: gaps raise a level, pieces lower
it again, and a piece meets the last gap before it that covers its level. Where
a length has many more pieces than there are gaps, several go to one gap
together. The rows themselves never move: they are ranked within their length
by distributed counts and find their place by a join with the rounds' rank
ranges.

Defined results: a null or empty text is the one id 0; only texts longer than
the capacity are cut, the first piece takes the rest of the division, however
long the text; equal lengths are ranked by a hash of the row, and equal rows
are packed once each, whichever comes first; an empty table gives an empty
result; a null doc_id stays null; only ``doc_id`` and ``text`` are read, so
other columns cannot clash.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm import scratch

CAPACITY = 2048
END = b"\0\0\0\0"
#: Chunks whose ids are remembered within a task; beyond that it starts afresh.
CACHE = 200_000
#: The split of this byte-level vocabulary, and the text of its special token.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_loaded: dict[str, Encoder] = {}


def default_tokenizer() -> str:
    """The path of the installed public vocabulary file."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


class Encoder:
    """The ids of a byte-level tokenizers file, as little-endian 32-bit bytes.

    The tokenizers library itself spends several times as long on these ids,
    so its vocabulary is given to tiktoken, which merges by the same ranks.
    Texts that hold the string of a special token go to tokenizers.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = [x["content"] for x in spec.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.ordinary = tiktoken.Encoding("bytes", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.known: dict[str, bytes] = {}

    @staticmethod
    def _raw(ids: list[int]) -> bytes:
        return b"".join([i.to_bytes(4, "little") for i in ids])

    def encode(self, text: str) -> bytes:
        if self.special and self.special.search(text):
            return self._raw(self.exact.encode(text, add_special_tokens=False).ids)
        # A space between two other characters always begins a token, so chunks that begin there have ids of their own.
        first, *rest = text.split(" ")
        if first != first.strip() or not first and rest:
            return self._slow(text)
        known = self.known
        found = [known.get(x) for x in rest]
        if None in found:
            if len(known) > CACHE:
                known.clear()
            for i, ids in enumerate(found):
                if ids is None:
                    x = rest[i]
                    if not x or x[0].isspace() or x[-1].isspace():
                        return self._slow(text)
                    ids = known.get(x)
                    if ids is None:
                        ids = self._raw(self.ordinary(" " + x))
                        if len(x) < 64:
                            known[x] = ids
                    found[i] = ids
        return self._raw(self.ordinary(first)) + b"".join(found)

    def _slow(self, text: str) -> bytes:
        first, *rest = _LONE_SPACE.split(text)
        return self._raw(self.ordinary(first)) + b"".join([self._raw(self.ordinary(" " + x)) for x in rest])


def encoder(path: str) -> Encoder:
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def cut(ids: bytes, capacity: int) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's ids."""
    n = len(ids) // 4
    edges = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
    return [(i, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def pieces(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, ids_crc32."""
    path = tokenizer_path or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        encoder(path).known.clear()
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, batch.column("text"), strict=True):
                for piece in cut(encode(text.as_py() or "") + END, capacity):
                    for column, value in zip(columns, (doc_id, *piece), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PIECE_TYPES, strict=True)], [x.split()[0] for x in _PIECES.split(", ")])
        encoder(path).known.clear()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).transform(scratch.arrow, run, _PIECES)


#: Runs of pieces (n of a length, from rank first), of gaps (n sequences with room for size, from first), and of pieces that have their place.
_RUNS = "kind string, size long, first long, n long, length long, bundle long, low long, high long, offset long"
_NAMES = [x.split()[0] for x in _RUNS.split(", ")]
#: Rounds in which only pieces longer than half the capacity take part, at most.
LONG_ROUNDS = 9
#: Pieces longer than the k-th part of the capacity are counted for k up to this: k - 1 of them fill a sequence.
_SHARES = 9


def _run(kind: str, **columns: Column) -> list[Column]:
    """The columns of a run; those that are not given are null."""
    types = dict(x.split() for x in _RUNS.split(", "))
    return [F.lit(kind).alias("kind"), *[columns.get(n, F.lit(None)).cast(types[n]).alias(n) for n in _NAMES[1:]]]


def _sweep(state: DataFrame, least: int, capacity: int) -> DataFrame:
    """One round over runs of gaps and pieces: pieces longer than least meet their successors."""
    eligible = (F.col("kind") == "gap") | (F.col("size") > least)
    # The runs are so few that one task sorts and sweeps them, without a shuffle between its steps.
    state = state.coalesce(1)
    waiting = state.where(~eligible).select(_NAMES)
    gap = F.col("kind") == "gap"
    down = [F.desc("size"), F.asc("kind"), F.asc("first")]
    sort = Window.orderBy(*down).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    room, top = F.sum(F.when(gap, F.col("n")).otherwise(0)).over(sort), F.max(F.when(gap, F.col("size"))).over(Window.partitionBy())
    seen = state.where(eligible).select("kind", "size", "first", "n", room.alias("room"), top.alias("top"))
    # Pieces that go to one gap together, as all gaps that hold them would have to take on average.
    bundle = F.when(gap, F.lit(1)).otherwise(F.greatest(F.lit(1), F.least(F.floor(F.col("n") / F.greatest("room", F.lit(1))), F.floor(F.col("top") / F.col("size")))))
    seen = seen.withColumn("bundle", bundle.cast("long")).withColumn("whole", F.floor(F.col("n") / F.col("bundle")))
    one = F.struct((F.col("bundle") * F.col("size")).alias("unit"), F.col("whole").alias("n"), F.col("first").alias("first"), F.col("bundle").alias("bundle"))
    rest = F.struct(F.col("size").alias("unit"), (F.col("n") - F.col("whole") * F.col("bundle")).alias("n"), (F.col("first") + F.col("whole") * F.col("bundle")).alias("first"), F.lit(1).cast("long").alias("bundle"))
    units = seen.select("kind", "size", F.inline(F.array(one, rest))).where("n > 0")

    order = Window.orderBy(F.desc("unit"), F.asc("kind"), F.asc("size"), F.asc("first"))
    before, after = order.rowsBetween(Window.unboundedPreceding, Window.currentRow), order.rowsBetween(1, Window.unboundedFollowing)
    events = units.withColumn("at", F.row_number().over(order)).withColumn("sum", F.sum(F.when(gap, F.col("n")).otherwise(-F.col("n"))).over(before))
    # The level never falls below zero: a piece that meets no gap is left.
    events = events.withColumn("level", F.col("sum") - F.least(F.lit(0), F.min("sum").over(before)))
    events = events.withColumn("was", F.lag("level", 1, 0).over(order)).withColumn("later", F.min("level").over(after))
    events = events.withColumn("lo", F.least("was", "level")).withColumn("hi", F.greatest("was", "level"))

    gaps = events.where(gap).select(F.col("at").alias("gap_at"), F.col("unit").alias("gap"), F.col("first").alias("gap_first"), F.col("lo").alias("gap_lo"), F.col("hi").alias("gap_hi"))
    pieces = events.where(~gap & (F.col("lo") < F.col("hi"))).select("at", "unit", F.col("size").alias("length"), "first", "bundle", "lo", "hi")
    over = (F.col("gap_at") < F.col("at")) & (F.col("gap_lo") < F.col("hi")) & (F.col("gap_hi") > F.col("lo"))
    # Of the gaps that cover a level before a piece the last one is its own; those behind it cap the levels.
    nearer = Window.partitionBy("at").orderBy(F.desc("gap_at")).rowsBetween(Window.unboundedPreceding, -1)
    met = gaps.join(F.broadcast(pieces), over).withColumn("cap", F.min("gap_lo").over(nearer))
    met = met.withColumn("from", F.greatest("lo", "gap_lo")).withColumn("to", F.least("hi", "gap_hi", F.coalesce("cap", "hi"))).where(F.col("from") < F.col("to"))
    number = F.col("to") - F.col("from")
    rank, sequence = F.col("first") + (F.col("from") - F.col("lo")) * F.col("bundle"), F.col("gap_first") + F.col("from") - F.col("gap_lo")
    placed = F.struct(*_run("place", first=sequence, length=F.col("length"), bundle=F.col("bundle"), low=rank, high=rank + number * F.col("bundle"), offset=capacity - F.col("gap")))
    smaller = F.struct(*_run("gap", size=F.col("gap") - F.col("unit"), first=sequence, n=number))
    done = met.select(F.inline(F.array(placed, smaller))).where("kind = 'place' or size > 0")

    free = F.least("hi", F.coalesce("later", "hi")) - F.col("lo")
    taken = F.col("hi") - F.col("lo")
    left = events.select(
        F.when(gap, F.struct(*_run("gap", size=F.col("unit"), first=F.col("first"), n=free)))
        .otherwise(F.struct(*_run("piece", size=F.col("size"), first=F.col("first") + taken * F.col("bundle"), n=(F.col("n") - taken) * F.col("bundle"))))
        .alias("run")
    ).select("run.*").where("n > 0")
    return waiting.unionByName(done).unionByName(left)


def _needs(state: DataFrame, least: int, capacity: int) -> tuple[int, int, int]:
    """How many pieces longer than least are left, the shortest length among them, and the sequences to open for those that no gap holds."""
    runs = state.where("kind <> 'place'").coalesce(1).groupBy("kind", "size").agg(F.sum("n").alias("n")).collect()  # one row for each length and each gap's size
    top = max((r["size"] for r in runs if r["kind"] == "gap"), default=0)
    left = [(r["size"], r["n"]) for r in runs if r["kind"] == "piece" and r["size"] > least]
    homeless = [(size, n) for size, n in left if size > top]
    need = [-(-sum(size * n for size, n in homeless) // capacity)]
    # Of pieces longer than the k-th part of the capacity a sequence holds k - 1.
    need += [-(-sum(n for size, n in homeless if size * k > capacity) // (k - 1)) for k in range(2, _SHARES)]
    return sum(n for _, n in left), min((size for size, _ in left), default=0), max(need)


def rounds(lengths: DataFrame, capacity: int) -> DataFrame:
    """Rounds of best fit over lengths (length, n): length, low, high, first, bundle, offset.

    The pieces of a length with ranks from low to high go to sequences from
    first on, ``bundle`` to each, one behind the other from offset.
    """
    spark = lengths.sparkSession
    state = scratch.materialize(lengths.select(_run("piece", size=F.col("length"), first=F.lit(0), n=F.col("n"))), "lengths")
    sequences, least, turn, places = 0, capacity // 2, 0, [state.where("kind = 'place'")]
    while True:
        left, shortest, fresh = _needs(state, least, capacity)
        if least and (not left or turn == LONG_ROUNDS):
            least = 0
            left, shortest, fresh = _needs(state, least, capacity)
        if not left:
            break
        # Gaps that no piece fits any more are finished.
        now = state.where((F.col("kind") == "piece") | (F.col("kind") == "gap") & (F.col("size") >= (1 if least else shortest)))
        if fresh:
            now = now.unionByName(spark.range(1, numPartitions=1).select(_run("gap", size=F.lit(capacity), first=F.lit(sequences), n=F.lit(fresh))))
            sequences += fresh
        state = scratch.materialize(_sweep(now, least, capacity).coalesce(1), "round")
        places.append(state.where("kind = 'place'"))
        turn += 1
    out = places[0]
    for p in places[1:]:
        out = out.unionByName(p)
    return out.select("length", "low", "high", "first", "bundle", "offset")


def place(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32), each with sequence_id and offset."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)).cast("int"))
    counts = scratch.materialize(rows.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "counts")
    before = counts.select("part", "length", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    found = scratch.materialize(rounds(counts.groupBy("length").agg(F.sum("n").alias("n")), capacity).coalesce(1), "places")
    local = F.row_number().over(Window.partitionBy("part", "length").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = rows.withColumn("local", local).join(before, ["part", "length"]).withColumn("rank", F.col("before") + F.col("local"))
    # The places' number is bounded by the capacity alone.
    placed = ranked.join(F.broadcast(found), (ranked["length"] == found["length"]) & (ranked["rank"] >= found["low"]) & (ranked["rank"] < found["high"]))
    at, own = F.col("rank") - F.col("low"), ranked["length"]
    sequence = F.col("first") + F.floor(at / F.col("bundle"))
    return placed.select("doc_id", "piece", "start", own, "ids_crc32", sequence.cast("long").alias("sequence_id"), (F.col("offset") + at % F.col("bundle") * own).alias("offset"))


def pack(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return place(scratch.materialize(pieces(docs, tokenizer_path, capacity), "pieces"), capacity)
