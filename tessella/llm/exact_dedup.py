"""Exact de-duplication by a Golomb-coded fingerprint exchange.

1. Every scan partition cuts its rows into blocks. For each owner (a range of
   fingerprints) a block keeps its distinct fingerprints sorted, Golomb-Rice
   coded, beside the rows' ids and digests, which stay behind.
2. Owners receive the coded fingerprints alone and return, for each block, a
   bitmap of those that any other block holds too.
3. Rows whose bit is clear are unique and finished. The texts of the others,
   the suspects, are shuffled and compared byte for byte.

Owners grow with the rows, so that each holds a bounded number of fingerprints.
Rows of large groups (a bounded number of them) find their group by a broadcast
and are not dealt by its digest.

Defined results: a null text counts as empty, empty texts equal one another;
of equal texts the largest doc_id stays (a null doc_id never stays beside
another); rows that repeat both doc_id and text all point at that doc_id; texts
are hashed and compared whole, however long; an empty table gives an empty
result; only ``doc_id`` and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.llm import scratch
from tessella.llm.textkit import mix

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of one block; a block's bitmaps and lists are held in memory together.
BLOCK_ROWS = 1 << 18
#: Fingerprints that one owner is expected to hold at most; it sorts them in memory.
OWNER_ROWS = 1 << 22
#: A group of equal texts beyond this number of rows, and beyond one row in 2**LARGE_BITS, is large: there are 2**LARGE_BITS at most.
LARGE_ROWS, LARGE_BITS = 64, 16
#: Bits of a fingerprint beyond log2 of the number of rows: one row in 2**SPARE becomes a false suspect.
SPARE_BITS = 12

_BLOCKS = "block long, owner int, k int, n int, quotients binary, remainders binary, counts binary, doc_ids binary, digests binary, nulls binary"


def rice_encode(values: np.ndarray) -> tuple[int, bytes, bytes]:
    """Sorted distinct values as Golomb-Rice codes of their gaps: (bits of a remainder, unary quotients, remainders)."""
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    if not len(gaps):
        return 0, b"", b""
    mean = int(values[-1]) // len(values)
    k = max(0, mean.bit_length() - 1)
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    stops = np.cumsum(quotients + 1) - 1
    unary = np.ones(int(stops[-1]) + 1, np.uint8)
    unary[stops] = 0
    bits = ((gaps[:, None] >> np.arange(k, dtype=np.uint64)[None, :]) & np.uint64(1)).astype(np.uint8)
    return k, np.packbits(unary).tobytes(), np.packbits(bits.ravel()).tobytes()


def rice_decode(k: int, n: int, unary: bytes, remainders: bytes) -> np.ndarray:
    """The values that rice_encode was given."""
    if not n:
        return np.zeros(0, np.uint64)
    stops = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)) == 0)[:n]
    quotients = np.diff(stops, prepend=-1) - 1
    gaps = quotients.astype(np.uint64) << np.uint64(k)
    if k:
        bits = np.unpackbits(np.frombuffer(remainders, np.uint8), count=n * k).reshape(n, k)
        gaps += (bits.astype(np.uint64) << np.arange(k, dtype=np.uint64)[None, :]).sum(axis=1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)


def _normal(text):
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def _blocks(bits: int, owners: int):
    """Rows (doc_id, fp, digest) of a partition to one row for each block and owner."""

    def pack(number: int, ids: pa.Array, fp: np.ndarray, digest: np.ndarray) -> pa.RecordBatch:
        fp = fp.view(np.uint64) >> np.uint64(64 - bits)
        owner = (mix(fp) % np.uint64(owners)).astype(np.int64)
        nulls = np.asarray(ids.is_null())
        doc_ids = np.asarray(ids.fill_null(0), dtype=np.int64)
        order = np.lexsort((fp, owner))
        out: dict[str, list] = {name.split()[0]: [] for name in _BLOCKS.split(", ")}
        edges = np.searchsorted(owner[order], np.arange(owners + 1))
        for o in range(owners):
            own = order[edges[o] : edges[o + 1]]
            if not len(own):
                continue
            values, counts = np.unique(fp[own], return_counts=True)
            k, unary, rest = rice_encode(values)
            for name, value in zip(out, (number, o, k, len(values), unary, rest, counts.astype(np.int32).tobytes(), doc_ids[own].tobytes(), digest[own].tobytes(), np.packbits(nulls[own]).tobytes()), strict=True):
                out[name].append(value)
        kinds = {"block": pa.int64(), "owner": pa.int32(), "k": pa.int32(), "n": pa.int32()}
        return pa.RecordBatch.from_arrays([pa.array(v, kinds.get(c, pa.binary())) for c, v in out.items()], list(out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, number, held, rows = TaskContext.get().partitionId() << 32, 0, [], 0

        def flush() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            digest = np.frombuffer(b"".join(table["digest"].to_pylist()), np.uint8).reshape(-1, 32)
            return pack(base + number, table["doc_id"].combine_chunks(), table["fp"].to_numpy(), digest)

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                held.append(piece := batch.slice(at, BLOCK_ROWS))
                rows += piece.num_rows
                if rows >= BLOCK_ROWS:
                    yield flush()
                    number, held, rows = number + 1, [], 0
        if rows:
            yield flush()

    return run


def _owner(frame: pd.DataFrame) -> pd.DataFrame:
    """For one owner: the bitmap of each block's fingerprints that another block holds too."""
    values = [rice_decode(k, n, q, r) for k, n, q, r in zip(frame.k, frame.n, frame.quotients, frame.remainders, strict=True)]
    flat = np.concatenate(values)
    order = np.argsort(flat, kind="stable")
    ranked = flat[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(flat), bool)
    twice[1:] |= same
    twice[:-1] |= same
    flags = np.empty(len(flat), bool)
    flags[order] = twice
    edges = np.cumsum([0, *frame.n])
    return pd.DataFrame({"block": frame.block, "owner": frame.owner, "bitmap": [np.packbits(flags[a:b]).tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]})


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with their bitmaps to rows (doc_id, digest, suspect)."""
    for batch in batches:
        for row in batch.to_pylist():
            counts = np.frombuffer(row["counts"], np.int32)
            held = np.unpackbits(np.frombuffer(row["bitmap"], np.uint8), count=row["n"]).astype(bool) | (counts > 1)
            n = int(counts.sum())
            nulls = np.unpackbits(np.frombuffer(row["nulls"], np.uint8), count=n).astype(bool)
            ids = pa.array(np.frombuffer(row["doc_ids"], np.int64), pa.int64(), mask=nulls)
            digests = pa.Array.from_buffers(pa.binary(32), n, [None, pa.py_buffer(row["digests"])]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([ids, digests, pa.array(np.repeat(held, counts))], ["doc_id", "digest", "suspect"])


def digests(docs: DataFrame, owners: int | None = None) -> DataFrame:
    """doc_id, digest (SHA-256 of the normal text) and suspect, by the exchange; unique rows have suspect = false."""
    spark = docs.sparkSession
    rows = docs.count()
    bits = min(64, max(24, rows.bit_length() + SPARE_BITS))
    owners = owners or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // OWNER_ROWS))
    normal = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _normal(F.col("text")).alias("t"))
    keyed = normal.select("doc_id", F.xxhash64("t").alias("fp"), F.unhex(F.sha2("t", 256)).alias("digest"))
    blocks = scratch.materialize(keyed.transform(scratch.arrow, _blocks(bits, owners), _BLOCKS), "fingerprints")
    sent = blocks.select("owner", "block", "k", "n", "quotients", "remainders")
    bitmaps = sent.groupBy("owner").applyInPandas(_owner, "block long, owner int, bitmap binary")
    return blocks.join(bitmaps, ["block", "owner"]).transform(scratch.arrow, _unpack, "doc_id long, digest binary, suspect boolean")


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = scratch.materialize(digests(docs), "digests")
    sha = F.lower(F.hex("digest")).alias("text_sha256")
    alone = rows.where("not suspect").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), sha)

    suspects = rows.where("suspect")
    ids = suspects.select("doc_id").where("doc_id is not null").distinct()
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _normal(F.col("text")).alias("t"))
    texts = scratch.only(named, ids, "doc_id").unionByName(named.where("doc_id is null"))
    groups = texts.groupBy("t").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # Equal digests of unequal bytes would give one digest two groups; those rows go by their bytes.
    groups = scratch.materialize(groups.select(F.unhex(F.sha2("t", 256)).alias("digest"), "keep_id", "group_size", F.xxhash64(F.lit(1), "t").alias("check")), "groups")
    per = groups.groupBy("digest").agg(F.count(F.lit(1)).alias("variants"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"))
    per = scratch.materialize(per, "per-digest")
    # Rows of large groups meet them where they are; only rows of small ones are dealt by their digest.
    bound = F.lit(max(LARGE_ROWS, suspects.count() >> LARGE_BITS))
    single = per.where("variants = 1").select("digest", "keep_id", "group_size")
    large = F.broadcast(single.where(F.col("group_size") > bound))
    met = suspects.join(large.withColumnRenamed("digest", "of"), F.col("digest") == F.col("of"), "left")
    rest = met.where("of is null").select("doc_id", "digest").join(single.where(F.col("group_size") <= bound), "digest")
    shown = ["doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), sha]
    clean = met.where("of is not null").select(shown).unionByName(rest.select(shown))
    odd = per.where("variants > 1").select("digest")
    by_bytes = texts.withColumn("digest", F.unhex(F.sha2("t", 256))).join(odd, "digest", "left_semi").withColumn("check", F.xxhash64(F.lit(1), "t"))
    clashing = by_bytes.join(groups, ["digest", "check"]).select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), sha)
    return alone.unionByName(clean).unionByName(clashing)


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents with one row of each group of equal texts, all columns kept.

    Rows without doc_id are a group of their own for each text.
    """

    def one(rows: DataFrame) -> DataFrame:
        gone = exact_groups(rows).where("not kept").select("doc_id")
        return scratch.without(rows, scratch.materialize(gone, "copies"), "doc_id")

    def apart(rows: DataFrame) -> DataFrame:
        if "__id" not in rows.columns:
            return one(rows)
        return one(rows.where("__id is not null")).unionByName(one(rows.where("__id is null")))

    return scratch.by_row(docs, apart, nulls_first=True)
