"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, made from its code point. A
trigram binds its letters' vectors, each permuted by its place (element-wise
product of rotated vectors); a document bundles the vectors of its trigrams
(their sum), and a language bundles its documents' vectors of unit length.
A document gets the language whose prototype has the largest cosine with it.

The prototypes are learned from SAMPLE labelled documents (expected number),
chosen by a hash of doc_id; with fewer all are used. Whole texts are read.

Defined results: a text that is null, empty or without letters is ``und`` with
score 0, and so is every text when nothing can be learned; one letter is
enough for a language; equal cosines go to the language that comes first in
order; texts are read whole, however long, in blocks of BLOCK code points;
rows are independent, so repeated rows and a null doc_id are fine; an empty
table gives an empty result; other columns are not read and cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm import scratch

DIMENSIONS = 1024
SAMPLE = 20_000
NONE = "und"
#: Code points of a text that are held at once, trigrams of documents that share a matrix product, trigram vectors that are kept.
BLOCK, TOGETHER, KEPT = 1 << 20, 48, 1 << 15
_NOISE = np.uint64(0x9E3779B97F4A7C15)


class _Letters:
    """The lower-case letter of each code point, 0 for all others."""

    table: np.ndarray | None = None

    @classmethod
    def of(cls, text: str) -> np.ndarray:
        if cls.table is None:
            low = [ord(x) if len(x := chr(c).lower()) == 1 and x.isalpha() else c if chr(c).isalpha() else 0 for c in range(0x110000)]
            cls.table = np.array(low, np.uint32)
        return cls.table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def letter_vector(letter: int) -> np.ndarray:
    """The vector of a letter; 0 is the gap between words."""
    return np.random.Generator(np.random.PCG64([letter, 7])).integers(0, 2, DIMENSIONS, dtype=np.int8) * np.int8(2) - np.int8(1)


class Trigrams:
    """The vectors of trigrams met so far, and counts of trigrams in texts."""

    def __init__(self):
        self.letters: dict[int, np.ndarray] = {}
        self.row: dict[int, int] = {}
        self.vectors = np.empty((KEPT, DIMENSIONS), np.int8)

    def _letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            self.letters[code] = letter_vector(code)
        return self.letters[code]

    def rows(self, ids: np.ndarray) -> np.ndarray:
        """Vectors of trigram ids as float32."""
        if len(self.row) + len(ids) > KEPT:
            self.row.clear()
        fresh = [i for i in ids.tolist() if i not in self.row]
        for i in fresh:
            a, b, c = i >> 42, i >> 21 & 0x1FFFFF, i & 0x1FFFFF
            self.row[i] = at = len(self.row)
            self.vectors[at] = np.roll(self._letter(a), 2) * np.roll(self._letter(b), 1) * self._letter(c)
        return self.vectors[[self.row[i] for i in ids.tolist()]].astype(np.float32)

    @staticmethod
    def count(text: str) -> tuple[np.ndarray, np.ndarray]:
        """Distinct trigrams of letters and single gaps, and how often they occur; a text begins and ends with a gap."""
        parts, tail = [], np.zeros(1, np.uint64)
        for i in range(0, len(text), BLOCK):
            codes = np.concatenate((tail, _Letters.of(text[i : i + BLOCK]).astype(np.uint64)))
            codes = codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))]
            tail = codes[-2:]
            ids = codes[:-2] << np.uint64(42) | codes[1:-1] << np.uint64(21) | codes[2:]
            parts.append(np.unique(ids, return_counts=True))
        if len(tail) == 2 and tail[1]:
            parts.append((tail[:1] << np.uint64(42) | tail[1:] << np.uint64(21), np.ones(1, np.int64)))
        if len(parts) == 1:
            return parts[0]
        if not parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        ids, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return ids, np.bincount(back, np.concatenate([p[1] for p in parts])).astype(np.int64)

    def bundles(self, texts: list[str]) -> np.ndarray:
        """The vectors of texts (texts x DIMENSIONS), zero for texts without letters."""
        counted = [self.count(t) for t in texts]
        out = np.zeros((len(texts), DIMENSIONS), np.float32)
        flat = np.concatenate([c[0] for c in counted]) if counted else np.zeros(0, np.uint64)
        if not len(flat):
            return out
        ids, column = np.unique(flat, return_inverse=True)
        row = np.repeat(np.arange(len(texts)), [len(c[0]) for c in counted])
        value = np.concatenate([c[1] for c in counted])
        for at in range(0, len(ids), KEPT // 2):
            own = (column >= at) & (column < at + KEPT // 2)
            part = ids[at : at + KEPT // 2]
            counts = np.zeros((len(texts), len(part)), np.float32)
            counts[row[own], column[own] - at] = value[own]
            out += counts @ self.rows(part)
        return out


def _bundled(batch: pa.RecordBatch, grams: Trigrams) -> Iterator[tuple[int, int, np.ndarray]]:
    """Slices [i, j) of a batch's texts and their vectors of unit length."""
    column = batch.column("text")
    for i in range(0, batch.num_rows, TOGETHER):
        part = column.slice(i, TOGETHER)
        vectors = grams.bundles([x or "" for x in part.to_pylist()])
        size = np.sqrt(np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64))
        yield i, i + len(part), vectors / np.maximum(size, 1e-30)[:, None].astype(np.float32)


def learn(rows: DataFrame, sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """Prototypes of unit length from rows (doc_id, text, lang) with a lang."""
    rows = rows.where("lang is not null").select("doc_id", "lang", "text")
    number = rows.count()
    if number > sample:
        rows = rows.where(F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 20)) < int((1 << 20) * sample / number))

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, sums = Trigrams(), {}
        for batch in batches:
            names = batch.column("lang").to_pylist()
            for i, j, vectors in _bundled(batch, grams):
                for name, vector in zip(names[i:j], vectors, strict=True):
                    sums[name] = sums.get(name, 0.0) + vector.astype(np.float64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["lang", "sum"])

    # A fixed number of partial bundles, one for each task and language.
    total: dict[str, np.ndarray] = {}
    for r in rows.repartition(12, F.xxhash64("doc_id")).select("lang", "text").transform(scratch.arrow, bundle, "lang string, sum binary").collect():
        total[r["lang"]] = total.get(r["lang"], 0.0) + np.frombuffer(r["sum"], np.float64)
    return {name: (v / n).astype(np.float32) for name, v in sorted(total.items()) if (n := np.linalg.norm(v))}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred, score (the cosine, 0 where negative)."""
    names = list(prototypes)
    matrix = np.stack([prototypes[n] for n in names], axis=1) if names else np.zeros((DIMENSIONS, 0), np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Trigrams()
        for batch in batches:
            best, score = [], []
            for _, _, vectors in _bundled(batch, grams):
                cosine = vectors @ matrix
                some = vectors.any(axis=1)
                for k in range(len(vectors)):
                    at = int(cosine[k].argmax()) if names and some[k] else -1
                    best.append(names[at] if at >= 0 else NONE)
                    score.append(float(min(1.0, max(0.0, cosine[k, at]))) if at >= 0 else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(best, pa.string()), pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), F.col("text").cast("string").alias("text")).transform(scratch.arrow, run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, folds: int = 4, held: int = 2, sample: int = SAMPLE) -> DataFrame:
    """Languages of all documents, learned from those outside the held fold."""
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == held, F.lit(False))
    return predict(docs, learn(docs.where(~fold), sample), fold)
