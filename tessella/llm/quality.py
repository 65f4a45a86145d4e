"""Quality scores by positive-unlabelled learning.

Trusted positives are documents labelled 1; everything else counts as
unlabelled web text, whatever its label. A small network minimises the
non-negative unbiased risk: the positives' risk weighted with the class prior,
plus the unlabelled risk less the positives' share of it, whose estimate is
not let below zero. The prior comes from the scores of held-back rows: above
any score, unlabelled text holds at least prior times the positives' share, so
the smallest such ratio (with its sampling error) bounds the prior.

The network is fitted on a bounded sample, SAMPLE rows of either kind
(expected number, chosen by a hash of doc_id); every text is scored whole.

Defined results: a null or empty text has features of 0 and gets their score;
without any positive every score is 0.5 times the share of text that is
letters; texts are read whole, however long; a score of exactly 0.5 is
predicted 1; a doc_id that is labelled more than once is positive if any of its
labels is 1; rows are independent, so repeated rows and a null doc_id are fine;
an empty table gives an empty result; other columns are not read and cannot
clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm import scratch
from tessella.llm.textkit import texts_words, utf8, words

SAMPLE = 12_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 24, 40, 512, 3e-3, 1e-4
_BINS = 129  # ASCII characters, and all others


def _shape(raw: np.ndarray) -> np.ndarray:
    """Square roots of the shares of ASCII characters and of all other bytes."""
    counts = np.bincount(np.minimum(raw, 128), minlength=_BINS).astype(np.float64)
    return np.sqrt(counts / max(1, len(raw)))


_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def features(column: pa.Array) -> np.ndarray:
    """A row for each text, from the whole of it."""
    raw, offsets = utf8(column)
    out = np.zeros((len(offsets) - 1, FEATURES))
    for i, j, hashes, first in texts_words(column):
        for d in range(i, j):
            own, h = raw[offsets[d] : offsets[d + 1]], hashes[first[d - i] : first[d - i + 1]]
            if not len(own):
                continue
            shape = _shape(own)
            extra = [np.log1p(len(own)) / 10]
            if len(h):
                begin, end, _ = words(own, np.array([0, len(own)]))
                size = end - begin
                letters = np.concatenate(([0], np.cumsum(_LETTER[own])))
                upper = np.concatenate(([0], np.cumsum(_UPPER[own])))
                inside = letters[end] - letters[begin]
                _, counts = np.unique(h, return_counts=True)
                edge = own[end - 1]
                wide = min(len(h), 64)
                # The share of words that repeat their neighbour in the worst stretch of text.
                again = np.concatenate(([0], np.cumsum(h[1:] == h[:-1])))
                odd = np.concatenate(([0], np.cumsum(~_LETTER[edge])))
                plain = np.concatenate(([0], np.cumsum(inside == 0)))
                shout = np.concatenate(([0], np.cumsum((upper[end] - upper[begin] > 1) & (size > 2))))
                spread = lambda x: [x[-1] / max(1, len(x) - 1), (x[wide - 1 :] - x[: len(x) - wide + 1]).max(initial=0) / wide]
                extra += [size.mean() / 10, size.std() / 10, len(counts) / len(h), counts.max() / len(h), (counts**2).sum() / len(h) ** 2, *spread(again), *spread(odd), *spread(plain), *spread(shout)]
                lines = own == 10
                extra.append(lines.sum() / len(h))
            out[d, :_BINS] = shape
            out[d, _BINS : _BINS + len(extra)] = extra
    return out


FEATURES = _BINS + 1 + 5 + 8 + 1


class Network:
    """One hidden layer; positive values speak for quality."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 3):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.mean, self.scale = mean, scale
        self.weights = [rng.normal(0, 1 / np.sqrt(len(mean)), (len(mean), HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        self.moments = [(np.zeros_like(w), np.zeros_like(w)) for w in self.weights]
        self.steps = 0

    def scaled(self, x: np.ndarray) -> np.ndarray:
        out = x - self.mean
        out /= self.scale
        return np.clip(out, -6, 6, out=out)

    def value(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.maximum(self.scaled(x) @ a + b, 0) @ c + d

    def step(self, x: np.ndarray, slope) -> None:
        """One Adam step on scaled rows; slope gives the risk's derivative by each row's value."""
        a, b, c, d = self.weights
        hidden = np.maximum(x @ a + b, 0)
        g = slope(hidden @ c + d)
        back = np.outer(g, c) * (hidden > 0)
        grads = [x.T @ back + DECAY * a, back.sum(axis=0), hidden.T @ g + DECAY * c, np.array([g.sum()])]
        self.steps += 1
        for w, grad, (m, v) in zip(self.weights, grads, self.moments, strict=True):
            m += 0.1 * (grad - m)
            v += 0.001 * (grad**2 - v)
            w -= RATE * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.999**self.steps)) + 1e-8)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _train(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None) -> Network:
    """With a prior the non-negative risk of the sigmoid loss; without, plain separation of the two samples by logistic loss."""
    # A few columns at a time, so that no copy of all of them is held.
    mean, deviation = np.zeros(positive.shape[1]), np.zeros(positive.shape[1])
    for i in range(0, len(mean), 16):
        some = np.concatenate((positive[:, i : i + 16], unlabelled[:, i : i + 16])).astype(np.float64)
        mean[i : i + 16], deviation[i : i + 16] = some.mean(axis=0), some.std(axis=0)
    net = Network(mean, np.maximum(deviation, 1e-3))
    rng = np.random.Generator(np.random.PCG64(5))
    p, u = net.scaled(positive), net.scaled(unlabelled)
    half = BATCH // 2
    for _ in range(EPOCHS * max(1, -(-len(u) // BATCH))):
        x = np.concatenate((p[rng.integers(0, len(p), half)], u[rng.integers(0, len(u), half)]))

        def slope(f: np.ndarray) -> np.ndarray:
            s = _sigmoid(f)
            if prior is None:
                return np.concatenate((s[:half] - 1, s[half:])) / half
            bend = s * (1 - s) / half  # derivative of the loss of being called positive
            negative = s[half:].mean() - prior * s[:half].mean()
            if negative >= 0:
                return np.concatenate((-2 * prior * bend[:half], bend[half:]))
            # The negative part has fallen below zero: step back from it.
            return np.concatenate((prior * bend[:half], -bend[half:]))

        net.step(x, slope)
    return net


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among the unlabelled, from scores of rows that the scorer has not seen."""
    p, u = np.sort(positive), np.sort(unlabelled)
    at = np.quantile(p, np.linspace(0, 0.95, 96))
    above_p = 1 - np.searchsorted(p, at) / len(p)
    above_u = 1 - np.searchsorted(u, at) / len(u)
    slack = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(len(p)) + 1 / np.sqrt(len(u)))
    best = np.argmin((above_u + slack) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.02, 0.98))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> tuple[Network, float]:
    """The network and the prior that it was given."""
    split = _train(positive[::2], unlabelled[::2], None)
    prior = estimate_prior(split.value(positive[1::2]), split.value(unlabelled[1::2]))
    return _train(positive, unlabelled, prior), prior


def _sampled(rows: DataFrame, name: str, sample: int) -> np.ndarray:
    """Features of about sample rows (doc_id, text), chosen by a hash of doc_id."""
    number = rows.count()
    if number > sample:
        rows = rows.where(F.pmod(F.xxhash64(F.lit(name), "doc_id"), F.lit(1 << 20)) < int((1 << 20) * sample / number))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x.astype(np.float32).tobytes() for x in features(batch.column("text"))], pa.binary())], ["doc_id", "x"])

    got = rows.select("doc_id", "text").transform(scratch.arrow, run, "doc_id long, x binary").toArrow()
    got = got["x"].take(pc.sort_indices(got["doc_id"]))
    return np.frombuffer(b"".join(got.to_pylist()), np.float32).reshape(-1, FEATURES)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[Network, float] | None:
    """A network from the documents labelled 1 and from documents as they come; None without positives."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    trusted = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    number = trusted.count()
    if number > sample:
        trusted = trusted.where(F.pmod(F.xxhash64(F.lit("trusted"), "doc_id"), F.lit(1 << 20)) < int((1 << 20) * sample / number))
    # About SAMPLE ids at most.
    positive = _sampled(rows.join(F.broadcast(trusted), "doc_id", "left_semi"), "trusted", 1 << 40)
    unlabelled = _sampled(rows, "unlabelled", sample)
    model = fit(positive, unlabelled) if len(positive) > 1 and len(unlabelled) > 1 else None
    del positive, unlabelled
    scratch.trim()  # the driver outlives its samples
    return model


def _scores(model: tuple[Network, float] | None, column: pa.Array) -> np.ndarray:
    x = features(column)
    if model is None:
        return 0.5 * np.clip((x[:, [*range(65, 91), *range(97, 123), 128]] ** 2).sum(axis=1), 0, 1)
    return _sigmoid(model[0].value(x))


def score(docs: DataFrame, model: tuple[Network, float] | None, held_out: Column) -> DataFrame:
    """doc_id, held_out, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = _scores(model, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), F.col("text").cast("string").alias("text")).transform(scratch.arrow, run, "doc_id long, held_out boolean, score double, predicted int")


def held_fold(folds: int = 3, held: int = 1) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == held, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Scores of all documents, learned outside the held fold."""
    fold = held_fold()
    return score(docs, train(docs.where(~fold), labels.where(~fold), sample), fold)


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that are predicted 1, all columns kept; no row is moved."""
    model = train(docs, labels, sample)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(model, batch.column(at)) >= 0.5))

    return docs.transform(scratch.arrow, run, docs.schema)
