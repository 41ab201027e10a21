"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features is shared by all grades; ordered thresholds cut its score:
``P(grade >= j) = logistic(score - threshold_j)``. From these come the expected grade and the tail
probability of the top grades, by which documents are selected.

Features of a word, each hashed to 2**18 buckets: the word, its first 4 and 6 bytes, its last 3 bytes,
or only a mark where it repeats the word before; a document's value in a bucket is its count divided by
the square root of its number of words. The model is fitted on a bounded sample of the rated rows
(``max_rows``, the documented bound, taken by a hash of the key so that it is the same at every layout),
in one task by limited-memory BFGS; scoring is a map over whole texts with the model (1 MB) broadcast.
Features are made for about a megabyte of text at a time and, for the fit, folded at once to the different
buckets of each document with their counts; loss and slope go through these in blocks. So the fitting
task holds 8 bytes a different feature of the sample, and no step holds the words of a whole batch.

Defined cases: a null text is empty and an empty text scores 0; rows with a null key or rating are not
fitted on; a key with several ratings counts once per rating; without two different grades there is no
model, and every document is scored null and kept; repeated rows are scored alike; extra columns are
carried along, a column of the result's name is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaflow.llm.common import _BYTE, _ODD, _powers, mix, read, text_bytes, unused, word_hashes

BITS = 18
MAX_ROWS = 12_000
LEAST_ROWS = 1000
L2 = 2e-5
KEEP_AT = 0.5
_MARK = int(mix(np.array([77], np.uint64))[0] >> np.uint64(64 - BITS))


@dataclass
class Model:
    """Weights by bucket, and the ordered thresholds between the grades ``levels``."""

    weights: np.ndarray
    thresholds: np.ndarray
    levels: list[int]


def _bucket(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (mix(hashes + np.uint64(kind * int(_ODD) % (1 << 64))) >> np.uint64(64 - BITS)).astype(np.int32)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words of a batch, ``(5, words)``, and per row where its words begin."""
    data, offsets = text_bytes(texts)
    words, rows, start = word_hashes(data, offsets)
    n = len(words)
    out = np.zeros((5, n), np.int32)
    if n:
        ends = np.minimum(np.append(start[1:], len(data)), offsets[np.searchsorted(offsets, start, "right")])
        out[0] = _bucket(words, 0)
        for kind, (size, from_end) in enumerate(((4, False), (6, False), (3, True)), 1):
            value = np.zeros(n, np.uint64)
            for j in range(size):
                if from_end:
                    at = _last(data, start, ends, j)
                else:
                    at = start + j
                    at = np.where(at < ends, at, -1)
                ok = at >= 0
                byte = _BYTE[data[np.where(ok, at, 0)]]
                value = value * _ODD + np.where(ok, byte, np.uint64(0))
            out[kind] = _bucket(value, kind)
        same = np.zeros(n, bool)
        same[1:] = words[1:] == words[:-1]
        same[rows[:-1][rows[:-1] < n]] = False
        out[:4, same] = -1
        out[4] = np.where(same, _MARK, -1)
    return out, rows


def _last(data: np.ndarray, start: np.ndarray, ends: np.ndarray, j: int) -> np.ndarray:
    """Position of a word's last byte but ``j``; the white space that follows the word is passed over."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    solid = np.flatnonzero(~space)
    last = solid[np.searchsorted(solid, ends) - 1] - j
    return np.where(last >= start, last, -1)


def slices(texts: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes of text (one row at least)."""
    _, offsets = text_bytes(texts)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, hi
        lo = hi


@dataclass
class Rows:
    """Documents as their different buckets: those of document ``i`` are ``bucket[start[i]:start[i + 1]]``, each with its
    count divided by the square root of the document's words."""

    bucket: np.ndarray
    value: np.ndarray
    start: np.ndarray

    def blocks(self, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
        lo, n = 0, len(self.start) - 1
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(self.start, self.start[lo] + size, "right")) - 1)
            yield lo, hi
            lo = hi

    def scores(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.start) - 1)
        for lo, hi in self.blocks():
            at = slice(self.start[lo], self.start[hi])
            each = np.concatenate([[0.0], np.cumsum(weights[self.bucket[at]] * self.value[at])])
            place = self.start[lo:hi + 1] - self.start[lo]
            out[lo:hi] = each[place[1:]] - each[place[:-1]]
        return out

    def slope(self, by_score: np.ndarray, size: int) -> np.ndarray:
        out = np.zeros(size)
        for lo, hi in self.blocks():
            at = slice(self.start[lo], self.start[hi])
            each = np.repeat(by_score[lo:hi], np.diff(self.start[lo:hi + 1])) * self.value[at]
            out += np.bincount(self.bucket[at], weights=each, minlength=size)
        return out


def folded(buckets: np.ndarray, rows: np.ndarray) -> Rows:
    """The documents of :func:`features` as :class:`Rows`."""
    n = np.diff(rows)
    doc = np.repeat(np.arange(len(n)), n)
    keys = [(doc[ok] << BITS) | b[ok] for b in buckets for ok in (b >= 0,)]
    key, count = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.int64), np.zeros(0))
    of = key >> BITS
    value = (count / np.sqrt(np.maximum(n, 1))[of]).astype(np.float32)
    return Rows((key & ((1 << BITS) - 1)).astype(np.int32), value, np.searchsorted(of, np.arange(len(n) + 1)))


def joined(parts: list[Rows]) -> Rows:
    """The documents of all ``parts``, which it empties."""
    sizes = np.concatenate([np.diff(p.start) for p in parts])
    bucket = np.concatenate([p.bucket for p in parts])
    value = np.concatenate([p.value for p in parts])
    parts.clear()
    return Rows(bucket, value, np.concatenate([[0], np.cumsum(sizes)]))


def _scores(buckets: np.ndarray, rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    padded = np.append(weights, 0.0)
    each = np.concatenate([[0.0], np.cumsum(sum(padded[b] for b in buckets))])
    n = np.diff(rows)
    return (each[rows[1:]] - each[rows[:-1]]) / np.sqrt(np.maximum(n, 1))


def _log1pexp(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def ordinal_loss(score: np.ndarray, grade: np.ndarray, free: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log-likelihood, and its slopes by score and by the free threshold parameters
    (the first threshold, then logarithms of the steps, so that the thresholds stay ordered)."""
    steps = np.exp(free[1:])
    cut = free[0] + np.concatenate([[0.0], np.cumsum(steps)])
    edge = np.concatenate([[-np.inf], cut, [np.inf]])
    low, high = edge[grade] - score, edge[grade + 1] - score
    sig = lambda x: 0.5 * (1 + np.tanh(x / 2))
    p_high, p_low = sig(high), sig(low)
    p = np.maximum(p_high - p_low, 1e-12)
    d_high, d_low = p_high * (1 - p_high) / p, p_low * (1 - p_low) / p
    n = len(score)
    by_cut = np.zeros(len(cut) + 2)
    np.add.at(by_cut, grade + 1, -d_high)
    np.add.at(by_cut, grade, d_low)
    by_cut = by_cut[1:-1] / n
    tails = np.cumsum(by_cut[::-1])[::-1]
    return float(-np.log(p).mean()), (d_high - d_low) / n, np.concatenate([[tails[0]], tails[1:] * steps])


def fit_arrays(docs: Rows, grade: np.ndarray, n_grades: int, l2: float = L2, rounds: int = 80) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by limited-memory BFGS with backtracking."""
    size = 1 << BITS

    def loss(x):
        w, free = x[:size], x[size:]
        value, by_score, by_free = ordinal_loss(docs.scores(w), grade, free)
        return value + l2 / 2 * float(w @ w), np.concatenate([l2 * w + docs.slope(by_score, size), by_free])

    share = np.cumsum(np.bincount(grade, minlength=n_grades))[:-1] / len(grade)
    cut = np.log(share / (1 - share))
    x = np.concatenate([np.zeros(size), [cut[0]], np.log(np.maximum(np.diff(cut), 1e-3))])
    value, slope = loss(x)
    pairs: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        q, kept = slope.copy(), []
        for s, y, r in reversed(pairs):
            a = r * (s @ q)
            kept.append(a)
            q -= a * y
        if pairs:
            s, y, r = pairs[-1]
            q *= 1 / (r * (y @ y))
        for (s, y, r), a in zip(pairs, reversed(kept)):
            q += s * (a - r * (y @ q))
        down, step = -(q @ slope), 1.0 if pairs else min(1.0, 10 / np.abs(slope).max())
        while step > 1e-8:
            new_value, new_slope = loss(x - step * q)
            if new_value <= value + 1e-4 * step * down:
                break
            step /= 2
        else:
            break
        s, y = -step * q, new_slope - slope
        if s @ y > 1e-12:
            pairs = [*pairs[-7:], (s, y, 1 / (s @ y))]
        gain, x, value, slope = value - new_value, x + s, new_value, new_slope
        if gain < 1e-6 * max(value, 1e-3):
            break
    free = x[size:]
    return x[:size], free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])


def fit(docs: DataFrame, ratings: DataFrame, key: str = "doc_id", text: str = "text", grade: str = "grade", max_rows: int = MAX_ROWS) -> Model | None:
    """Fit on at most about ``max_rows`` rated rows, of which a grade that is rare there has up to ``LEAST_ROWS`` more;
    None without two different grades among the rated documents."""
    rated = ratings.select(F.col(key).alias("__k"), F.col(grade).cast("int").alias("__g")).dropna()
    counts = {r["__g"]: r["count"] for r in rated.groupBy("__g").count().collect()}
    levels = sorted(counts)
    if len(levels) < 2:
        return None
    slots = 1 << 20
    share = min(slots, max(1, int(slots * max_rows / sum(counts.values()))))
    least = min(LEAST_ROWS, max(1, max_rows // len(levels)))
    shares = [(g, min(slots, max(share, -(-slots * least // n)))) for g, n in counts.items()]
    shares = F.broadcast(docs.sparkSession.createDataFrame(shares, "__g int, share long"))
    sample = rated.join(shares, "__g").where(F.pmod(F.xxhash64("__k"), F.lit(slots)) < F.col("share")).select("__k", "__g")
    rows = docs.select(F.col(key).alias("__k"), F.col(text).alias("__t")).join(F.broadcast(sample), "__k").select("__k", "__g", "__t")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, grades = [], []
        for b in batches:
            for lo, hi in slices(b.column(2)):
                parts.append(folded(*features(b.column(2).slice(lo, hi - lo))))
            grades.append(np.array(b.column(1).to_pylist(), np.int64))
        if parts:
            held, g = np.unique(np.concatenate(grades), return_inverse=True)
            if len(held) > 1:
                w, cut = fit_arrays(joined(parts), g, len(held))
                yield pa.RecordBatch.from_arrays([pa.array([w.astype("<f4").tobytes()], pa.binary()), pa.array([cut.tolist()], pa.list_(pa.float64())), pa.array([held.tolist()], pa.list_(pa.int64()))],
                                                 names=["w", "cut", "levels"])

    got = rows.repartition(1).sortWithinPartitions("__k", "__g", "__t").mapInArrow(train, "w binary, cut array<double>, levels array<long>").collect()
    return Model(np.frombuffer(got[0]["w"], "<f4").astype(np.float64), np.array(got[0]["cut"]), got[0]["levels"]) if got else None


def score(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``expected_grade`` and ``tail_probability`` (of the top grade)."""
    names = ("expected_grade", "tail_probability")
    kept = docs.drop(*names)
    if model is None:
        return kept.withColumns({n: F.lit(None).cast("double") for n in names})
    shipped = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds, model.levels))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, cut, levels = shipped.value
        weights, gaps = weights.astype(np.float64), np.diff(levels)
        for b in batches:
            got = []
            texts = b.column(b.num_columns - 1)
            for lo, hi in slices(texts):
                buckets, where = features(texts.slice(lo, hi - lo))
                got.append(_scores(buckets, where, weights))
            s = np.concatenate(got) if got else np.zeros(0)
            above = 0.5 * (1 + np.tanh((s[:, None] - cut[None, :]) / 2))
            cols = [b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(levels[0] + above @ gaps), pa.array(above[:, -1])], names=[*b.schema.names[:-1], *names])

    schema = T.StructType([*kept.schema.fields, *(T.StructField(n, T.DoubleType()) for n in names)])
    return kept.select("*", kept[text].alias(unused(kept, "scored"))).mapInArrow(rows, schema)


def select(scored: DataFrame, keep_at: float = KEEP_AT) -> DataFrame:
    """The documents whose probability of the top grade is at least ``keep_at``; unscored ones stay."""
    return scored.where(F.col("tail_probability").isNull() | (F.col("tail_probability") >= keep_at))


def graded(labels: DataFrame) -> DataFrame:
    """Ratings of the ``labels`` table: 0 toxic, 1 of low quality, 2 neither."""
    g = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("toxic") == 0) & (F.col("quality") == 1), 2)
    return labels.select("doc_id", g.alias("grade"))


def kept_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` that the classifier selects, with their scores; fitted on ``docs`` and the labels."""
    return select(score(docs, fit(docs, graded(read(spark, sf_dir, "labels")))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents kept."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return kept_documents(spark, docs, sf_dir).select("doc_id", "expected_grade", "tail_probability")
