"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is folded to runs of letters (ASCII lower-cased, every byte of a longer code point taken as a letter).
Every 2 to 4 consecutive bytes inside a word, its two boundaries marked, are a subword; its hash picks one of
``BUCKETS`` embeddings. The mean of the embeddings of all subwords of the whole text goes through a linear layer
and a softmax. Embeddings and layer are trained by minibatch stochastic gradient descent in numpy.

*Sample.* Training takes at most ``SAMPLE`` documents, the same bound for every language, chosen by a hash of the
id, and of each at most two windows of up to ``WINDOW`` code points. A tenth of them is kept apart for
calibration. At most ``LANGS`` languages, those of most documents, are learned. Counts are over all rows.

*Calibration.* On the windows kept apart, a temperature makes the scores probabilities, and the smallest score
above which a share of ``TARGET`` of the decisions is right becomes the rejection threshold (column ``accepted``).

*Data movement.* One aggregate of a row a language, one bounded sample, one task that trains it, and a map over the
documents with the model (at most ``BUCKETS`` * ``DIM`` floats) sent once. No text is shuffled but the sample's windows.
A batch is scored in slices of about a megabyte, so memory does not follow the length of texts.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, not accepted; so is every text when
nothing can be learned (no labelled row with letters). With one language known, all else is that language with
score 1. A null id counts as not held out, and is not learned from. Repeated rows are rows. Other columns are
ignored, whatever their names. Words of over ``LONGEST`` bytes are cut.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from qaflow.llm.common import materialise, read, text_bytes

BUCKETS, DIM, GRAMS = 1 << 16, 16, (2, 3, 4)
SAMPLE, LANGS, WINDOW = 16_000, 1_024, 240
TARGET = 0.99
EPOCHS, STEPS, BATCH, RATE = 6, 3_000, 32, 0.5
LONGEST, SLICE = 1 << 16, 1 << 20
UNKNOWN = "und"

_FOLD = np.zeros(256, np.uint8)  # 0: no letter
_FOLD[65:91] = np.arange(97, 123)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def slices(data: np.ndarray, offsets: np.ndarray):
    """``(first row, byte offsets)`` of pieces of about ``SLICE`` bytes: whole rows, or parts of one long row, cut where
    a word ends."""
    row, n = 0, len(offsets) - 1
    while row < n:
        last = max(int(np.searchsorted(offsets, offsets[row] + SLICE, "right")) - 1, row)
        if last > row:
            yield row, offsets[row:last + 1]
            row = last
            continue
        lo, end = int(offsets[row]), int(offsets[row + 1])
        while lo < end:
            hi = min(end, lo + SLICE)
            if hi < end:
                gap = np.flatnonzero(_FOLD[data[hi:min(end, hi + LONGEST)]] == 0)
                hi = min(end, hi + (int(gap[0]) if len(gap) else LONGEST))
            yield row, np.array([lo, hi])
            lo = hi
        row += 1


def subwords(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of the subwords of all rows, and where each row's begin (one more at the end)."""
    folded = np.insert(_FOLD[data[offsets[0]:offsets[-1]]], offsets - offsets[0], 0)
    keep = folded != 0
    keep[0] = True
    keep[1:] |= folded[:-1] != 0
    place = np.cumsum(keep)
    marks = place[offsets - offsets[0] + np.arange(len(offsets))] - 1  # of the boundary before each row
    x = folded[keep].astype(np.uint32)
    found, rows = [], []
    for n in GRAMS:
        m = len(x) - n + 1
        if m <= 0:
            continue
        gram, inner = x[:m].copy(), np.ones(m, bool)
        for j in range(1, n):
            gram |= x[j:j + m] << np.uint32(8 * j)
            if j < n - 1:
                inner &= x[j:j + m] != 0
        at = np.flatnonzero(inner)
        mixed = (gram[at] ^ np.uint32(n * 0x3C6EF372 & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)
        mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA77)
        found.append((mixed >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64))
        rows.append(np.searchsorted(at, marks))
    if not found:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    starts = np.sum(rows, axis=0)
    out = np.empty(starts[-1], np.int64)
    filled = starts[:-1].copy()
    for ids, r in zip(found, rows):
        size = np.diff(r)
        out[np.repeat(filled - r[:-1], size) + np.arange(r[-1])] = ids[:r[-1]]
        filled += size
    return out, starts


def summed(table: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the rows ``table[ids]`` between consecutive ``starts``."""
    out = np.zeros((len(starts) - 1, table.shape[1]))
    full = np.flatnonzero(np.diff(starts))
    if len(full):
        for c in range(table.shape[1]):
            out[full, c] = np.add.reduceat(np.take(table[:, c], ids), starts[full], dtype=np.float64)
    return out


@dataclass
class Model:
    """``langs``; a table of one row a bucket and the layer that turns its mean into scores; calibration."""
    langs: list[str]
    table: np.ndarray
    layer: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def probabilities(self, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return softmax((sums / np.maximum(counts, 1)[:, None]) @ self.layer / self.temperature)

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, table=self.table, layer=self.layer, numbers=np.array([self.temperature, self.threshold]))
        return out.getvalue()

    @classmethod
    def unpack(cls, langs: list[str], blob: bytes) -> Model:
        with np.load(io.BytesIO(blob)) as kept:
            return cls(langs, kept["table"], kept["layer"], *kept["numbers"].tolist())


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(ids: np.ndarray, starts: np.ndarray, label: np.ndarray, n_langs: int, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """``(embeddings, layer)`` by minibatch gradient descent on the cross-entropy, the rate falling to zero: ``EPOCHS``
    rounds over the windows, more if that is under ``STEPS`` steps."""
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    layer = np.zeros((DIM, n_langs))
    a_round = -(-len(label) // BATCH)
    epochs = max(EPOCHS, -(-STEPS // a_round))
    size, steps, done = np.diff(starts), epochs * a_round, 0
    for _ in range(epochs):
        order = rng.permutation(len(label))
        for lo in range(0, len(order), BATCH):
            rows = order[lo:lo + BATCH]
            own = size[rows]
            ends = np.cumsum(own)
            of = np.repeat(np.arange(len(rows)), own)
            take = ids[np.arange(ends[-1]) - (ends - own)[of] + starts[rows][of]]
            mean = np.add.reduceat(table[take], ends - own) / own[:, None]
            error = softmax(mean @ layer)
            error[np.arange(len(rows)), label[rows]] -= 1
            rate = RATE * (1 - done / steps)
            back = (error @ layer.T / own[:, None])[of]
            layer -= rate * 4 / len(rows) * (mean.T @ error)
            by = np.argsort(take, kind="stable")
            first = np.flatnonzero(np.diff(take[by], prepend=-1))
            table[take[by][first]] -= rate * np.add.reduceat(back[by], first)
            done += 1
    return table, layer


def calibrate(model: Model, sums: np.ndarray, counts: np.ndarray, label: np.ndarray, target: float = TARGET) -> None:
    """Sets the temperature of least cross-entropy, and the smallest score from which on ``target`` of the decisions hold."""
    if not len(label):
        return
    best = None
    for t in np.geomspace(0.05, 20, 49):
        model.temperature = float(t)
        p = model.probabilities(sums, counts)
        loss = -np.log(np.maximum(p[np.arange(len(label)), label], 1e-300)).mean()
        if best is None or loss < best[0]:
            best = loss, float(t)
    model.temperature = best[1]
    p = model.probabilities(sums, counts)
    order = np.argsort(-p.max(1), kind="stable")
    right = np.cumsum((p.argmax(1) == label)[order]) / np.arange(1, len(label) + 1)
    good = np.flatnonzero(right >= target)
    model.threshold = float(p.max(1)[order][good[-1]]) if len(good) else 1.0


def _fit_task(n_langs: int):
    def fit(batches):
        tables = [pa.Table.from_batches([b]) for b in batches]
        if not tables:
            return
        rows = pa.concat_tables(tables).sort_by([("place", "ascending"), ("part", "ascending"), ("window", "ascending")])
        ids, starts = subwords(*text_bytes(rows["window"]))
        label, apart = np.array(rows["label"], np.int64), np.array(rows["apart"], bool)
        use = np.flatnonzero((np.diff(starts) > 0) & ~apart)
        if not len(use):
            return
        keep = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in use])
        table, layer = train(ids[keep], np.concatenate([[0], np.cumsum(np.diff(starts)[use])]), label[use], n_langs)
        if n_langs <= DIM:  # the layer is linear, so it may as well be applied before the mean
            table, layer = table @ layer, np.eye(n_langs)
        model = Model([], table.astype(np.float32), layer)
        sums, counts = summed(model.table, ids, starts), np.diff(starts)
        test = np.flatnonzero((counts > 0) & apart)
        calibrate(model, sums[test], counts[test], label[test])
        yield pa.RecordBatch.from_arrays([pa.array([model.pack()], pa.binary())], names=["model"])
    return fit


def letters(text: Column | str) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).rlike(r"\p{L}")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, sample: int = SAMPLE, langs_most: int = LANGS) -> Model | None:
    """A model from ``docs(doc_id, text, lang)``; None where no row has an id, a language and a letter."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text", "lang").where("id is not null and lang is not null").where(letters("text"))
    known = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(langs_most).collect()
    if not known:
        return None
    langs = sorted(r["lang"] for r in known)
    if len(langs) == 1:
        return Model(langs, np.zeros((BUCKETS, 1), np.float32), np.eye(1))
    most = max(1, sample // len(langs))
    of = spark.createDataFrame([(r["lang"], langs.index(r["lang"]), min(1.0, 1.3 * (most + 10) / r["n"])) for r in known], "lang string, label int, rate double")
    place = F.xxhash64("id", F.lit(5))
    rows = rows.join(F.broadcast(of), "lang").withColumn("place", place).where(F.pmod("place", F.lit(1 << 24)) < F.col("rate") * (1 << 24))
    rows = rows.withColumn("no", F.row_number().over(W.partitionBy("label").orderBy("place", "id", "text"))).where(F.col("no") <= most)
    size = (16 + F.pmod(F.xxhash64("id", F.lit(7)), F.lit(WINDOW - 15))).cast("int")
    start = (1 + F.pmod(F.xxhash64("id", F.lit(9)), F.greatest(F.length("text") - size, F.lit(0)) + 1)).cast("int")
    rows = rows.select("label", "place", (F.pmod(F.xxhash64("id", F.lit(13)), F.lit(10)) == 0).alias("apart"), F.posexplode(F.array(F.substring("text", F.lit(1), size), F.substring("text", start, size))).alias("part", "window"))
    kept = materialise(rows, "langid-sample").coalesce(1)
    got = kept.mapInArrow(_fit_task(len(langs)), "model binary").collect()
    return Model.unpack(langs, bytes(got[0]["model"])) if got else None


def identify(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, accepted`` for every row, from the whole text alone."""
    schema = "doc_id long, lang_pred string, score double, accepted boolean"
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), letters(text).alias("some"))
    if model is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
    sent = docs.sparkSession.sparkContext.broadcast((model.langs, model.pack()))

    def score(batches):
        own = Model.unpack(*sent.value)
        names = np.array([*own.langs, UNKNOWN], dtype=object)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            sums, counts = np.zeros((batch.num_rows, own.table.shape[1])), np.zeros(batch.num_rows, np.int64)
            for row, cut in slices(data, offsets):
                ids, starts = subwords(data, cut)
                sums[row:row + len(cut) - 1] += summed(own.table, ids, starts)
                counts[row:row + len(cut) - 1] += np.diff(starts)
            p = own.probabilities(sums, counts)
            some = np.array(batch.column(2), bool)
            best = np.where(some, p.argmax(1), len(own.langs))
            value = np.where(some, np.clip(p.max(1), 0.0, 1.0), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names[best], pa.string()), pa.array(value), pa.array(some & (value >= own.threshold))], names=["doc_id", "lang_pred", "score", "accepted"])

    return rows.mapInArrow(score, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")
