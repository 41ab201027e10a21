"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may be found with up to ``k = floor(error_rate * m)`` edits. Cut into k + 1
pieces, any such occurrence holds one piece unchanged; all pieces of all items are looked for at once (one
Aho-Corasick pass over each whole text), and the window around every hit is verified by Myers'
bit-parallel distance, run backwards once more for the start. Nothing within the budget is missed.

Item and document are compared as lower-case words (letters and digits) joined by one space; ``start`` and
``end`` are code points of the document, around whole words. Items go to the tasks in blocks of
``block_items``, a pass over the documents each, so memory is bounded however large the benchmark is; the
documents are mapped in place, without shuffle or join.

Defined cases: an item without a letter or digit, or null, is never found; equal items are each found; a
null text holds nothing; of several occurrences of an item in a document the one of least distance, then
the first, is told; repeated rows are each searched; the result column replaces one of its name.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaflow.llm.common import read, unused

ERROR_RATE = 0.08
BLOCK_ITEMS = 5_000
WORD = re.compile(r"[^\W_]+")
LEAKS = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("distance", T.LongType()),
                                  T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def normal(text: str | None) -> str:
    return " ".join(WORD.findall((text or "").lower()))


def myers(pattern: dict[str, int], m: int, text: str, budget: int) -> tuple[int, int] | None:
    """Least distance of a pattern (bit masks by character) to any stretch of ``text``, and that
    stretch's first end; None beyond the budget."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, budget + 1, -1
    for i, c in enumerate(text):
        eq = pattern.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score < best:
                best, end = score, i + 1
        ph <<= 1
        pv = (mh << 1) | (full & ~(xv | ph))
        mv = ph & xv & full
        pv &= full
    return (best, end) if end >= 0 else None


def masks(text: str) -> dict[str, int]:
    out: dict[str, int] = defaultdict(int)
    for i, c in enumerate(text):
        out[c] |= 1 << i
    return dict(out)


class Matcher:
    """The pieces of a block of ``(item_id, text)``."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float = ERROR_RATE):
        self.items, pieces = [], defaultdict(list)
        for item_id, text in items:
            x = normal(text)
            if not x:
                continue
            m, k = len(x), int(len(x) * error_rate)
            n = len(self.items)
            self.items.append((item_id, m, k, masks(x), masks(x[::-1])))
            cuts = [m * j // (k + 1) for j in range(k + 2)]
            for a, b in zip(cuts, cuts[1:]):
                pieces[x[a:b]].append((n, a))
        self.found = ahocorasick.Automaton()
        for p, where in pieces.items():
            self.found.add_word(p, (len(p), where))
        if pieces:
            self.found.make_automaton()

    def search(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """``(item_id, distance, start, end)`` by item and place."""
        x = normal(text)
        if not x or not len(self.found):
            return []
        hits: dict[int, set[int]] = defaultdict(set)
        for end, (size, where) in self.found.iter(x):
            for n, at in where:
                hits[n].add(end + 1 - size - at)
        out = []
        for n, starts in hits.items():
            item_id, m, k, forward, backward = self.items[n]
            spans: list[list[int]] = []
            for s in sorted(starts):
                lo, hi = max(0, s - k), s + m + k
                if spans and lo <= spans[-1][1]:
                    spans[-1][1] = hi
                else:
                    spans.append([lo, hi])
            best = None
            for lo, hi in spans:
                got = myers(forward, m, x[lo:hi], k)
                if got and (best is None or got[0] < best[0]):
                    best = (got[0], lo + got[1])
            if best:
                distance, end = best
                lo = max(0, end - m - k)
                back = self._start(backward, m, x[lo:end][::-1], distance)
                out.append((item_id, distance, end - back, end))
        if not out:
            return []
        ends, at = [], 0
        for w in WORD.finditer(text.lower()):
            ends.append((at, at + len(w[0]), w.start(), w.end()))
            at += len(w[0]) + 1
        place = lambda a, b: [(s, e) for p, q, s, e in ends if p < b and q > a]
        return sorted((i, d, w[0][0], w[-1][1]) for i, d, a, b in out if (w := place(a, b)))

    @staticmethod
    def _start(pattern: dict[str, int], m: int, text: str, distance: int) -> int:
        """The shortest prefix of the reversed text at the given distance."""
        full, top = (1 << m) - 1, 1 << (m - 1)
        pv, mv, score = full, 0, m
        for i, c in enumerate(text):
            eq = pattern.get(c, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | (full & ~(xh | pv))
            mh = pv & xh
            score += 1 if ph & top else -1 if mh & top else 0
            ph = (ph << 1) | 1
            pv = ((mh << 1) | (full & ~(xv | ph))) & full
            mv = ph & xv & full
            if score <= distance:
                return i + 1
        return len(text)


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "item_id", error_rate: float = ERROR_RATE, block_items: int = BLOCK_ITEMS,
               text: str = "text", to: str = "leaks") -> DataFrame:
    """``docs`` with the array column ``to`` of the items found in its text."""
    out = docs.drop(to).withColumn(to, F.array().cast(LEAKS))
    block: list[tuple[int, str]] = []
    for r in items.select(F.col(key).alias("k"), F.col("text").alias("t")).where("t is not null").toLocalIterator():
        block.append((r["k"], r["t"]))
        if len(block) >= block_items:
            out, block = _search(out, block, error_rate, text, to), []
    return _search(out, block, error_rate, text, to) if block else out


def _search(docs: DataFrame, block: list[tuple[int, str]], error_rate: float, text: str, to: str) -> DataFrame:
    shipped = docs.sparkSession.sparkContext.broadcast(block)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shipped.value, error_rate)
        kind = pa.list_(pa.struct([(f.name, pa.int64()) for f in LEAKS.elementType.fields]))
        names = [f.name for f in LEAKS.elementType.fields]
        for b in batches:
            texts, before = b.column(b.num_columns - 1), b.column(b.num_columns - 2).to_pylist()
            found = [old + [dict(zip(names, f)) for f in matcher.search(t.as_py())] for t, old in zip(texts, before)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns - 2)), pa.array(found, kind)], names=b.schema.names[:-1])

    schema = T.StructType([*docs.schema.fields[:-1], T.StructField(to, LEAKS)])
    return docs.select("*", docs[text].alias(unused(docs, "searched"))).mapInArrow(rows, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and item found in it."""
    got = find_leaks(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return got.select("doc_id", F.explode("leaks").alias("l")).select("doc_id", "l.item_id", "l.distance", "l.start", "l.end")
