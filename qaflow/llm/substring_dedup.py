"""Substring dedup: paragraph MinHash banding, exact verification, clusters of removals.

Paragraphs come in two sizes. A *line* of at least ``MIN_WORDS`` words is compared with others by MinHash
over its five-word shingles: ``BANDS`` bands of ``ROWS`` hashes find a pair of similarity 0.8 with a
probability of 1 - (1 - 0.8**3)**10 = 0.9992; lines that collide are candidates, exact Jaccard decides
(see :mod:`qaflow.llm.simjoin`), and linked lines form a component. A *anchor* is ``GRAM``
words whose hash is the least of ``WINDOW`` successive ones (winnowing), so any GRAM + WINDOW - 1 = 32 words
that repeat, at any place in longer lines or across line breaks, hold the same anchor in every document for
certain. A repeated anchor is extended to the anchors next to it where all its occurrences have the same words
up to there; elsewhere every ``GRAM`` words that begin less than WINDOW words from it are compared too, so
that a repeated passage is covered word by word to its true ends.

A cluster is a component of lines, an anchor, or GRAM words beside one, that stands in at least two documents; its occurrence in
the smallest ``(doc_id, start)`` stays, the others are removals. Neighbouring and overlapping spans of a
document are merged. With ``least``, only what merges to that many words counts: an occurrence in a shorter stretch of
repeated words is a chance repeat, neither kept as the first nor removed. The registered query takes ``LEAST`` words.

Data movement: lines and anchors travel as hashes and places, never as text; a task first looks for
repeats among its own rows and sends one entry a repeated key, so a passage that a third of all documents
hold costs a reducer one entry a task. Texts are read again for verifying lines and shuffled once to meet the open ends of anchors.

Defined cases: null and empty texts hold no paragraph; a row with a null ``doc_id`` takes no part;
repeated rows with one ``doc_id`` are one document; other columns are ignored; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaflow.llm.common import _ODD, materialise, mix, partitions, read, shingle_hashes, text_bytes, word_hashes
from qaflow.llm.simjoin import ENTRY, _blobs, _packed, candidate_edges, linked_components

MIN_WORDS = 8
SHINGLE = 5
BANDS, ROWS = 10, 3
GRAM = 8
WINDOW = 25
NUM, DEN = 80, 100
_INV = np.uint64(pow(int(_ODD), -1, 1 << 64))
SPOT = np.dtype([("key", "<u8"), ("doc", "<i8"), ("start", "<i4"), ("words", "<i4"), ("known", "<i4"),
                 ("before", "<u8"), ("after", "<u8"), ("n_before", "<i4"), ("n_after", "<i4")])
SENT = ("start", "words", "before", "after", "n_before", "n_after")
LEAST = 50
KINDS = ("line", "anchor", "beside")
FLUSH = 500_000


def _batches(texts: pa.Array, size: int = 1024):
    for lo in range(0, len(texts), size):
        part = texts.slice(lo, size)
        data, offsets = text_bytes(part)
        words, rows, starts = word_hashes(data, offsets)
        yield lo, data, words, rows, starts


def _span_hash(words: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of the word sequence of every span ``a:b``."""
    power = np.full(len(words) + 1, _ODD, np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * power[:-1], out=total[1:])
    inverse = np.full(len(words) + 1, _INV, np.uint64)
    inverse[0] = 1
    inverse = np.cumprod(inverse)
    return mix((total[b] - total[a]) * inverse[a] + (b - a).astype(np.uint64) * _ODD)


def line_spans(data: np.ndarray, rows: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word and end of every line of at least MIN_WORDS words."""
    n = len(starts)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    line = np.searchsorted(np.flatnonzero(data == 10), starts)
    row = np.searchsorted(rows, np.arange(n), "right") - 1
    new = np.ones(n, bool)
    new[1:] = (line[1:] != line[:-1]) | (row[1:] != row[:-1])
    a = np.flatnonzero(new)
    b = np.append(a[1:], n)
    ok = b - a >= MIN_WORDS
    return row[a[ok]], a[ok], b[ok]


def _grams(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The row of every word and the hash of the GRAM words that begin there; 0 where the row ends before."""
    n = len(words)
    row = np.searchsorted(rows, np.arange(n), "right") - 1
    gram = np.zeros(n, np.uint64)
    if n >= GRAM:
        gram[:n - GRAM + 1] = shingle_hashes(words, GRAM) | np.uint64(1)
    gram[np.arange(n) + GRAM > rows[row + 1]] = 0
    return row, gram


def anchor_spots(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The row of every anchor and its SPOT, with the words from the anchor before and to the end of the next."""
    row, gram = _grams(words, rows)
    wide = np.concatenate([np.zeros(WINDOW, np.uint64), gram, np.zeros(WINDOW, np.uint64)])
    left, right = gram > 0, gram > 0
    clear = left.astype(np.int32)
    for d in range(1, WINDOW):
        left = left & (wide[WINDOW - d:WINDOW - d + len(gram)] > gram)
        right = right & (wide[WINDOW + d:WINDOW + d + len(gram)] >= gram)
        clear += left
        clear += right
    a = np.flatnonzero((gram > 0) & (clear >= np.minimum(WINDOW, (rows[1:] - rows[:-1] - GRAM + 1)[row])))
    e = np.zeros(len(a), SPOT)
    if len(a):
        row = row[a]
        new = np.append(True, row[1:] != row[:-1])
        lo = np.where(new, rows[row], np.append(0, a[:-1]))
        hi = np.where(np.append(new[1:], True), rows[row + 1], np.append(a[1:], 0) + GRAM)
        e["key"], e["start"], e["words"] = _span_hash(words, a, a + GRAM), a - rows[row], GRAM
        e["before"], e["after"], e["n_before"], e["n_after"] = _span_hash(words, lo, a), _span_hash(words, a, hi), a - lo, hi - a - GRAM
        return row, e
    return np.zeros(0, np.int64), e


def edge_spots(words: np.ndarray, rows: np.ndarray, asked: list) -> tuple[np.ndarray, np.ndarray]:
    """The row and SPOT of all GRAM words that begin less than WINDOW words before or after an anchor (``4 * start
    + 2 * before + after``)."""
    _, gram = _grams(words, rows)
    want = np.zeros(len(words) + 1, np.int64)
    for i, spots in enumerate(asked):
        spot = np.array(spots, np.int64)
        at, first, last = rows[i] + (spot >> 2), rows[i], rows[i + 1]
        for lo, hi, on in ((at - WINDOW + 1, at, spot & 2), (at + 1, at + WINDOW, spot & 1)):
            lo, hi = np.clip(lo[on > 0], first, last), np.clip(hi[on > 0], first, last)
            np.add.at(want, lo, 1)
            np.add.at(want, hi, -1)
    a = np.flatnonzero((np.cumsum(want)[:-1] > 0) & (gram > 0))
    row = np.searchsorted(rows, a, "right") - 1
    e = np.zeros(len(a), SPOT)
    e["key"], e["start"], e["words"] = _span_hash(words, a, a + GRAM), a - rows[row], GRAM
    return row, e


def band_keys(words: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``(BANDS, spans)`` keys: equal for two spans whose shingles agree in a band's least hashes. The spans follow each other."""
    every = shingle_hashes(words, SHINGLE)
    cuts = np.stack([a, np.maximum(b - SHINGLE + 1, a + 1)], 1).ravel()
    cuts = np.minimum(cuts, len(every))
    padded = np.append(every, np.uint64(0))
    out = np.zeros((BANDS, len(a)), np.uint64)
    for band in range(BANDS):
        key = np.full(len(a), band + 1, np.uint64)
        for r in range(ROWS):
            salt = mix(np.array([band * ROWS + r + 1], np.uint64))[0] | np.uint64(1)
            value = (padded ^ (salt >> np.uint64(3))) * salt
            value ^= value >> np.uint64(29)
            key = mix(key * _ODD + np.minimum.reduceat(value, cuts)[::2])
        out[band] = key
    return out


def line_table(docs: DataFrame) -> DataFrame:
    """``vertex, doc_id, start, words`` of every line (vertex: hash of its words)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.array(batch.column(0))
            for lo, data, words, where, starts in _batches(batch.column(1)):
                row, a, b = line_spans(data, where, starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_span_hash(words, a, b).view(np.int64)), pa.array(ids[lo + row]), pa.array((a - where[row]).astype(np.int32)), pa.array((b - a).astype(np.int32))],
                    names=["vertex", "doc_id", "start", "words"])

    return materialise(docs.mapInArrow(rows, "vertex long, doc_id long, start int, words int"), "substring-lines")


def similar_lines(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """``(v, component)`` of the lines that are linked to a line of other words."""
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for _, data, words, where, starts in _batches(batch.column(1)):
                _, a, b = line_spans(data, where, starts)
                if not len(a):
                    continue
                vertex = _span_hash(words, a, b).view(np.int64)
                first = np.sort(np.unique(vertex, return_index=True)[1])  # in order of place: the minima of a span are of the span alone
                vertex = vertex[first]
                e = np.zeros(BANDS * len(first), ENTRY)
                e["key"], e["vertex"] = band_keys(words, a[first], b[first]).ravel(), np.tile(vertex, BANDS)
                e["lo"] = e["hi"] = 1
                yield e

    def extract(texts: pa.Array, spots: list) -> Iterator[dict]:
        for lo, _, words, where, _ in _batches(texts):
            for i in range(len(where) - 1):
                got = {}
                for spot in spots[lo + i]:
                    a, n = where[i] + (spot >> 32), spot & 0xFFFFFFFF
                    got[spot] = np.unique(shingle_hashes(words[a:min(a + n, where[i + 1])], SHINGLE))
                yield got

    edges = candidate_edges(docs, entries, 0, 1, "substring-edges")
    place = F.min(F.struct("doc_id", "start", "words")).alias("p")
    spots = lines.groupBy("vertex").agg(place).select("vertex", F.lit(1).alias("size"), "p.doc_id", (F.shiftleft(F.col("p.start").cast("long"), 32) + F.col("p.words")).alias("spot"))
    return linked_components(edges, spots, docs, extract, NUM, DEN, "substring")


def repeated(docs: DataFrame, spots: Callable[..., tuple[np.ndarray, np.ndarray]], name: str) -> DataFrame:
    """The fields of every one of ``spots`` (of words, row offsets and a third column of ``docs``, if any) whose
    key stands in at least two documents; ``cluster`` is its key."""
    n_parts = 2 * partitions(docs.sparkSession)

    def by_key(e: np.ndarray):
        e = e[np.lexsort((e["start"], e["doc"], e["key"]))]
        at = np.flatnonzero(np.append(True, e["key"][1:] != e["key"][:-1])) if len(e) else np.zeros(0, np.int64)
        size = np.diff(np.append(at, len(e)))
        many = (np.minimum.reduceat(e["doc"], at) != np.maximum.reduceat(e["doc"], at)) | (np.maximum.reduceat(e["known"], at) > 0) if len(e) else np.zeros(0, bool)
        return e, at, np.repeat(many, size)

    def out(e: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(e["key"]).view(np.int64)), pa.array(e["doc"]), *(pa.array(np.ascontiguousarray(e[c]).view(np.int64) if e[c].dtype == np.uint64 else e[c]) for c in SENT)], names=["cluster", "doc_id", *SENT])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held):
            e, at, many = by_key(np.concatenate(held))
            heads = np.zeros(len(e), bool)
            heads[at] = True
            known = e[many & heads]
            known["known"] = 1
            go = np.concatenate([known, e[~many]])
            rows = [(p, False, b) for p, b in _blobs((mix(go["key"]) % np.uint64(n_parts)).astype(np.int64), go, n_parts)]
            found = e[many]
            rows += [(int(found["start"][k]) % n_parts, True, found[k:k + (1 << 14)].tobytes()) for k in range(0, len(found), 1 << 14)]
            yield from _packed(rows)

        held, n = [], 0
        for batch in batches:
            ids = np.array(batch.column(0))
            for lo, _, words, where, _ in _batches(batch.column(1)):
                row, e = spots(words, where, *(c.slice(lo, len(where) - 1).to_pylist() for c in batch.columns[2:]))
                e["doc"] = ids[lo + row]
                held.append(e)
                n += len(e)
                if n >= FLUSH:
                    yield from flush(held)
                    held, n = [], 0
        if n:
            yield from flush(held)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, SPOT)]
        for batch in batches:
            for done, data in zip(batch.column("edges").to_pylist(), batch.column("data")):
                got = np.frombuffer(data.as_buffer(), SPOT)
                if done:
                    yield out(got)
                else:
                    held.append(got)
        e, _, many = by_key(np.concatenate(held))
        yield out(e[many & (e["known"] == 0)])

    sent = docs.mapInArrow(send, "part int, edges boolean, data binary").repartition(n_parts, "part")
    schema = "cluster long, doc_id long, start int, words int, before long, after long, n_before int, n_after int"
    return materialise(sent.mapInArrow(meet, schema), name)


def repeated_passages(docs: DataFrame) -> DataFrame:
    """``cluster, doc_id, start, words, kind`` of the repeated anchors, extended, and of what repeats beside them."""
    anchors = repeated(docs, anchor_spots, "substring-anchors").distinct()
    ends = anchors.groupBy("cluster").agg((F.min("before") != F.max("before")).alias("left"), (F.min("after") != F.max("after")).alias("right"))
    anchors = materialise(anchors.join(ends, "cluster"), "substring-ends")
    n_before, n_after = F.when(~F.col("left"), F.col("n_before")).otherwise(0), F.when(~F.col("right"), F.col("n_after")).otherwise(0)
    spans = anchors.select("cluster", "doc_id", (F.col("start") - n_before).alias("start"), (F.col("words") + n_before + n_after).alias("words"), F.lit("anchor").alias("kind"))
    spot = F.col("start").cast("long") * 4 + F.col("left").cast("long") * 2 + F.col("right").cast("long")
    asked = anchors.where("left or right").groupBy("doc_id").agg(F.collect_set(spot).alias("asked"))
    edges = repeated(docs.join(asked, "doc_id").select("doc_id", "text", "asked"), edge_spots, "substring-beside")
    return spans.union(edges.select("cluster", "doc_id", "start", "words", F.lit("beside").alias("kind")))


def _heads(*cols: np.ndarray) -> np.ndarray:
    """Which rows differ from the row before in one of the columns."""
    return np.append(True, np.any([c[1:] != c[:-1] for c in cols], axis=0))[:len(cols[0])]


def _stretches(new: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Where the stretches of spans that overlap or touch begin; the spans are in order of start between the ``new`` ones."""
    new = new.copy()
    top = np.maximum.accumulate((np.cumsum(new) << 32) | end)
    new[1:] |= start[1:] > (top[:-1] & 0xFFFFFFFF)
    return np.flatnonzero(new)


def _partition(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
    """The columns of a partition's rows."""
    held = list(batches)
    return [np.concatenate([c.to_numpy(zero_copy_only=False) for c in cols]) for cols in zip(*(b.columns for b in held))] if held else []


def in_long_stretches(spots: DataFrame, least: int) -> DataFrame:
    """The distinct ones of ``spots(doc_id, start, words, cluster, kind)`` that, merged with what they touch, cover
    ``least`` words; ``lead``: none of its cluster begins before it in its document. ``kind`` is its place in KINDS."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols = _partition(batches)
        if not cols or not len(cols[0]):
            return
        doc, start, words, cluster, kind = cols
        order = np.lexsort((kind, cluster, words, start, doc))
        doc, start, words, cluster, kind = (c[order] for c in cols)
        new = _heads(doc, start, words, cluster, kind)
        doc, start, words, cluster, kind = (c[new] for c in (doc, start, words, cluster, kind))
        end = start.astype(np.int64) + words
        at = _stretches(_heads(doc), start, end)
        long = np.repeat(np.maximum.reduceat(end, at) - start[at] >= least, np.diff(np.append(at, len(doc))))
        doc, start, words, cluster, kind = (c[long] for c in (doc, start, words, cluster, kind))
        order = np.lexsort((start, kind, cluster, doc))
        doc, start, words, cluster, kind = (c[order] for c in (doc, start, words, cluster, kind))
        head = _heads(doc, cluster, kind)
        lead = start == np.repeat(start[head], np.diff(np.append(np.flatnonzero(head), len(doc))))
        for lo in range(0, len(doc), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(c[lo:lo + (1 << 16)]) for c in (doc, start, words, cluster, kind, lead)], names=["doc_id", "start", "words", "cluster", "kind", "lead"])

    kind = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    dealt = spots.select("doc_id", "start", "words", "cluster", kind.alias("kind")).repartition(2 * partitions(spots.sparkSession), "doc_id")
    return dealt.mapInArrow(rows, "doc_id long, start int, words int, cluster long, kind int, lead boolean")


def repeated_spans(docs: DataFrame, least: int = 1) -> DataFrame:
    """``doc_id, start, words, cluster, kind, removed`` of every occurrence in a cluster."""
    docs = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    lines = line_table(docs)
    linked = similar_lines(docs, lines)
    of_line = lines.join(linked, F.col("vertex") == F.col("v"), "left").select(F.coalesce("component", "vertex").alias("cluster"), "doc_id", "start", "words", F.lit("line").alias("kind"))
    again = of_line.groupBy("cluster").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("cluster")
    spots = of_line.join(again, "cluster", "left_semi").union(repeated_passages(docs))
    spots = materialise(in_long_stretches(spots, least), "substring-spots")
    many = spots.groupBy("cluster", "kind").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("cluster", "kind", "first")
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    removed = (F.col("doc_id") > F.col("first")) | ~F.col("lead")
    return spots.join(many.hint("shuffle_hash"), ["cluster", "kind"]).select("doc_id", "start", "words", "cluster", kind.alias("kind"), removed.alias("removed"))


def document_removals(spans: DataFrame, least: int = 1) -> DataFrame:
    """Per document: its smallest cluster id, its merged repeated spans of ``least`` words (word ordinals) and which of them go."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols = _partition(batches)
        if not cols or not len(cols[0]):
            return
        order = np.lexsort((cols[1], cols[4], cols[0]))
        doc, start, words, cluster, removed = (c[order] for c in cols)
        end = start.astype(np.int64) + words
        at = _stretches(_heads(doc, removed), start, end)
        doc, removed, start, end, cluster = doc[at], removed[at], start[at], np.maximum.reduceat(end, at).astype(np.int32), np.minimum.reduceat(cluster, at)
        long = end - start >= least
        order = np.lexsort((removed[long], end[long], start[long], doc[long]))
        doc, removed, start, end, cluster = (c[long][order] for c in (doc, removed, start, end, cluster))
        if not len(doc):
            return
        at = np.flatnonzero(_heads(doc))
        gone = np.add.reduceat((end.astype(np.int64) - start) * removed, at)
        for lo in range(0, len(at), 1 << 12):
            own = at[lo:lo + (1 << 12)]
            upto = int(at[lo + len(own)]) if lo + len(own) < len(at) else len(doc)
            part = pa.StructArray.from_arrays([pa.array(c[own[0]:upto]) for c in (start, end, removed)], names=["start", "end", "removed"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[own]), pa.array(np.minimum.reduceat(cluster[:upto], own)), pa.ListArray.from_arrays(pa.array(np.append(own, upto) - own[0], pa.int32()), part), pa.array(gone[lo:lo + len(own)])],
                names=["doc_id", "cluster", "spans", "removed_words"])

    dealt = spans.select("doc_id", "start", "words", "cluster", "removed").repartition(2 * partitions(spans.sparkSession), "doc_id")
    return dealt.mapInArrow(rows, "doc_id long, cluster long, spans array<struct<start: int, end: int, removed: boolean>>, removed_words long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a passage of at least ``LEAST`` words which repeats in another one."""
    got = document_removals(repeated_spans(read(spark, sf_dir, "documents"), LEAST), LEAST)
    text = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["start"], x["end"], x["removed"].cast("int"))), ",")
    return got.select("doc_id", "cluster", "removed_words", text.alias("spans"))
