"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures, exact sorted-array intersection.

A document's set: the distinct hashes of its ``k``-word shingles (A-Z folded, white space separated).
Equal sets collapse to one vertex at once. The other links are found exactly: two sets with Jaccard of
at least num / den share ``s`` of their first ``n - ceil(n * num / den) + s`` shingles in any common order,
``s`` being 1 and one more for every SHARED shingles of the smaller set;
the order puts shingles of rarely used cells first (counts over all documents in a table of fixed size),
and last all that more than SHORT documents hold, by how many (counted one by one: with many documents every
cell is much used, and a passage of a few dozen documents would pass for rare and join them up). Sharers with
fitting sizes go to tiles; see :mod:`qaflow.llm.simjoin`. Shingles are compared by 64-bit hashes.

Of equal texts one is read after the first pass. Bitmaps are made of candidates only.

Defined cases: a document without words or text has an empty set and is linked with nothing; with fewer
words than ``k`` the whole sequence is its one shingle; rows with a null ``doc_id`` get the component of
the documents with their very set, or null, and make no other links; repeated rows are copies; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaflow.llm.common import materialise, may_match, partitions, read, set_id, shingle_hashes, text_bytes, unmatched, word_hashes
from qaflow.llm.simjoin import ENTRY, SHORT, _blobs, candidate_edges, linked_components

CELL_BITS = 20
CELL_BLOCK = 1 << 16
SHARED = 40
REST_BITS = 24
_SETS = "doc_id long, n_shingles long, vertex long, block int, counts binary"


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    for lo in range(0, len(texts), 1024):
        data, offsets = text_bytes(texts.slice(lo, 1024))
        words, rows, _ = word_hashes(data, offsets)
        every = shingle_hashes(words, k) if len(words) >= k else np.zeros(0, np.uint64)
        for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
            yield np.unique(every[a:b - k + 1] if b - a >= k else shingle_hashes(words[a:b], k))


def document_sets(docs: DataFrame, k: int) -> DataFrame:
    """One pass: ``doc_id, n_shingles, vertex`` of every row (the last null for an empty set), and on rows
    with a ``block`` each task's counts of the shingle cells."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_shingles", "vertex", "block", "counts"]
        cells = np.zeros(1 << CELL_BITS, np.int64)
        held, n = [], 0

        def drain():
            nonlocal held, n, cells
            if n:
                cells += np.bincount((np.concatenate(held) >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=len(cells))
            held, n = [], 0

        for batch in batches:
            sizes, ids = [], []
            for s in shingle_sets(batch.column(1), k):
                sizes.append(len(s))
                ids.append(set_id(s) if len(s) else None)
                held.append(s)
                n += len(s)
                if n > 2_000_000:
                    drain()
            m = len(sizes)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names=names)
        drain()
        if cells.any():
            small = np.minimum(cells, 0xFFFFFFFF).astype("<u4")
            blocks = range(0, len(cells), CELL_BLOCK)
            null = pa.nulls(len(blocks), pa.int64())
            yield pa.RecordBatch.from_arrays([null, null, null, pa.array(range(len(blocks)), pa.int32()), pa.array([small[b:b + CELL_BLOCK].tobytes() for b in blocks], pa.binary())], names=names)

    return materialise(docs.select("doc_id", "text").mapInArrow(rows, _SETS), "jaccard-sets")


def cell_ranks(sets: DataFrame) -> np.ndarray:
    """A rank in 0..255 of every cell by its count over all documents; the table's size is fixed (1 MB)."""
    def total(table: pa.Table, kind: str) -> np.ndarray:
        out = np.zeros(CELL_BLOCK, np.int64)
        for c in table.column("counts"):
            out += np.frombuffer(c.as_buffer(), kind)
        return out

    def add(key: tuple, table: pa.Table) -> pa.Table:
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total(table, "<u4").tobytes()], pa.binary())})

    def rank(key: tuple, table: pa.Table) -> pa.Table:
        ranks = np.minimum(255, np.log2(1 + total(table, "<i8")) * 6).astype(np.uint8)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "ranks": pa.array([ranks.tobytes()], pa.binary())})

    # two levels: a group adds up about the square root of the number of tasks
    parts = sets.where("block is not null")
    salts = max(1, int((parts.count() * CELL_BLOCK / (1 << CELL_BITS)) ** 0.5))
    salted = parts.select("block", "counts", F.pmod(F.xxhash64("counts"), F.lit(salts)).alias("salt"))
    part = salted.groupBy("block", "salt").applyInArrow(add, "block int, counts binary")
    got = part.groupBy("block").applyInArrow(rank, "block int, ranks binary").collect()
    out = np.zeros(1 << CELL_BITS, np.uint8)
    for r in got:
        out[r["block"] * CELL_BLOCK:(r["block"] + 1) * CELL_BLOCK] = np.frombuffer(r["ranks"], np.uint8)
    return out


class Shared:
    """The shingles that more than SHORT documents hold, in two tables of limited size: a bit of each (by part and
    leading bits of the rest of the hash), and a rank by its number of documents. Others may pass for them."""

    def __init__(self, n_parts: int):
        lead = (n_parts - 1).bit_length()
        self.n_parts, self.bits, self.levels = n_parts, min(18, max(3, 27 - lead)), min(18, max(3, 20 - lead))
        self.held = np.zeros((n_parts, 1 << self.bits >> 3), np.uint8)
        self.level = np.zeros((n_parts, 1 << self.levels), np.uint8)

    def place(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The part, and the rest of the hash."""
        return (s % np.uint64(self.n_parts)).astype(np.int64), (s >> np.uint64(20)).astype(np.int64) & (1 << REST_BITS) - 1

    def tables(self, rest: np.ndarray, n: np.ndarray) -> tuple[bytes, bytes]:
        """A part's rows of the two tables."""
        bits, level = np.zeros(1 << self.bits, np.uint8), np.zeros(1 << self.levels, np.uint8)
        bits[rest >> REST_BITS - self.bits] = 1
        np.maximum.at(level, rest >> REST_BITS - self.levels, np.minimum(127, np.log2(n) * 6).astype(np.uint8))
        return np.packbits(bits).tobytes(), level.tobytes()

    def add(self, part: int, held: bytes, level: bytes) -> None:
        self.held[part], self.level[part] = np.frombuffer(held, np.uint8), np.frombuffer(level, np.uint8)

    def rank(self, s: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Ranks 128 to 255 of the shared ones, 0 to 127 by ``other`` (0 to 255) of the rest."""
        part, rest = self.place(s)
        at = rest >> REST_BITS - self.bits
        shared = (self.held[part, at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
        return np.where(shared == 1, 128 + self.level[part, rest >> REST_BITS - self.levels], other >> 1).astype(np.uint64)


def shared_shingles(texts: DataFrame, k: int) -> Shared:
    """Counts every shingle of ``texts(text)``, once a text (three bytes of its hash are sent, the part gives the rest)."""
    out = Shared(2 * partitions(texts.sparkSession))
    n_parts, place, tables = out.n_parts, out.place, out.tables
    names = ["part", "data"]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            part, rest = place(np.concatenate(held))
            rows = list(_blobs(part, rest.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3], n_parts))
            for a in range(0, len(rows), 256):
                p, data = zip(*rows[a:a + 256])
                yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(data, pa.binary())], names=names)

        held, n, seen = [], 0, set()
        for batch in batches:
            for s in shingle_sets(batch.column(0), k):
                if not len(s) or (v := set_id(s)) in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(v)
                held.append(s)
                n += len(s)
                if n > 2_000_000:
                    yield from flush()
                    held, n = [], 0
        if n:
            yield from flush()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        size: dict[int, int] = {}
        total: dict[int, np.ndarray] = {}

        def fold(p):
            x = np.zeros((size.pop(p) // 3, 4), np.uint8)
            x[:, :3] = np.frombuffer(b"".join(held.pop(p)), np.uint8).reshape(-1, 3)
            rest, n = np.unique(x.view("<u4").ravel(), return_counts=True)
            t = total.setdefault(p, np.zeros(1 << REST_BITS, np.uint16))
            t[rest] = np.minimum(t[rest] + n, 0xFFFF)

        for batch in batches:
            for p, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(p, []).append(data)
                size[p] = size.get(p, 0) + len(data)
                if size[p] > 12 << 20:
                    fold(p)
        for p in sorted({*held, *total}):
            if p in held:
                fold(p)
            t = total.pop(p)
            rest = np.flatnonzero(t > SHORT)
            if len(rest):
                bits, level = tables(rest, t[rest])
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([bits], pa.binary()), pa.array([level], pa.binary())], names=["part", "held", "level"])

    sent = texts.mapInArrow(send, "part int, data binary").repartition(n_parts, "part")
    for r in sent.mapInArrow(count, "part int, held binary, level binary").collect():
        out.add(r["part"], r["held"], r["level"])
    return out


def jaccard_components(docs: DataFrame, k: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs(doc_id, text)``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    made = document_sets(docs, k)
    sets = made.where("block is null").select("doc_id", "n_shingles", "vertex")
    where = materialise(made.where("vertex is not null").groupBy("vertex").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("size")), "jaccard-where")
    texts = may_match(docs, "doc_id", where, "doc_id").select("text")
    ranks = spark.sparkContext.broadcast((cell_ranks(made), shared_shingles(texts, k)))

    def shared(n):
        return np.maximum(1, np.minimum(1 + n // SHARED, -(-n * num // den)))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        (cells, common), seen = ranks.value, set()
        for batch in batches:
            for s in shingle_sets(batch.column(0), k):
                n = len(s)
                if not n or (v := set_id(s)) in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(v)
                order = np.sort((common.rank(s, cells[(s >> np.uint64(64 - CELL_BITS)).astype(np.int64)]) << np.uint64(56)) | (s >> np.uint64(8)))
                e = np.zeros(n - (n * num + den - 1) // den + int(shared(n)), ENTRY)
                e["key"], e["vertex"], e["lo"], e["hi"] = order[:len(e)], v, n, np.arange(len(e)) - n
                yield e

    def extract(texts: pa.Array, spots: list) -> Iterator[dict]:
        for s, want in zip(shingle_sets(texts, k), spots):
            v = set_id(s)
            yield {v: s} if v in want else {}

    edges = candidate_edges(texts, prefixes, num, den, "jaccard-edges", shared)
    spots = where.where("doc_id is not null").select("vertex", "size", "doc_id", F.col("vertex").alias("spot"))
    linked = linked_components(edges, spots, docs, extract, num, den, "jaccard", sketches=True)
    rep = materialise(where.select("vertex", F.col("doc_id").alias("first")).join(linked, F.col("vertex") == F.col("v"), "left")
                      .select("vertex", "first", F.coalesce("component", "vertex").alias("component")), "jaccard-vertices")
    least = rep.groupBy("component").agg(F.min("first").alias("component_id"))
    label = rep.join(least, "component").select("vertex", "component_id")
    return sets.join(label, "vertex", "left").select(
        "doc_id", "n_shingles", F.when(F.col("vertex").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` that are the smallest ``doc_id`` of their component, once each; rows with a
    null ``doc_id`` stay (nothing tells them apart from others)."""
    gone = jaccard_components(docs, k, num, den).where("component_id < doc_id").select("doc_id")
    return unmatched(docs, "doc_id", materialise(gone.distinct(), "jaccard-gone"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents").select("doc_id", "text"))
