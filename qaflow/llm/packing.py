"""Best-fit packing with certified repacking.

Documents are tokenised once (a written table of pieces with lengths and checksums); packing then moves
only those narrow rows. Pieces are dealt by a hash over partitions of about ``items_per_partition`` and
every partition runs best-fit decreasing. Dual feasible functions bound its number of bins from below:
if they meet, the partition's count is certified and stays. Partitions with a gap, and the emptiest bin
of every partition, give their worst-filled bins to an exchange; the exchanged bins are dealt anew by
whole bins, best-fit decreasing runs again in each pool, and its packing is taken where it needs fewer
bins. This repeats until nothing is gained. All of it is bounded by the partition size: no partition and
no exchange sees the whole corpus, and only totals reach the driver.

Defined cases: a null text is empty (its one id is the separator); a null or repeated ``doc_id`` is
carried along, every row is packed on its own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaflow.llm.common import materialise, read

CAPACITY = 2048
SEPARATOR = 0
ITEMS_PER_PARTITION = 20_000
MAX_ROUNDS = 4
CACHE_WORDS = 1_000_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, rid long"


# --- tokenising ----------------------------------------------------------------------------------

#: White space on which every part of the word tokenizer agrees; text with any other goes the plain way.
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
#: A word whose normal form and split are plain: Latin-1 letters, then a run of ASCII marks (no apostrophe, no "<|").
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!\"#$%&()*+,\-./:;=>?@\[\\\]^_`{}~|]*)")
_WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet by its rule: printable bytes stand for themselves, the rest for code points from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordTokenizer:
    """Ids of a text, as little-endian unsigned 32-bit bytes; exactly those of the tokenizer file.

    A tokenizer that drops white space and splits there encodes each word alone, so words are looked up
    in a bounded cache and only new ones are encoded. Any other tokenizer encodes the whole text.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(definition)
        d = json.loads(definition)
        steps = [(n["type"], n.get("content")) for n in (d.get("normalizer") or {}).get("normalizers", [])]
        split = ((d.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])
        self.by_word = (steps == [("NFC", None), ("Replace", " "), ("Lowercase", None)]
                        and split[0].get("pattern") == {"Regex": _WORD_SPLIT} and split[0].get("invert") is True)
        self.letters, self.cache, self.parts = _byte_letters(), {}, {}

    def _plain(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, text: str) -> bytes:
        got = self.parts.get(text)
        if got is None:
            if len(self.parts) >= CACHE_WORDS:
                self.parts.clear()
            mapped = text if text.isascii() else "".join(map(self.letters.__getitem__, text.encode()))
            got = self.parts[text] = np.array([t.id for t in self.tok.model.tokenize(mapped)], "<u4").tobytes()
        return got

    def _word(self, word: str) -> bytes:
        m = _PLAIN.fullmatch(word) if len(word) < 200 else None
        if m is None:
            return self._plain(word)
        return (self._part(m[1].lower()) if m[1] else b"") + (self._part(m[2]) if m[2] else b"")

    def encode(self, text: str) -> bytes:
        if not self.by_word or _ODD_SPACE.search(text):
            return self._plain(text)
        cache, out = self.cache, []
        for w in text.split():
            ids = cache.get(w)
            if ids is None:
                if len(cache) >= CACHE_WORDS:
                    cache.clear()
                ids = cache[w] = self._word(w)
            out.append(ids)
        return b"".join(out)


_TOKENIZERS: dict[int, WordTokenizer] = {}


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, separator: int = SEPARATOR) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, rid`` of every row's ids and separator, cut only beyond ``capacity``.

    The tokenizer file is read once, by the driver, and shipped (a bounded file); a worker keeps one
    tokenizer with its word cache. ``rid`` numbers the rows of the written table."""
    with open(tokenizer_path, encoding="utf-8") as f:
        shipped = docs.sparkSession.sparkContext.broadcast(f.read())
    tail = np.array([separator], "<u4").tobytes()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        definition = shipped.value
        tok = _TOKENIZERS.get(zlib.crc32(definition.encode()))
        if tok is None:
            tok = _TOKENIZERS[zlib.crc32(definition.encode())] = WordTokenizer(definition)
        rid = TaskContext.get().partitionId() << 36
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = tok.encode(text.as_py() or "") + tail
                n = len(ids) // 4
                for k, a in enumerate(range(0, n, capacity)):
                    part = ids[4 * a:4 * (a + capacity)]
                    out.append((doc, k, a, len(part) // 4, zlib.crc32(part), rid))
                    rid += 1
            cols = list(zip(*out)) or [()] * 6
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["doc_id", "piece", "start", "length", "ids_crc32", "rid"])

    return materialise(docs.select("doc_id", "text").mapInArrow(rows, PIECES), "packing-pieces")


# --- packing -------------------------------------------------------------------------------------

def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every item; bins are found by their room through a bit set of the rooms in use."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, n = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = used >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                used ^= 1 << room
        else:
            b, room, n = n, capacity, n + 1
        bins[i], offsets[i] = b, capacity - room
        if room := room - size:
            by_room[room].append(b)
            used |= 1 << room
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int, functions: int = 24) -> int:
    """Bins that any packing needs: the best of two families of dual feasible functions.

    For each threshold a: items over capacity - a count as full bins, those under a as nothing, the rest
    by size. For each k: size x (of 1) counts floor((k + 1) x) / k, or x where (k + 1) x is whole.
    """
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    sizes = np.arange(capacity + 1, dtype=np.int64)
    up_to, sum_to = np.cumsum(counts), np.cumsum(counts * sizes)
    a = np.arange(0, capacity // 2 + 1)
    full = up_to[-1] - up_to[capacity - a]
    rest = sum_to[capacity - a] - np.where(a > 0, sum_to[np.maximum(a - 1, 0)], 0)
    best = int((full - (-rest // capacity)).max())
    for k in range(1, functions + 1):
        scaled = (k + 1) * sizes
        whole = scaled % capacity == 0
        by_size = int((counts * sizes)[whole].sum())
        by_step = int((counts * (scaled // capacity))[~whole].sum())
        best = max(best, -(-(by_size * k + by_step * capacity) // (capacity * k)))
    return best


_PACKED = PIECES + ", sequence_id long, offset long, released boolean, bins long, bound long"


def _release(bins: np.ndarray, lengths: np.ndarray, capacity: int, gap: int) -> np.ndarray:
    """Which items' bins go to the exchange: the emptiest one, with a gap the worst-filled ones."""
    fill = np.bincount(bins, weights=lengths)
    worst = np.argsort(fill, kind="stable")[:1 if gap <= 0 else max(64, 16 * gap)]
    chosen = np.zeros(len(fill), bool)
    chosen[worst[fill[worst] < capacity]] = True
    return chosen[bins]


def pack(pieces: DataFrame, capacity: int = CAPACITY, items_per_partition: int = ITEMS_PER_PARTITION, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``bins`` and ``bound`` (on one row of each partition or pool) certify the counts."""
    def solve(round_no: int):
        def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("rid", kind="stable").reset_index(drop=True)
            lengths = pdf["length"].to_numpy()
            bins, offsets = best_fit_decreasing(lengths, capacity)
            seq = (np.int64(round_no) << np.int64(56)) | (np.int64(key[0]) << np.int64(28)) | bins
            if round_no:
                old, old_n = np.unique(pdf["sequence_id"].to_numpy(), return_inverse=True)
                if bins.max() + 1 >= len(old):
                    bins, offsets, seq = old_n, pdf["offset"].to_numpy(), pdf["sequence_id"].to_numpy()
            n, bound = int(bins.max()) + 1, lower_bound(lengths, capacity)
            first = np.arange(len(pdf)) == 0
            out = pdf[["doc_id", "piece", "start", "length", "ids_crc32", "rid"]].copy()
            out["sequence_id"], out["offset"], out["released"] = seq, offsets, _release(bins, lengths, capacity, n - bound)
            out["bins"], out["bound"] = np.where(first, n, 0), np.where(first, bound, 0)
            return out
        return run

    def totals(df: DataFrame) -> tuple[int, int, int]:
        r = df.agg(F.sum("bins"), F.sum("bound"), F.sum(F.col("released").cast("int"))).first()
        return tuple(int(x or 0) for x in r)

    n = pieces.count()
    parts = max(1, -(-n // items_per_partition))
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("rid"), F.lit(parts)))
    cur = materialise(dealt.groupBy("part").applyInPandas(solve(0), _PACKED), "packing-0")
    done = cur.where("not released")
    for r in range(1, max_rounds + 1):
        bins, bound, out = totals(cur)
        if not out or (r > 1 and bins == bound):
            break
        moved = cur.where("released")
        pools = max(1, -(-out // items_per_partition))
        dealt = moved.withColumn("part", F.pmod(F.xxhash64("sequence_id", F.lit(r)), F.lit(pools)))
        new = materialise(dealt.groupBy("part").applyInPandas(solve(r), _PACKED), f"packing-{r}")
        before = moved.select("sequence_id").distinct().count()
        cur = new
        done = done.union(new.where("not released"))
        if totals(new)[0] >= before or pools == 1:
            break
    return done.union(cur.where("released"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(tokenised_pieces(docs, tokenizer_path, capacity), capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"), default_tokenizer())
