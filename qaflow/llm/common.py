"""Helpers shared by the operators of this subpackage.

Intermediate tables go to the folder the cluster names in ``spark.checkpoint.dir`` (see
:func:`qaflow.session.scratch_path`), so a lost executor never takes them along and every plan
that follows starts from a written table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qaflow.session import scratch_path


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later jobs start from the written rows."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


MAYBE_BITS = 1 << 23


def _marked(df: DataFrame, key: str, wanted: DataFrame, column: str, how: str) -> tuple[DataFrame, Column]:
    """``df`` joined with a bitmap of fixed size (1 MB, broadcast) of ``column``, and whether ``key`` may be in it."""
    bit = unused(df, "bit")
    at, bits = unused(df, f"{bit}_at"), unused(df, f"{bit}_map")
    cell = lambda c: F.pmod(F.xxhash64(c), F.lit(MAYBE_BITS))
    inner = lambda c: F.col(c).bitwiseAND(32767)  # noqa: E731  a row of the map has 4 KB
    held = wanted.select(cell(column).alias(bit)).groupBy(F.shiftright(bit, 15).alias(at)).agg(F.bitmap_construct_agg(inner(bit)).alias(bits))
    byte = F.conv(F.hex(F.substring(F.col(bits), F.shiftright(inner(bit), 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = df.withColumn(bit, cell(key)).withColumn(at, F.shiftright(bit, 15)).join(F.broadcast(held), at, how)
    return marked, F.coalesce(F.getbit(byte, inner(bit).bitwiseAND(7).cast("int")) == 1, F.lit(False))


def may_match(df: DataFrame, key: str, wanted: DataFrame, column: str) -> DataFrame:
    """The rows of ``df`` whose ``key`` may be in ``column`` of ``wanted``: none that is gets lost, and a join
    with ``wanted`` moves few others. More keys only let more rows pass."""
    marked, may = _marked(df, key, wanted, column, "inner")
    return marked.where(may).select(*df.columns)


def unmatched(df: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``key`` is not in ``gone(key)`` or is null; only rows that may be in it are moved."""
    marked, may = _marked(df, key, gone, key, "left")
    rest = marked.where(may).select(*df.columns).join(gone, key, "left_anti").select(*df.columns)
    return marked.where(~may).select(*df.columns).union(rest)


def unused(df: DataFrame, name: str) -> str:
    """A column name that starts with ``name`` and that ``df`` does not have, whatever the case of its letters."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- hashing of words and shingles, vectorised over whole Arrow batches -------------------------

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1
_SLICE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift, multiply, twice)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_FOLD = _BYTE.copy()
_FOLD[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64 and of its inverse, at least ``n`` of each."""
    if not _POWERS or len(_POWERS[0]) < n:
        size, base = max(n, _SLICE + 1), 0x2545F4914F6CDD1D
        for b in (base, pow(base, -1, 1 << 64)):
            out = np.empty(size, dtype=np.uint64)
            out[0], done = 1, 1
            while done < size:
                step = min(done, size - done)
                out[done:done + step] = out[:step] * np.uint64(pow(b, done, 1 << 64))
                done += step
            _POWERS.append(out)
        del _POWERS[:-2]
    return _POWERS[0], _POWERS[1]


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its row offsets; a null row is empty."""
    col = col.cast(pa.large_string()).fill_null("")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def _slices(data: np.ndarray, offsets: np.ndarray):
    """Byte ranges of about _SLICE that end at a row boundary or, inside a long row, at a space."""
    lo, n = 0, len(data)
    while lo < n:
        row_end = int(offsets[np.searchsorted(offsets, lo, "right")])
        if row_end - lo <= _SLICE:
            hi = int(offsets[np.searchsorted(offsets, lo + _SLICE, "right") - 1])
        else:
            hi = lo + _SLICE
            while hi < row_end and not _SPACE[data[hi]]:
                step = np.flatnonzero(_SPACE[data[hi:hi + 4096]])
                hi = min(row_end, hi + (int(step[0]) if len(step) else 4096))
        yield lo, hi
        lo = hi


def word_hashes(data: np.ndarray, offsets: np.ndarray, fold: bool = True):
    """64-bit hashes of the white-space separated words (A-Z folded), and per row where its words
    begin: ``(hashes, first_word_of_row, byte_start_of_word)``."""
    table = _FOLD if fold else _BYTE
    hashes, starts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    row_start = np.zeros(len(data) + 1, dtype=bool)
    row_start[offsets] = True
    for lo, hi in _slices(data, offsets):
        d = data[lo:hi]
        space = _SPACE[d]
        cut = row_start[lo:hi]
        before = np.empty(len(d), dtype=bool)
        before[0] = True
        before[1:] = space[:-1]
        begin = np.flatnonzero(~space & (before | cut))
        after = np.empty(len(d), dtype=bool)
        after[-1] = True
        after[:-1] = space[1:] | cut[1:]
        end = np.flatnonzero(~space & after) + 1
        power, inverse = _powers(len(d) + 1)
        total = np.zeros(len(d) + 1, dtype=np.uint64)
        np.cumsum(table[d] * power[:len(d)], out=total[1:])
        value = (total[end] - total[begin]) * inverse[begin]
        hashes.append(mix(value + (end - begin).astype(np.uint64) * _ODD))
        starts.append(begin + lo)
    where = np.concatenate(starts)
    return np.concatenate(hashes), np.searchsorted(where, offsets), where


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every ``k`` consecutive words; with fewer words, of the whole sequence; none of none."""
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    k = min(k, len(words))
    n = len(words) - k + 1
    out = words[:n].copy()
    for j in range(1, k):
        out = out * _ODD + words[j:j + n]
    return mix(out + np.uint64(k))


def set_id(values: np.ndarray) -> int:
    """A signed 64-bit id of a set of hashes."""
    a = int(np.add.reduce(mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64))
    b = int(np.bitwise_xor.reduce(mix(values + np.uint64(0x5851F42D4C957F2D)))) if len(values) else 0
    return int(mix(np.array([(a * 3 + b * 5 + len(values)) & _MASK], np.uint64)).view(np.int64)[0])


# --- connected components -----------------------------------------------------------------------

def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(v, component)`` for every vertex of ``edges(a, b)``: component is the smallest reachable id.

    Alternating large-star / small-star contraction. Every round is two aggregates and two joins
    over the edges (no per-component group, no driver state but a count and a checksum); its result
    is written to the shared folder. Joins on hub vertices are left to AQE's skew splitting.
    """
    def distinct(df):
        return df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def mark(df):
        return tuple(df.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())

    cur = materialise(distinct(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))), name)
    was = mark(cur)
    while True:
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = distinct(both.where("v > u").join(low, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = materialise(large, name)
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        small = large.join(least, F.col("u") == F.col("k"))
        small = small.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        cur = materialise(distinct(small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))), name)
        now = mark(cur)
        if now == was:
            break
        was = now
    roots = cur.select(F.col("v")).distinct().select("v", F.col("v").alias("component"))
    return cur.select(F.col("u").alias("v"), F.col("v").alias("component")).union(roots)
