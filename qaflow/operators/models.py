"""Model slots and their built-in stand-ins.

The reference calls neural encoders and generators; here each slot is a
plain argument (a function returning a Column or a pandas UDF), and the
defaults are deterministic stand-ins that need no weights:

* U1 encoder: the md5 hash encoder (F14), a vectorised Arrow UDF; its
  long form :func:`hash_encode_long` is the relational, SQL-checkable twin.
* U2 generators: extractive -- pick the context sentence that overlaps the
  question most; and ``lead`` -- the first words of the best context.
  Both are row-local higher-order-function expressions (no shuffle).
* U3 scorer: set-F1 of question and context, returned as text like a model
  would, to be parsed back by R3.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaflow.functions import text as T

HASH_DIM = 64

CACHED_TOKENS = 1 << 16  # codes that a worker keeps: most tokens of a text are frequent ones
ENCODE_ROWS = 1024  # texts encoded at once


def token_code(token: str, dim: int = HASH_DIM) -> int:
    """``sign * (bucket + 1)`` of a token from its md5.

    bucket = first 8 hex digits mod ``dim``; the sign is negative when the
    9th hex digit is >= 8.
    """
    h = hashlib.md5(token.encode()).digest()
    bucket = int.from_bytes(h[:4], "big") % dim + 1
    return -bucket if h[4] >= 128 else bucket


def hash_vectors(normalized: pa.Array, dim: int = HASH_DIM, cache: dict | None = None) -> pa.Array:
    """F14 scatter: F2-normalised texts -> unit vectors (no tokens, or null: the zero vector)."""
    cache, out = {} if cache is None else cache, []
    for lo in range(0, len(normalized), ENCODE_ROWS):
        texts = normalized.slice(lo, ENCODE_ROWS)
        some = np.flatnonzero(pc.not_equal(texts, "").fill_null(False).to_numpy(zero_copy_only=False))
        tokens = pc.split_pattern(texts.take(pa.array(some)), " ")
        flat = tokens.flatten().dictionary_encode()
        if len(cache) > CACHED_TOKENS:
            cache.clear()
        distinct = flat.dictionary.to_pylist()
        for t in distinct:
            if t not in cache:
                cache[t] = token_code(t, dim)
        codes = np.array([cache[t] for t in distinct], dtype=np.int64)[flat.indices.to_numpy()]
        rows = np.repeat(some, pc.list_value_length(tokens).to_numpy())
        M = np.bincount(rows * dim + np.abs(codes) - 1, weights=np.sign(codes), minlength=len(texts) * dim).reshape(-1, dim)
        norms = np.linalg.norm(M, axis=1, keepdims=True)
        out.append(np.divide(M, norms, out=np.zeros_like(M), where=norms > 0).ravel())
    flat = np.concatenate([np.zeros(0), *out])
    return pa.ListArray.from_arrays(pa.array(np.arange(len(normalized) + 1) * dim, pa.int32()), pa.array(flat))


def hash_encoder(dim: int = HASH_DIM):
    """U1 default: ``Column(text) -> Column(array<double>)``, unit norm.

    Normalisation (F2) runs JVM-side; the md5 of each different token, kept for the next time, the
    scatter-add and the norm run in the Arrow UDF.
    """
    cache: dict = {}

    @F.arrow_udf("array<double>")
    def _encode(normalized: pa.Array) -> pa.Array:
        return hash_vectors(normalized, dim, cache)

    def encode(text) -> Column:
        return _encode(T.norm_b(text))

    return encode


def embed(df: DataFrame, text: str, out: str = "embedding", encoder=None) -> DataFrame:
    """Attach a vector per row with a pluggable encoder."""
    enc = encoder or hash_encoder()
    return df.withColumn(out, enc(F.col(text)))


def _hex_int(h: Column, start: int, length: int) -> Column:
    return F.conv(F.substring(h, start, length), 16, 10).cast("bigint")


def hash_encode_long(df: DataFrame, keys: list[str], text: str, dim: int = HASH_DIM) -> DataFrame:
    """F14 long form: ``keys..., bucket, weight`` (weight = sum of token signs).

    Relational twin of :func:`hash_encoder`, used to check it.  The
    (key, bucket) aggregate is partially aggregated map-side, so the
    shuffle is at most ``dim`` rows per text.
    """
    tok = df.select(*keys, F.explode(T.tokens(T.norm_b(text))).alias("t"))
    h = F.md5(F.col("t"))
    coded = tok.select(*keys, (_hex_int(h, 1, 8) % dim).cast("int").alias("bucket"),
                       F.when(_hex_int(h, 9, 1) >= 8, F.lit(-1)).otherwise(F.lit(1)).alias("s"))
    return coded.groupBy(*keys, "bucket").agg(F.sum("s").cast("bigint").alias("weight"))


# ---------------------------------------------------------------------------
# U2 generators
# ---------------------------------------------------------------------------

SENTENCE_SPLIT = "(?U)(?<=[.!?])[\\s\\x1c-\\x1f]+"


def _first_words(s: Column, n: int) -> Column:
    words = F.split(T.strip(s), "(?U)[\\s\\x1c-\\x1f]+", -1)
    return F.array_join(F.slice(words, 1, n), " ")


def extractive_generator(question, contexts, max_len: int = 25) -> Column:
    """U2 stand-in: the context sentence with the largest token overlap with
    the question (ties: lower context rank, then earlier sentence), cut to
    ``max_len`` words.  No contexts gives ``''``.
    """
    def pick(qt):
        cands = F.flatten(F.transform(
            F.coalesce(T._c(contexts), F.array().cast("array<string>")),
            lambda c, i: F.transform(
                F.split(c, SENTENCE_SPLIT, -1),
                lambda s, j: F.struct(
                    F.size(F.array_intersect(T.tokens(T.norm_a(s)), qt)).alias("ov"),
                    (-i).alias("ni"), (-j).alias("nj"), s.alias("s")))))
        return T.let(F.array_max(cands), lambda best: F.coalesce(best["s"], F.lit("")))

    best = T.let(T.tokens(T.norm_a(question)), pick)
    return F.when(F.coalesce(F.size(T._c(contexts)), F.lit(0)) > 0, _first_words(best, max_len)) \
        .otherwise(F.lit(""))


def lead_generator(question, contexts, max_len: int = 25) -> Column:
    """Second U2 stand-in (the ``lora`` slot): first words of the top context."""
    first = F.element_at(F.coalesce(T._c(contexts), F.array().cast("array<string>")), 1)
    return F.coalesce(_first_words(first, max_len), F.lit(""))


# ---------------------------------------------------------------------------
# U3 scorer
# ---------------------------------------------------------------------------

def overlap_scorer(query, context) -> Column:
    """U3 stand-in: set-F1 of query and context, as model-like text."""
    return F.format_string("%.6f", T.f1_set(query, context))


# ---------------------------------------------------------------------------
# Row-exploding map for arbitrary user code
# ---------------------------------------------------------------------------

def explode_batches(df: DataFrame, fn, schema: str) -> DataFrame:
    """The slot for user code that returns other rows than it gets.

    ``fn`` maps one Arrow record batch to one, of any number of rows and of
    ``schema``.  Splitting into passages needs no user code: it is C1
    (:func:`qaflow.operators.chunk.split_passages`).
    """
    def run(batches):
        for batch in batches:
            yield fn(batch)

    return df.mapInArrow(run, schema)
