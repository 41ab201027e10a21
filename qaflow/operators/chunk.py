"""Chunking and sequence shaping.

All row-local: ``split`` / ``slice`` / ``transform`` / ``posexplode``.
A document is never gathered with others, so a 20,000-word text costs
one task-local expression and no shuffle.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qaflow.functions import text as T

# Reserved token ids of the word vocabulary (C4): fixed by this library.
PAD_ID, EOS_ID, UNK_ID, START_ID = 0, 1, 2, 3
FIRST_WORD_ID = 4


def ws_tokens(x) -> Column:
    """Whitespace tokens of the stripped text; ``''`` gives an empty list."""
    return T.let(T.strip(x), lambda s: F.when(s == "", F.array().cast("array<string>")).otherwise(
        F.split(s, "(?U)[\\s\\x1c-\\x1f]+", -1)))


def split_passages(df: DataFrame, n: int = 100, *, text: str = "text", title: str = "title",
                   key: str = "doc_id", sep: str = " ") -> DataFrame:
    """C1 with P1/P2: null text dropped, null title -> '', split every n-th ``sep``.

    Returns ``key, idx, title, text`` (idx from 0 within the document).
    """
    src = df.where(F.col(text).isNotNull())
    return src.select(
        F.col(key), F.coalesce(F.col(title), F.lit("")).alias("title"),
        F.posexplode(T.chunk_words(F.col(text), n, sep)).alias("idx", "text"),
    ).select(key, F.col("idx").cast("int"), "title", "text")


def lead_chunk(df: DataFrame, size: int = 100, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Only the first ``size`` whitespace tokens of each text, re-joined."""
    return df.where(F.col(text).isNotNull()).select(
        key, F.array_join(F.slice(ws_tokens(text), 1, size), " ").alias("text"))


def sliding_chunks(df: DataFrame, size: int = 100, stride: int = 0, *, text: str = "text",
                   key: str = "doc_id") -> DataFrame:
    """Windows of ``size`` tokens overlapping by ``stride`` (stride < size)."""
    if not 0 <= stride < size:
        raise ValueError("stride must satisfy 0 <= stride < size")
    # windows are built inside the row (tokens bound once), then exploded:
    # no exploded row ever carries the whole token array of its document
    windows = T.let(ws_tokens(text), lambda toks: F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(toks) - stride - 1, F.lit(0)), F.lit(size - stride)),
        lambda s: F.slice(toks, s + 1, F.lit(size))))
    return (df.where(F.col(text).isNotNull())
            .select(key, F.posexplode(windows).alias("idx", "_w"))
            .select(key, F.col("idx").cast("int"), F.size("_w").alias("n_tokens"),
                    F.array_join("_w", " ").alias("text")))


# ---------------------------------------------------------------------------
# Fixed-length id sequences over a word vocabulary
# ---------------------------------------------------------------------------

def build_vocab(tokens_df: DataFrame, token: str = "token") -> DataFrame:
    """Dense word ids in lexical order, starting after the reserved ids.

    ``distinct`` is partially aggregated per task; ids come from the
    distributed dense numbering (no single-partition window).
    """
    from qaflow.operators.split import dense_ids

    words = tokens_df.select(F.col(token).alias("token")).distinct()
    return dense_ids(words, ["token"], out="tid").select(
        "token", (F.col("tid") + FIRST_WORD_ID).cast("int").alias("id"))


VOCAB_BROADCAST_MAX_ROWS = 2_000_000


def encode_tokens(df: DataFrame, key: str, toks: str, vocab: DataFrame, out: str = "ids", *,
                  broadcast_max_rows: int = VOCAB_BROADCAST_MAX_ROWS, salts: int = 16) -> DataFrame:
    """Map a token array to vocabulary ids, keeping order (unknown -> UNK).

    A vocabulary of at most ``broadcast_max_rows`` words (checked with a
    bounded fetch) is shipped once and applied per Arrow batch: no shuffle,
    and a very frequent token costs nothing extra.  A larger vocabulary is
    joined relationally: occurrences are exploded with a salt in
    ``[0, salts)`` taken from (row, position), and every vocabulary row is
    replicated once per salt, so a token holding a third of all occurrences
    is spread over ``salts`` join tasks.  Ids are re-collected per row in
    position order (a row's own tokens only).
    """
    head = vocab.select("token", "id").limit(broadcast_max_rows + 1).toPandas()
    if len(head) <= broadcast_max_rows:
        return _encode_with_dict(df, toks, head, out)
    long = df.select(key, F.posexplode(toks).alias("p", "token")).withColumn(
        "_salt", F.pmod(F.xxhash64(key, "p"), F.lit(salts)).cast("int"))
    salted_vocab = vocab.select("token", "id", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    joined = long.join(salted_vocab, ["token", "_salt"], "left").select(
        key, "p", F.coalesce("id", F.lit(UNK_ID)).alias("id"))
    enc = joined.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("p", "id"))).alias("_s"))
    return (df.join(enc, key, "left")
            .withColumn(out, F.coalesce(F.col("_s.id"), F.array().cast("array<int>"))).drop("_s"))


def _encode_with_dict(df: DataFrame, toks: str, vocab_pdf, out: str) -> DataFrame:
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast(pd.Series(vocab_pdf["id"].to_numpy(dtype=np.int32),
                                                index=vocab_pdf["token"].to_numpy()))

    @F.pandas_udf("array<int>")
    def _ids(col: pd.Series) -> pd.Series:
        lookup = bc.value
        lens = col.map(lambda a: 0 if a is None else len(a)).to_numpy()
        flat = [t for a in col.to_numpy() if a is not None for t in a]
        ids = pd.Series(flat, dtype=object).map(lookup).fillna(UNK_ID).to_numpy(dtype=np.int32) \
            if flat else np.zeros(0, dtype=np.int32)
        return pd.Series([a.tolist() for a in np.split(ids, np.cumsum(lens)[:-1])] if len(lens) else [])

    return df.withColumn(out, F.coalesce(_ids(F.col(toks)), F.array().cast("array<int>")))


def append_eos(ids) -> Column:
    """End marker appended."""
    return F.concat(T._c(ids), F.array(F.lit(EOS_ID)))


def encode_fixed(ids, max_len: int, pad: int = PAD_ID) -> tuple[Column, Column]:
    """C4: truncate to ``max_len``, pad right; returns (ids, attention mask)."""
    cut = F.slice(T._c(ids), 1, max_len)
    n = F.size(cut)
    padded = F.concat(cut, F.array_repeat(F.lit(pad), F.lit(max_len) - n))
    mask = F.transform(F.sequence(F.lit(1), F.lit(max_len)), lambda i: F.when(i <= n, 1).otherwise(0))
    return padded, mask


def real_length(ids, pad: int = PAD_ID) -> Column:
    return F.size(F.filter(T._c(ids), lambda x: x != pad))


def trim_batch(df: DataFrame, batch: str, cols: list[str], pad: int = PAD_ID) -> DataFrame:
    """Drop the trailing columns that are pad in the whole batch.

    Right padding only, so the kept width is the batch's longest real length.
    """
    w = Window.partitionBy(batch)
    width = F.max(F.greatest(*[real_length(c, pad) for c in cols])).over(w) if len(cols) > 1 \
        else F.max(real_length(cols[0], pad)).over(w)
    out = df.withColumn("_width", width)
    for c in cols:
        out = out.withColumn(c, F.slice(c, 1, F.col("_width")))
    return out.drop("_width")


def tokens_per_batch(df: DataFrame, batch: str, src: str, tgt: str, pad: int = PAD_ID) -> DataFrame:
    """Non-pad source plus target tokens per batch."""
    return df.groupBy(batch).agg(
        F.sum(real_length(src, pad) + real_length(tgt, pad)).cast("bigint").alias("tokens"))


def shift_targets(ids, start: int = START_ID) -> tuple[Column, Column, Column]:
    """Teacher-forcing views (drop last, drop first, start id prepended)."""
    a = T._c(ids)
    n = F.size(a)
    drop_last = F.slice(a, 1, F.greatest(n - 1, F.lit(0)))
    drop_first = F.when(n > 1, F.slice(a, 2, n)).otherwise(F.array().cast("array<int>"))
    with_start = F.concat(F.array(F.lit(start)), drop_last)
    return drop_last, drop_first, with_start


def mask_to_pad(ids, pad: int = PAD_ID, ignore: int = -100) -> Column:
    """Replace the loss-ignore id with the pad id."""
    return F.transform(T._c(ids), lambda x: F.when(x == ignore, F.lit(pad)).otherwise(x))
