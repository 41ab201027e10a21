"""Vectors, cell index and similarity joins.

Shape of the similarity join at scale
-------------------------------------
The inherent work of an exact top-k join is |Q| x |C| dot products, but
the *output* must stay O(|Q| k).  Both physical paths below therefore do
the dot products in vectorised numpy inside Spark tasks and keep a running
top-k per query while streaming the corpus, so no task ever emits the pair
product:

* **broadcast path** -- when the query side is provably small (row count x
  dimension x 8 bytes under ``broadcast_max_bytes``, checked before anything
  is collected), the query block is shipped once to every executor and the
  corpus is scanned by ``mapInPandas`` with no shuffle at all.  Each task
  emits at most k rows per query; a final ``row_number`` window (Catalyst
  turns it into ``WindowGroupLimit``) keeps the global top-k.
* **block path** -- beyond that size, queries and corpus are cut into
  blocks of at most ``BLOCK_ROWS`` per group (``g``: one group for exact search, a cell for IVF, a
  band bucket for LSH).  Group sizes come from two small aggregates; a hot
  group is split into ``ceil(n / block)`` sub-blocks on both sides, so a
  cell holding a third of the corpus becomes many bounded tasks instead of
  one huge one.  ``cogroup(...).applyInArrow`` scores one (group, query
  block, corpus block) per call; vectors go from the Arrow batches into one matrix a side.

Scores are computed in double and ranked on ``round(score, 6)`` desc, then
the corpus id asc: a total order, so results are deterministic.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BROADCAST_MAX_BYTES = 8 << 20  # every Python worker holds a copy of it
BLOCK_ROWS = 1 << 16  # rows of a side that a block join holds at once, at most
SCORE_CELLS = 1 << 20  # scores a kernel call holds at once (8 MB)
SCORE_MARGIN = 1e-6  # scores rank on six digits
_SENTINEL = np.iinfo(np.int64).max


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------------------
# Column-level vector functions (higher-order functions, JVM side)
# ---------------------------------------------------------------------------

def dot(a, b) -> Column:
    """Inner product in double, HOF form (the readable cross-check of the matmul path)."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda s, z: s + z)


def l2_norm(v) -> Column:
    return F.sqrt(F.aggregate(_c(v), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def l2_normalize(v) -> Column:
    """Divide by the 2-norm; a zero vector stays zero."""
    from qaflow.functions.text import let

    return let(F.struct(_c(v).alias("v"), l2_norm(v).alias("n")), lambda b: F.transform(
        b["v"], lambda x: F.when(b["n"] > 0, x.cast("double") / b["n"]).otherwise(F.lit(0.0))))


def cast_vectors(df: DataFrame, col: str, dim: int | None = None, to: str = "float") -> DataFrame:
    """Cast a vector column to ``array<float>`` (storage) or ``array<double>``.

    With ``dim`` given, rows of another length fail the query (``assert_true``),
    as the reference's fixed-feature cast would.
    """
    out = df.withColumn(col, F.col(col).cast(f"array<{to}>"))
    if dim is not None:
        out = out.withColumn(col, F.when(F.assert_true(F.size(col) == dim).isNull(), F.col(col)))
    return out


# ---------------------------------------------------------------------------
# Top-k per query
# ---------------------------------------------------------------------------

def topk_per_query(df: DataFrame, k: int, part: str = "q_id", score: str = "score",
                   tiebreak: str = "c_id", rank_col: str = "rank") -> DataFrame:
    """K best rows per ``part`` by (round(score, 6) desc, tiebreak asc), ranked from 1."""
    w = Window.partitionBy(part).orderBy(F.round(score, 6).desc(), F.col(tiebreak).asc())
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


# ---------------------------------------------------------------------------
# numpy kernels used inside tasks
# ---------------------------------------------------------------------------

def _matrix(series: pd.Series, dim: int | None = None) -> np.ndarray:
    if len(series) == 0:
        return np.zeros((0, dim or 0))
    return np.stack([np.asarray(v, dtype=np.float64) for v in series.to_numpy()])


def arrow_ids(col: pa.ChunkedArray) -> np.ndarray:
    return col.to_numpy().astype(np.int64)


def arrow_matrix(col: pa.ChunkedArray, rows: np.ndarray) -> np.ndarray:
    """The vectors of ``rows`` (none of them null), in that order.

    They are put into the matrix batch by batch: beside the batches only the matrix is held, no object a row.
    """
    at = np.full(len(col), -1, dtype=np.int64)
    at[rows] = np.arange(len(rows))
    X, lo = np.zeros((len(rows), 0)), 0
    for chunk in col.chunks:
        to, lo = at[lo:lo + len(chunk)], lo + len(chunk)
        kept = to >= 0
        if not kept.any():
            continue
        chunk = chunk if kept.all() else chunk.filter(pa.array(kept))
        size = pc.min_max(pc.list_value_length(chunk)).as_py()
        if X.shape[1] == 0:
            X = np.empty((len(rows), size["min"]))
        if size["min"] != size["max"] or size["min"] != X.shape[1]:
            raise ValueError("vectors of different lengths")
        X[to[kept]] = chunk.flatten().to_numpy(zero_copy_only=False).reshape(len(chunk), X.shape[1])
    return X


def _block_topk(S: np.ndarray, ids: np.ndarray, k: int):
    """Exact top-k per row of S by (round(S,6) desc, id asc).

    ``ids`` must be sorted ascending (columns of S in id order).  Returns
    (rows, cols) of the kept cells; at most k per row.
    """
    nq, nc = S.shape
    if nc == 0 or nq == 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    R = np.round(S, 6)
    if nc <= k:
        r, c = np.nonzero(np.ones_like(R, dtype=bool))
        return r, c
    kth = np.partition(R, nc - k, axis=1)[:, nc - k]
    gt = R > kth[:, None]
    n_gt = gt.sum(axis=1)
    eq = R == kth[:, None]
    keep_eq = eq & (np.cumsum(eq, axis=1) <= (k - n_gt)[:, None])
    return np.nonzero(gt | keep_eq)


def _merge_state(best_s, best_id, new_s, new_id, k, dedupe=False):
    """Merge candidate lists row-wise, keeping the k best by (score desc, id asc)."""
    s = np.concatenate([best_s, new_s], axis=1)
    i = np.concatenate([best_id, new_id], axis=1)
    order = np.lexsort((i, -np.round(s, 6)), axis=1)
    s = np.take_along_axis(s, order, axis=1)
    i = np.take_along_axis(i, order, axis=1)
    if dedupe:
        dup = np.zeros_like(i, dtype=bool)
        dup[:, 1:] = (i[:, 1:] == i[:, :-1]) & (i[:, 1:] != _SENTINEL)
        if dup.any():
            s = np.where(dup, -np.inf, s)
            i = np.where(dup, _SENTINEL, i)
            order = np.lexsort((i, -np.round(s, 6)), axis=1)
            s = np.take_along_axis(s, order, axis=1)
            i = np.take_along_axis(i, order, axis=1)
    return s[:, :k], i[:, :k]


def _score_into_state(Q, X, cids, state_rows, best_s, best_id, k, dedupe):
    """Score X (sorted by id) against the queries ``state_rows``; update the state.

    At most ``SCORE_CELLS`` scores are held at once.  Once a query has k rows, only scores that
    reach its k-th best (to six digits) are looked at again.
    """
    c_step = max(1, min(X.shape[0], 4096))
    q_step = max(1, SCORE_CELLS // c_step)
    for start in range(0, len(state_rows), q_step):
        rows = state_rows[start:start + q_step]
        Qr = Q[rows]
        for lo in range(0, X.shape[0], c_step):
            S, ids = Qr @ X[lo:lo + c_step].T, cids[lo:lo + c_step]
            tau = best_s[rows, k - 1]
            if np.isneginf(tau).any():
                r, c = _block_topk(S, ids, k)
            else:
                r, c = np.nonzero(S >= (np.round(tau, 6) - SCORE_MARGIN)[:, None])
            if not len(r):
                continue
            hit, at = np.unique(r, return_inverse=True)
            # cells come row-major and in id order; position within the row
            pos = np.arange(len(r)) - np.searchsorted(r, r, side="left")
            new_s = np.full((len(hit), pos.max() + 1), -np.inf)
            new_i = np.full(new_s.shape, _SENTINEL, dtype=np.int64)
            new_s[at, pos], new_i[at, pos] = S[r, c], ids[c]
            to = rows[hit]
            best_s[to], best_id[to] = _merge_state(best_s[to], best_id[to], new_s, new_i, k, dedupe)


_OUT_SCHEMA = "q_id long, c_id long, score double"


def _hits(qids, best_s, best_id) -> dict[str, np.ndarray]:
    keep = np.isfinite(best_s) & (best_id != _SENTINEL)
    return {"q_id": np.repeat(qids, keep.sum(axis=1)), "c_id": best_id[keep], "score": best_s[keep]}


def _emit(qids, best_s, best_id) -> pd.DataFrame:
    return pd.DataFrame(_hits(qids, best_s, best_id))


# ---------------------------------------------------------------------------
# The grouped top-k join
# ---------------------------------------------------------------------------

def grouped_topk(queries: DataFrame, corpus: DataFrame, k: int, *,
                 broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
                 broadcast_max_rows: int = 200_000,
                 query_block: int = BLOCK_ROWS, corpus_block: int = BLOCK_ROWS,
                 dedupe: bool = False, force_blocks: bool = False, one_group: bool = False) -> DataFrame:
    """Top-k corpus rows per query among rows sharing a group.

    ``queries``: ``q_id long, q_vec array<double|float>, g long`` (one row per
    (query, group) the query probes).  ``corpus``: ``c_id long, c_vec array,
    g long`` (one row per (row, group)).  Returns ``q_id, rank, c_id, score``.

    The broadcast path runs if all query rows fit ``broadcast_max_rows`` and
    ``broadcast_max_bytes`` (checked before they are fetched); otherwise the
    block path runs.
    """
    spark = queries.sparkSession
    # a null vector cannot be scored: such rows take no part (a zero vector does).
    # They are dropped inside the kernels, not by a DataFrame filter, which the
    # optimizer would push below the projection and so evaluate an encoder UDF twice.
    q = queries.select(F.col("q_id").cast("long"), F.col("q_vec").cast("array<double>"),
                       F.col("g").cast("long"))
    c = corpus.select(F.col("c_id").cast("long"), F.col("c_vec").cast("array<double>"),
                      F.col("g").cast("long"))

    block = None if force_blocks else bounded_fetch(q, "q_vec", broadcast_max_rows, broadcast_max_bytes)

    if block is not None:
        cand = _broadcast_topk(spark, block, c, k, dedupe)
    elif one_group:
        from qaflow.operators import bounds

        return bounds.bounded_topk(q, c, k, q_id="q_id", q_vec="q_vec", c_id="c_id", c_vec="c_vec", block_rows=min(corpus_block, bounds.BLOCK_ROWS),
                                   query_block=query_block, corpus_block=corpus_block)
    else:
        cand = _block_topk_join(q, c, k, query_block, corpus_block, dedupe)
    if dedupe:
        cand = cand.groupBy("q_id", "c_id").agg(F.max("score").alias("score"))
    out = topk_per_query(cand, k).select("q_id", "rank", "c_id", "score")
    # a proven upper bound on the result rows (distinct queries x k) when known
    out._qaflow_max_rows = (block["q_id"].nunique() * k) if block is not None else None
    return out


def bounded_fetch(df: DataFrame, vec: str, max_rows: int, max_bytes: int) -> pd.DataFrame | None:
    """All rows of ``df`` that have a vector, if they fit ``max_rows`` and ``max_bytes``; else None.

    The length of one vector turns the byte bound into a row bound before anything is
    fetched, so at most that many rows (and one) ever reach the driver.
    """
    one = df.select(F.size(vec).alias("d")).where("d > 0").limit(1).collect()
    dim = one[0]["d"] if one else 1
    most = min(max_rows, max_bytes // (8 * dim))
    head = df.limit(most + 1).toPandas()
    if len(head) > most:
        return None
    head = head[head[vec].notna()].reset_index(drop=True)
    longest = max((len(v) for v in head[vec]), default=0)
    return head if len(head) * max(longest, 1) * 8 <= max_bytes else None


def _broadcast_topk(spark, pdf: pd.DataFrame, c: DataFrame, k: int, dedupe: bool) -> DataFrame:
    uq = pdf.drop_duplicates("q_id").reset_index(drop=True)
    qids = uq["q_id"].to_numpy(dtype=np.int64)
    Q = _matrix(uq["q_vec"])
    pos = pd.Series(np.arange(len(qids)), index=qids)
    gmap = {int(g): np.sort(pos.loc[grp["q_id"].to_numpy()].to_numpy())
            for g, grp in pdf.groupby("g")}
    bc = spark.sparkContext.broadcast((qids, Q, gmap))

    def score_partition(batches):
        qids_, Q_, gmap_ = bc.value
        nq = len(qids_)
        best_s = np.full((nq, k), -np.inf)
        best_id = np.full((nq, k), _SENTINEL, dtype=np.int64)
        touched = False
        for b in batches:
            if len(b) == 0:
                continue
            b = b[b["c_vec"].notna()]
            for g, grp in b.groupby("g", sort=False):
                rows = gmap_.get(int(g))
                if rows is None or len(rows) == 0:
                    continue
                grp = grp.sort_values("c_id", kind="stable")
                X = _matrix(grp["c_vec"], Q_.shape[1])
                _score_into_state(Q_, X, grp["c_id"].to_numpy(dtype=np.int64), rows,
                                  best_s, best_id, k, dedupe)
                touched = True
        if touched:
            yield _emit(qids_, best_s, best_id)

    return c.mapInPandas(score_partition, _OUT_SCHEMA)


def block_plan(q: DataFrame, c: DataFrame, query_block: int, corpus_block: int) -> DataFrame:
    """Sub-block counts per group: ``g, qs, cs`` (one row per group with both sides).

    A group with ``nc`` corpus rows is cut into ``cs = ceil(nc / corpus_block)``
    sub-blocks and its ``nq`` queries into ``qs = ceil(nq / query_block)``; a
    hot group (say a third of the corpus) becomes ``qs x cs`` bounded tasks.
    """
    nq = q.groupBy("g").agg(F.count("*").alias("nq"))
    nc = c.groupBy("g").agg(F.count("*").alias("nc"))
    return nq.join(nc, "g").select(
        "g", F.ceil(F.col("nq") / query_block).cast("int").alias("qs"),
        F.ceil(F.col("nc") / corpus_block).cast("int").alias("cs"))


def _block_topk_join(q: DataFrame, c: DataFrame, k: int, query_block: int,
                     corpus_block: int, dedupe: bool) -> DataFrame:
    # large tables fill the blocks; smaller ones are cut finer, some blocks for every core
    query_block = min(query_block, max(BLOCK_ROWS // 4, q.count() // (4 * q.sparkSession.sparkContext.defaultParallelism)))
    # one row per group: bounded by the number of groups, not by the data
    sizes = block_plan(q, c, query_block, corpus_block)
    qx = (q.join(sizes, "g")
          .withColumn("qsub", F.pmod(F.xxhash64("q_id"), F.col("qs")).cast("int"))
          .withColumn("csub", F.explode(F.sequence(F.lit(0), F.col("cs") - 1)))
          .drop("qs", "cs"))
    cx = (c.join(sizes, "g")
          .withColumn("csub", F.pmod(F.xxhash64("c_id"), F.col("cs")).cast("int"))
          .withColumn("qsub", F.explode(F.sequence(F.lit(0), F.col("qs") - 1)))
          .drop("qs", "cs"))

    def score_block(ct: pa.Table, qt: pa.Table) -> pa.Table:
        cids, qids = arrow_ids(ct["c_id"]), arrow_ids(qt["q_id"])
        cat = np.flatnonzero(ct["c_vec"].is_valid().to_numpy())
        cat = cat[np.argsort(cids[cat], kind="stable")]
        qat = np.flatnonzero(qt["q_vec"].is_valid().to_numpy())
        qat = qat[np.unique(qids[qat], return_index=True)[1]]
        cids, qids = cids[cat], qids[qat]
        best_s = np.full((len(qids), k), -np.inf)
        best_id = np.full((len(qids), k), _SENTINEL, dtype=np.int64)
        if len(cids) and len(qids):
            _score_into_state(arrow_matrix(qt["q_vec"], qat), arrow_matrix(ct["c_vec"], cat), cids, np.arange(len(qids)),
                              best_s, best_id, k, dedupe)
        return pa.table(_hits(qids, best_s, best_id))

    keys = ["g", "qsub", "csub"]
    # the number is given, so that no blocks are put into one task for having few bytes: their work is the product
    n = int(q.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (cx.select(*keys, "c_id", "c_vec").repartition(n, *keys).groupBy(*keys)
            .cogroup(qx.select(*keys, "q_id", "q_vec").repartition(n, *keys).groupBy(*keys))
            .applyInArrow(score_block, _OUT_SCHEMA))


# ---------------------------------------------------------------------------
# Exact top-k
# ---------------------------------------------------------------------------

def exact_topk(queries: DataFrame, corpus: DataFrame, k: int, *, q_id: str, q_vec: str,
               c_id: str, c_vec: str, **kw) -> DataFrame:
    """Exact maximum inner product; returns ``q_id, rank, c_id, score``.

    Queries that fit the broadcast bound meet the corpus in one scan.  For more queries than that,
    :func:`qaflow.operators.bounds.bounded_topk` gives the same rows and skips the blocks of the
    corpus whose upper bound is below a query's k-th best score.
    """
    q = queries.select(F.col(q_id).alias("q_id"), F.col(q_vec).alias("q_vec"), F.lit(0).alias("g"))
    c = corpus.select(F.col(c_id).alias("c_id"), F.col(c_vec).alias("c_vec"), F.lit(0).alias("g"))
    return grouped_topk(q, c, k, one_group=True, **kw)


# ---------------------------------------------------------------------------
# Cell index
# ---------------------------------------------------------------------------

def label_mean_centroids(df: DataFrame, label: str, vec: str) -> DataFrame:
    """Centroid per label = mean vector, as ``cell int, centroid array<double>``.

    Long form (label, position) aggregate: partial aggregation map-side keeps
    the shuffle at (labels x dim) rows whatever the data size.
    """
    long = df.select(F.col(label).alias("cell"), F.posexplode(vec).alias("pos", "x"))
    agg = long.groupBy("cell", "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return (agg.groupBy("cell")
            .agg(F.sort_array(F.collect_list(F.struct("pos", "m"))).alias("s"))
            .select(F.col("cell").cast("int"), F.col("s.m").alias("centroid")))


UNIT = 1 << 25  # whole steps of a unit vector's coordinates: products and their sums stay exact in a double


def train_centroids(df: DataFrame, vec: str, nlist: int, *, seed: int = 42, max_iter: int = 20) -> DataFrame:
    """E5: coarse quantiser -- spherical k-means over every vector with a direction.

    The result depends on the vectors alone, not on their order or partitions: the
    start is the ``nlist`` different vectors with the least seeded hash, and scores
    and sums are of coordinates rounded to ``1 / UNIT``, whole numbers that add up
    exactly in any order.  A cell that loses its vectors keeps its centroid.
    Returns unit-norm centroids ``cell int, centroid array<double>``, fewer than
    ``nlist`` if there are fewer different vectors; the centroid matrix and its sums
    (nlist x dim) are the only things that reach the driver.
    """
    spark = df.sparkSession
    # zero vectors have no direction: they cannot train a cosine quantiser
    # (they are still assigned, to the lowest cell, by assign_cells)
    norm = l2_norm(vec)
    data = df.where((norm > 0) & (norm < float("inf"))).select(l2_normalize(vec).alias("v")).persist(StorageLevel.MEMORY_AND_DISK)
    start = data.distinct().orderBy(F.xxhash64(F.lit(seed), "v"), "v").limit(nlist).collect()
    C = np.array([r["v"] for r in start], dtype=np.float64)

    def sums(batches):
        C_ = bc.value
        total = np.zeros(C_.shape, dtype=np.int64)
        step = max(1, SCORE_CELLS // len(C_))
        for b in batches:
            for lo in range(0, b.num_rows, step):
                v = b.column(0).slice(lo, step)
                X = np.rint(arrow_matrix(pa.chunked_array([v]), np.arange(len(v))) * UNIT)
                cell = (X @ C_.T).argmax(axis=1)
                order = np.argsort(cell, kind="stable")
                found, at = np.unique(cell[order], return_index=True)
                total[found] += np.add.reduceat(X[order], at, axis=0).astype(np.int64)
        cell, pos = np.nonzero(total)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(cell, pa.int32()), "pos": pa.array(pos, pa.int32()), "s": total[cell, pos]})

    for _ in range(max_iter if len(C) else 0):
        bc = spark.sparkContext.broadcast(np.rint(C * UNIT))
        got = data.mapInArrow(sums, "cell int, pos int, s long").groupBy("cell", "pos").agg(F.sum("s").alias("s")).toPandas()
        bc.unpersist()
        S = np.zeros(C.shape)
        S[got["cell"].to_numpy(), got["pos"].to_numpy()] = got["s"].to_numpy()
        n = np.linalg.norm(S, axis=1, keepdims=True)
        new = np.where(n > 0, np.divide(S, n, out=np.zeros_like(S), where=n > 0), C)
        if np.array_equal(new, C):
            break
        C = new
    data.unpersist()
    return spark.createDataFrame([(i, c) for i, c in enumerate(C.tolist())], "cell int, centroid array<double>")


CENTROID_BROADCAST_MAX_BYTES = 256 << 20


CENTROID_MAX_ROWS = 1 << 20


def _centroid_block(centroids: DataFrame, max_bytes: int):
    """The centroid matrix if it fits ``max_bytes``, else None.

    One bounded fetch: rows and bytes are checked before they reach the driver.
    """
    pdf = bounded_fetch(centroids.select("cell", "centroid"), "centroid", CENTROID_MAX_ROWS, max_bytes)
    if pdf is None:
        return None
    pdf = pdf.sort_values("cell")
    return pdf["cell"].to_numpy(dtype=np.int64), _matrix(pdf["centroid"])


def nearest_cells(df: DataFrame, centroids: DataFrame, vec: str, n: int = 1, *,
                  normalize: bool = True, out: str = "cell", as_list: bool | None = None,
                  max_bytes: int = CENTROID_BROADCAST_MAX_BYTES, key: str | None = None) -> DataFrame:
    """The ``n`` best cells per row by (round(dot,6) desc, cell asc).

    ``n = 1`` is E6 (``out`` is an int column); ``n > 1`` gives the probe list
    of E7 (``out`` is an ``array<int>`` ordered best first).  A centroid
    matrix within ``max_bytes`` is broadcast and rows are scored in
    ``mapInArrow``; a larger one (e.g. 32768 cells x 768 dims) is joined in
    blocks instead (:func:`grouped_topk`), which needs a unique ``key``.
    """
    spark = df.sparkSession
    as_list = (n > 1) if as_list is None else as_list
    block = _centroid_block(centroids, max_bytes)
    if block is None:
        if key is None:
            raise ValueError("centroids exceed the broadcast bound: pass key= for the block join")
        return _nearest_cells_blocked(df, centroids, vec, n, normalize, out, as_list, key)
    cells, C = block
    bc = spark.sparkContext.broadcast((cells, C))
    out_type = T.ArrayType(T.IntegerType()) if as_list else T.IntegerType()
    schema = T.StructType(df.schema.fields + [T.StructField(out, out_type)])

    def assign(batches):
        cells_, C_ = bc.value
        step = max(1, SCORE_CELLS // len(cells_)) if len(cells_) else 1
        for b in batches:
            v = b.column(b.schema.get_field_index(vec))
            has = v.is_valid().to_numpy(zero_copy_only=False) if len(cells_) else np.zeros(b.num_rows, dtype=bool)  # a null vector has no cell
            scored, found = np.flatnonzero(has), [np.zeros((0, 1), dtype=np.int64)]
            for lo in range(0, len(scored), step):
                rows = scored[lo:lo + step]
                X = arrow_matrix(pa.chunked_array([v]), rows)
                if normalize:
                    nr = np.linalg.norm(X, axis=1, keepdims=True)
                    X = np.divide(X, nr, out=np.zeros_like(X), where=nr > 0)
                S = X @ C_.T
                if not as_list:  # cells ascend, so the first of equal scores is the lowest cell
                    found.append(cells_[np.round(S, 6).argmax(axis=1)][:, None])
                    continue
                r, c = _block_topk(S, cells_, n)
                c = c.reshape(len(rows), -1)
                best = np.round(S[np.arange(len(rows))[:, None], c], 6)
                found.append(cells_[np.take_along_axis(c, np.argsort(-best, axis=1, kind="stable"), axis=1)])
            flat = pa.array(np.concatenate([f.ravel() for f in found])).cast(pa.int32())
            at = np.append(0, np.cumsum(has * found[-1].shape[1]))
            if as_list:
                col = pa.ListArray.from_arrays(pa.array(at, pa.int32()), flat, mask=pa.array(~has))
            else:
                col = flat.take(pa.array(at[:-1], mask=~has))
            yield pa.RecordBatch.from_arrays([*b.columns, col], names=[*b.schema.names, out])

    return df.mapInArrow(assign, schema)


def _nearest_cells_blocked(df, centroids, vec, n, normalize, out, as_list, key):
    v = l2_normalize(vec) if normalize else F.col(vec)
    q = df.select(F.col(key).alias("q_id"), v.alias("q_vec"), F.lit(0).alias("g"))
    c = centroids.select(F.col("cell").cast("long").alias("c_id"), F.col("centroid").alias("c_vec"),
                         F.lit(0).alias("g"))
    top = grouped_topk(q, c, n, force_blocks=True)
    best = top.groupBy("q_id").agg(F.sort_array(F.collect_list(F.struct("rank", "c_id"))).alias("_s"))
    cells = F.transform("_s", lambda x: x["c_id"].cast("int"))
    picked = best.select(F.col("q_id").alias(key), (cells if as_list else F.element_at(cells, 1)).alias(out))
    return df.join(picked, key)


def assign_cells(df: DataFrame, centroids: DataFrame, vec: str, **kw) -> DataFrame:
    """Each vector to its best cell (cosine; the vector is unit-normalised first)."""
    return nearest_cells(df, centroids, vec, 1, **kw)


def ivf_topk(queries: DataFrame, postings: DataFrame, centroids: DataFrame, k: int, nprobe: int, *,
             q_id: str, q_vec: str, c_id: str, c_vec: str, cell: str = "cell",
             max_pruning_cells: int = 100_000, **kw) -> DataFrame:
    """Score only the postings in each query's ``nprobe`` best cells.

    Queries are probed against the centroids and exploded to (query, cell).
    The set of probed cells is at most ``nlist`` values: it is collected
    (bounded) and pushed into the postings scan as ``cell IN (...)``, so with
    postings written ``partitionBy(cell)`` only the probed directories are
    read (static partition pruning).  Beyond ``max_pruning_cells`` a semi
    join on the cell does the same at run time.
    """
    probes = nearest_cells(queries.select(q_id, q_vec), centroids, q_vec, nprobe, normalize=False,
                           out="probe", as_list=True, key=q_id)
    qx = probes.select(F.col(q_id).alias("q_id"), F.col(q_vec).alias("q_vec"),
                       F.explode("probe").alias("g"))
    probed = [r[0] for r in qx.select("g").distinct().limit(max_pruning_cells + 1).collect()]
    cx = postings.select(F.col(c_id).alias("c_id"), F.col(c_vec).alias("c_vec"), F.col(cell).alias("g"))
    if len(probed) <= max_pruning_cells:
        cx = cx.where(F.col("g").isin(probed))
    else:
        cx = cx.join(qx.select("g").distinct(), "g", "left_semi")
    return grouped_topk(qx, cx, k, **kw)


# ---------------------------------------------------------------------------
# Sign-random-projection bands (approximate top-k)
# ---------------------------------------------------------------------------

def hyperplanes(dim: int, tables: int, bits: int) -> np.ndarray:
    """Deterministic hyperplanes from md5, shape (tables*bits, dim).

    Coordinate j of plane p is ``int(md5('p|j')[:8], 16) / 2**31 - 1``, so any
    engine that has md5 can rebuild them.
    """
    import hashlib

    planes = np.empty((tables * bits, dim))
    for p in range(tables * bits):
        for j in range(dim):
            h = hashlib.md5(f"{p}|{j}".encode()).hexdigest()
            planes[p, j] = int(h[:8], 16) / 2.0 ** 31 - 1.0
    return planes


def band_keys(df: DataFrame, vec: str, planes: np.ndarray, tables: int, bits: int,
              out: str = "bands") -> DataFrame:
    """Band bucket ids ``t * 2**bits + signature_t`` per row, as ``array<long>``."""
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast(planes)
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.ArrayType(T.LongType()))])
    weights = (1 << np.arange(bits)).astype(np.int64)

    def sign_bits(batches):
        P = bc.value
        for b in batches:
            b = b[b[vec].notna()].copy()  # a null vector is in no bucket
            X = _matrix(b[vec], P.shape[1])
            sig = (X @ P.T >= 0).reshape(len(X), tables, bits).astype(np.int64) if len(X) else \
                np.zeros((0, tables, bits), dtype=np.int64)
            keys = sig @ weights + (np.arange(tables, dtype=np.int64) << bits)[None, :]
            b[out] = pd.Series([row.tolist() for row in keys], index=b.index, dtype=object)
            yield b

    return df.mapInPandas(sign_bits, schema)


def lsh_topk(queries: DataFrame, corpus: DataFrame, k: int, *, q_id: str, q_vec: str,
             c_id: str, c_vec: str, tables: int = 8, bits: int = 4, **kw) -> DataFrame:
    """E8 (re-aim of the graph index): approximate top-k over band buckets.

    A corpus row is a candidate for a query when they share a bucket in
    any table; candidates are scored exactly, so every returned score equals
    the exact one and only recall can be lower.
    """
    dim = queries.agg(F.max(F.size(q_vec))).first()[0] or 0
    planes = hyperplanes(dim, tables, bits)
    qb = band_keys(queries.select(q_id, q_vec), q_vec, planes, tables, bits)
    cb = band_keys(corpus.select(c_id, c_vec), c_vec, planes, tables, bits)
    qx = qb.select(F.col(q_id).alias("q_id"), F.col(q_vec).alias("q_vec"), F.explode("bands").alias("g"))
    cx = cb.select(F.col(c_id).alias("c_id"), F.col(c_vec).alias("c_vec"), F.explode("bands").alias("g"))
    return grouped_topk(qx, cx, k, dedupe=True, **kw)


# ---------------------------------------------------------------------------
# Recall of an approximate result against the exact one
# ---------------------------------------------------------------------------

def ann_recall(approx: DataFrame, exact: DataFrame, k: int) -> DataFrame:
    """Mean over queries of |approx top-k ∩ exact top-k| / k."""
    a = approx.where(F.col("rank") <= k).select("q_id", "c_id", F.lit(1).alias("hit"))
    e = exact.where(F.col("rank") <= k).select("q_id", "c_id")
    hits = (e.join(a, ["q_id", "c_id"], "left").groupBy("q_id")
            .agg(F.sum(F.coalesce("hit", F.lit(0))).alias("h")))
    return hits.agg((F.sum("h") / (F.count("*") * F.lit(k))).alias("recall"),
                    F.count("*").alias("n_queries"))
