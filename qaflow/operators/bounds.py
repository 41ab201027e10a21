"""Exact top-k with upper bounds over blocks of the corpus (E9 / J4 for large query sets).

The corpus is sorted by norm (inside a cell, if cells are given) and cut into blocks.  Of every block
only a summary is kept apart: its rows, its largest norm, its centre and the radius around it.  No
vector of a block can score more against a query ``q`` than

    min(|q| * largest norm,  q . centre + |q| * radius)

A block whose bound is below the k-th best score that a query has so far can hold no better row and is
not scored for it, so the result is exact.

Data movement: the corpus is sorted and written once, its blocks dealt to slices of at most
``BLOCK_ROWS`` rows and the queries to parts of as many.  Every part of the queries meets every slice in one
task, which holds both, keeps a running top-k a query and scores a query against a block only if
the block's bound reaches that query's k-th best.  So vectors are shipped once a part or slice of the other
side (rows of a side x rows of the other / ``BLOCK_ROWS``), never once a pair, and a task's memory does not
grow with the tables.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaflow.operators import vectors
from qaflow.session import scratch_path

BLOCK_ROWS = 4096
SUMMARY_BYTES = 64 << 20
MARGIN = 1e-6  # scores rank on six digits, so a block that may tie with the k-th best is still read

_BLOCKS = "c_id long, c_vec array<double>, block long, rows long, max_norm double, centre array<double>, radius double"


def _written(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def norm_blocks(corpus: DataFrame, *, block_rows: int = BLOCK_ROWS, summary_bytes: int = SUMMARY_BYTES,
                num_partitions: int | None = None) -> DataFrame:
    """``corpus(c_id, c_vec[, cell])`` as blocks of falling norm, written to the shared folder.

    Columns ``c_id, c_vec, block`` and, on the first row of each block, its summary ``rows, max_norm,
    centre, radius``.  Rows without a vector are in no block.  Vectors with a non-finite component get
    an infinite norm, so their block is always visited.
    """
    spark = corpus.sparkSession
    has_cell = "cell" in corpus.columns
    rows = corpus.select(F.col("c_id").cast("long"), F.col("c_vec").cast("array<double>"),
                         F.coalesce(F.col("cell").cast("long"), F.lit(-1)).alias("cell") if has_cell else F.lit(0).cast("long").alias("cell"))

    def with_norm(batches):
        for b in batches:
            b = b[b["c_vec"].notna()]
            norm = np.array([np.linalg.norm(np.asarray(v, dtype=np.float64)) for v in b["c_vec"]], dtype=np.float64)
            yield b.assign(norm=np.where(np.isfinite(norm), norm, np.inf))

    rows = _written(rows.mapInPandas(with_norm, "c_id long, c_vec array<double>, cell long, norm double"), "bound-rows")
    n, dim = rows.agg(F.count("*"), F.max(F.size("c_vec"))).first()
    block_rows = max(block_rows, -(-n * ((dim or 1) + 4) * 8 // summary_bytes))
    order = ["cell", F.col("norm").desc(), "c_id"]
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(parts, -(-n // block_rows)))

    def block(number: int, rows: list[pd.DataFrame]) -> pd.DataFrame:
        b = pd.concat(rows, ignore_index=True)
        X = vectors._matrix(b["c_vec"])
        centre = X.mean(axis=0)
        radius = np.linalg.norm(X - centre, axis=1).max()
        empty = [None] * (len(b) - 1)
        return pd.DataFrame({
            "c_id": b["c_id"], "c_vec": b["c_vec"], "block": number,
            "rows": pd.array([len(b), *empty], dtype="Int64"), "max_norm": pd.array([b["norm"].max(), *empty], dtype="Float64"),
            "centre": pd.Series([centre.tolist(), *empty], dtype=object), "radius": pd.array([radius, *empty], dtype="Float64")})

    def cut(batches):
        number, held, size, cell = TaskContext.get().partitionId() << 33, [], 0, None
        for b in batches:
            while len(b):
                if size and b["cell"].iloc[0] != cell:
                    yield block(number, held)
                    number, held, size = number + 1, [], 0
                cell = b["cell"].iloc[0]
                take = min(block_rows - size, int((b["cell"] == cell).sum()))  # sorted by cell: a prefix
                held.append(b.iloc[:take])
                size, b = size + take, b.iloc[take:]
                if size == block_rows:
                    yield block(number, held)
                    number, held, size = number + 1, [], 0
        if size:
            yield block(number, held)

    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return _written(ranged.mapInPandas(cut, _BLOCKS), "bound-blocks")


def upper_bounds(Q: np.ndarray, max_norm: np.ndarray, centre: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """What no vector of a block can exceed, for every query and block."""
    size = np.linalg.norm(Q, axis=1)[:, None]
    with np.errstate(invalid="ignore", over="ignore"):
        near, far = Q @ centre.T + size * radius, size * max_norm
    bound = np.minimum(np.where(np.isnan(near), np.inf, near), np.where(np.isnan(far), np.inf, far))
    return bound + 1e-9 * np.abs(np.where(np.isfinite(bound), bound, 0.0))


def _score_slice(Q: np.ndarray, X: np.ndarray, cids: np.ndarray, starts: np.ndarray, summary, k: int):
    """The ``k`` best rows of a slice of whole blocks for every query: ``(scores, ids, pairs scored)``.

    Every query first meets the blocks of its highest bounds until it has ``k`` rows; then all blocks
    come in falling order of their mean bound, some at a time, and meet only the queries they may still help.
    """
    best_s, best_id = np.full((len(Q), k), -np.inf), np.full((len(Q), k), vectors._SENTINEL, dtype=np.int64)
    ends, n_blocks, scored = np.append(starts[1:], len(X)), len(starts), 0
    size = ends - starts
    together = -(-n_blocks // 64)
    step = max(1, min(vectors.SCORE_CELLS // n_blocks, 8192))
    for lo in range(0, len(Q), step):
        Qc, s, i = Q[lo:lo + step], best_s[lo:lo + step], best_id[lo:lo + step]
        bound = upper_bounds(Qc, *summary)
        first = np.zeros(bound.shape, dtype=bool)
        most = min(n_blocks, int((np.cumsum(np.sort(size)) < k).sum()) + 1)
        order = np.argsort(-bound, axis=1, kind="stable")[:, :most]
        enough = np.cumsum(size[order], axis=1) - size[order] < k
        np.put_along_axis(first, order, enough, axis=1)

        def score(blocks, q):
            at = np.concatenate([np.arange(starts[b], ends[b]) for b in blocks])
            at = at[np.argsort(cids[at], kind="stable")]
            vectors._score_into_state(Qc, X[at], cids[at], q, s, i, k, False)
            return len(q) * len(at)

        for b in np.flatnonzero(first.any(axis=0)):
            scored += score([b], np.flatnonzero(first[:, b]))
        falling = np.argsort(-np.where(np.isfinite(bound), bound, np.finfo(np.float64).max / len(Qc)).mean(axis=0), kind="stable")
        for at in range(0, n_blocks, together):
            blocks = falling[at:at + together]
            reach = (bound[:, blocks] + MARGIN >= np.round(s[:, -1:], 6)) & ~first[:, blocks]
            # queries that met some of these blocks before meet the others one by one
            before = first[:, blocks].any(axis=1)
            q = np.flatnonzero(reach.any(axis=1) & ~before)
            if len(q):
                scored += score(blocks, q)
            for j, b in enumerate(blocks):
                q = np.flatnonzero(reach[:, j] & before)
                if len(q):
                    scored += score([b], q)
    return best_s, best_id, scored


def _pieces(n_q: int, n_c: int, query_block: int, corpus_block: int, parallelism: int) -> tuple[int, int]:
    """Into how many parts to cut the queries and the corpus: parts within the blocks, and some for every core."""
    qs, cs = max(1, -(-n_q // query_block)), max(1, -(-n_c // corpus_block))
    while qs * cs < 2 * parallelism and max(n_q // qs, n_c // cs) > 4096:
        if n_q // qs >= n_c // cs:
            qs += 1
        else:
            cs += 1
    return qs, cs


def bounded_candidates(queries: DataFrame, blocks: DataFrame, k: int, *, query_block: int = vectors.BLOCK_ROWS,
                       corpus_block: int = vectors.BLOCK_ROWS) -> tuple[DataFrame, int]:
    """``(q_id, c_id, score candidates, pairs scored)``: for every query at least its k best rows of ``blocks``."""
    spark = queries.sparkSession
    ids = _written(queries.select(F.col("q_id").cast("long"), F.col("q_vec").cast("array<double>")).dropDuplicates(["q_id"]), "bound-queries")
    qs, cs = _pieces(ids.count(), blocks.count(), query_block, corpus_block, spark.sparkContext.defaultParallelism)
    q = ids.withColumn("qsub", F.pmod(F.xxhash64("q_id"), F.lit(qs)).cast("int")) \
        .withColumn("csub", F.explode(F.sequence(F.lit(0), F.lit(cs - 1))))
    c = blocks.withColumn("csub", F.pmod(F.xxhash64("block"), F.lit(cs)).cast("int")) \
        .withColumn("qsub", F.explode(F.sequence(F.lit(0), F.lit(qs - 1))))

    def score(ct: pa.Table, qt: pa.Table) -> pa.Table:
        qids, qat = vectors.arrow_ids(qt["q_id"]), np.flatnonzero(qt["q_vec"].is_valid().to_numpy())
        if not ct.num_rows or not len(qat):
            return pa.table({"q_id": [], "c_id": [], "score": [], "pairs": []}, schema=found_schema)
        block, cids = vectors.arrow_ids(ct["block"]), vectors.arrow_ids(ct["c_id"])
        order = np.lexsort((cids, block))
        starts = np.unique(block[order], return_index=True)[1]
        first = order[ct["rows"].is_valid().to_numpy()[order]]  # one row a block, in order of blocks
        summary = (ct["max_norm"].take(pa.array(first)).to_numpy(), vectors.arrow_matrix(ct["centre"], first),
                   ct["radius"].take(pa.array(first)).to_numpy())
        qids = qids[qat]
        best_s, best_id, scored = _score_slice(vectors.arrow_matrix(qt["q_vec"], qat), vectors.arrow_matrix(ct["c_vec"], order),
                                               cids[order], starts, summary, k)
        found = pa.table(vectors._hits(qids, best_s, best_id))
        found = found.append_column("pairs", pa.nulls(found.num_rows, pa.int64()))
        count = pa.table({"q_id": [None], "c_id": [None], "score": [None], "pairs": [scored]}, schema=found_schema)  # one row a task
        return pa.concat_tables([found.cast(found_schema), count])

    found_schema = pa.schema([("q_id", pa.int64()), ("c_id", pa.int64()), ("score", pa.float64()), ("pairs", pa.int64())])
    keys = ["qsub", "csub"]
    n = qs * cs  # given, so that no two of these heavy pieces are put together for being small
    found = (c.select(*keys, "c_id", "c_vec", "block", "rows", "max_norm", "centre", "radius").repartition(n, *keys).groupBy(*keys)
             .cogroup(q.select(*keys, "q_id", "q_vec").repartition(n, *keys).groupBy(*keys))
             .applyInArrow(score, "q_id long, c_id long, score double, pairs long"))
    found = _written(found, "bound-found")
    scored = found.agg(F.sum("pairs")).first()[0] or 0
    return found.where("pairs is null").select("q_id", "c_id", "score"), scored


def bounded_topk(queries: DataFrame, corpus: DataFrame, k: int, *, q_id: str, q_vec: str, c_id: str, c_vec: str,
                 cell: str | None = None, block_rows: int = BLOCK_ROWS, summary_bytes: int = SUMMARY_BYTES, **kw) -> DataFrame:
    """E9 with bounds: ``q_id, rank, c_id, score`` as :func:`qaflow.operators.vectors.exact_topk`.

    ``cell`` names a column of ``corpus`` that groups near vectors (an index cell): blocks then hold rows of one
    cell, which makes their radius, and so the bound, small.  The scored pairs are left in ``_qaflow_scored``.
    """
    c = corpus.select(F.col(c_id).alias("c_id"), F.col(c_vec).alias("c_vec"), *([F.col(cell).alias("cell")] if cell else []))
    blocks = norm_blocks(c, block_rows=block_rows, summary_bytes=summary_bytes)
    q = queries.select(F.col(q_id).alias("q_id"), F.col(q_vec).alias("q_vec"))
    best, scored = bounded_candidates(q, blocks, k, **kw)
    out = vectors.topk_per_query(best, k).select("q_id", "rank", "c_id", "score")
    out._qaflow_scored = scored
    return out
