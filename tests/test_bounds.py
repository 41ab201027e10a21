"""Exact top-k with block bounds: equal to the plain scan, with fewer pairs where norms or cells differ."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from qaflow.operators import bounds, vectors
from qaflow.plans import catalog
from tests.conftest import SF_SMALL

KW = dict(q_id="vec_id", q_vec="embedding", c_id="vec_id", c_vec="embedding")


def rows(df):
    return sorted((r["q_id"], r["rank"], r["c_id"], round(r["score"], 6)) for r in df.collect())


def skewed(spark):
    """The given vectors with norms that fall like 1 / rank."""
    e = catalog.table(spark, SF_SMALL, "embeddings")
    scale = 100.0 / (1 + F.pmod(F.xxhash64("vec_id"), F.lit(499)))
    return e.select("vec_id", F.transform("embedding", lambda x: x.cast("double") * scale).alias("embedding"))


def test_equal_to_scan_and_fewer_pairs_on_skewed_norms(spark):
    e = skewed(spark)
    got = bounds.bounded_topk(e, e, 5, block_rows=16, **KW)
    assert rows(got) == rows(vectors.exact_topk(e, e, 5, **KW))
    assert got._qaflow_scored < 0.35 * e.count() ** 2


def test_equal_to_scan_and_fewer_pairs_with_cells(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 12))
    at = rng.integers(0, 8, 400)
    X = centres[at] * 4 + rng.normal(size=(400, 12)) * 0.2
    X /= np.linalg.norm(X, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, X[i].tolist(), int(at[i])) for i in range(400)], "vec_id long, embedding array<double>, cell int")
    got = bounds.bounded_topk(df, df, 5, block_rows=25, cell="cell", **KW)
    assert rows(got) == rows(vectors.exact_topk(df, df, 5, **KW))
    assert got._qaflow_scored < 0.5 * 400 ** 2


@pytest.mark.parametrize("k", [1, 7, 50])
def test_ties_nulls_zero_and_few_rows(spark, k):
    rng = np.random.default_rng(2)
    vecs = [rng.integers(-2, 3, 3).astype(float).tolist() for _ in range(40)] + [None, [0.0, 0.0, 0.0], None, [0.0, 0.0, 0.0]]
    df = spark.createDataFrame(list(enumerate(vecs)), "vec_id long, embedding array<double>")
    assert rows(bounds.bounded_topk(df, df, k, block_rows=4, **KW)) == rows(vectors.exact_topk(df, df, k, **KW))
    none = df.where(F.lit(False))
    assert rows(bounds.bounded_topk(df, none, k, **KW)) == rows(bounds.bounded_topk(none, df, k, **KW)) == []


def test_summaries_fit_their_bound(spark):
    e = skewed(spark)
    blocks = bounds.norm_blocks(e.select(F.col("vec_id").alias("c_id"), F.col("embedding").alias("c_vec")), block_rows=2, summary_bytes=8 * (64 + 4) * 10)
    n = blocks.where("rows is not null").count()
    assert blocks.count() == e.count() and n <= 10 + 4
    per = blocks.groupBy("block").agg(F.count("*").alias("n"), F.sum("rows").alias("rows")).collect()
    assert all(r["n"] == r["rows"] for r in per)


def test_many_queries_take_the_bounded_path(spark):
    e = skewed(spark)
    want = rows(vectors.exact_topk(e, e, 5, **KW))
    got = vectors.exact_topk(e, e, 5, broadcast_max_rows=20, **KW)
    assert rows(got) == want and got._qaflow_scored > 0


def test_bounds_hold():
    rng = np.random.default_rng(3)
    X, Q = rng.normal(size=(64, 6)), rng.normal(size=(9, 6))
    parts = X.reshape(8, 8, 6)
    centre = parts.mean(axis=1)
    radius = np.linalg.norm(parts - centre[:, None], axis=2).max(axis=1)
    bound = bounds.upper_bounds(Q, np.linalg.norm(parts, axis=2).max(axis=1), centre, radius)
    assert (np.einsum("qd,bnd->qbn", Q, parts).max(axis=2) <= bound + 1e-12).all()


def test_vectors_are_shipped_by_parts_not_by_pairs(spark, monkeypatch):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(400)], "vec_id long, embedding array<double>")
    want, sizes, write = rows(vectors.exact_topk(df, df, 3, **KW)), [], bounds._written

    def counted(out, name):
        out = write(out, name)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(bounds, "_written", counted)
    got = bounds.bounded_topk(df, df, 3, block_rows=4, query_block=150, corpus_block=100, **KW)
    assert rows(got) == want
    assert sum(sizes) < 3 * 400 + 4 * 3 * 400 + 100  # rows, blocks, queries; three hits a query and slice; a count a task


def test_kernel_holds_few_scores_and_ranks_ties_by_id(monkeypatch):
    rng = np.random.default_rng(5)
    Q, X = rng.integers(-2, 3, (50, 3)).astype(float), rng.integers(-2, 3, (300, 3)).astype(float)
    monkeypatch.setattr(vectors, "SCORE_CELLS", 1 << 10)
    s, ids = np.full((50, 7), -np.inf), np.full((50, 7), vectors._SENTINEL)
    for lo in (200, 0, 100):
        vectors._score_into_state(Q, X[lo:lo + 100], np.arange(lo, lo + 100), np.arange(50), s, ids, 7, False)
    assert (ids == np.lexsort((np.broadcast_to(np.arange(300), (50, 300)), -(Q @ X.T)), axis=1)[:, :7]).all()


def test_rows_without_a_cell_are_found_too(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0], None if i % 2 else 1) for i in range(20)], "vec_id long, embedding array<double>, cell int")
    assert rows(bounds.bounded_topk(df, df, 3, block_rows=4, cell="cell", **KW)) == rows(vectors.exact_topk(df, df, 3, **KW))
