"""The kernels of the block joins read Arrow tables: one matrix a side, no object a row."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from qaflow.operators import bounds, vectors


def test_arrow_matrix_puts_rows_in_the_order_asked_for():
    col = pa.chunked_array([[[1.0, 2.0], None, [3.0, 4.0]], [], [[5.0, None]]], pa.list_(pa.float64()))
    got = vectors.arrow_matrix(col, np.array([3, 0, 2]))
    assert np.array_equal(got, [[5.0, np.nan], [1.0, 2.0], [3.0, 4.0]], equal_nan=True)
    assert vectors.arrow_matrix(col, np.array([], dtype=np.int64)).shape == (0, 0)
    with pytest.raises(ValueError):
        vectors.arrow_matrix(pa.chunked_array([[[1.0, 2.0], [3.0]]], pa.list_(pa.float64())), np.arange(2))


def _rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).round(3).tolist()) for i in range(300)]
    return spark.createDataFrame([*rows, *rows[:7], (900, None)], "id long, v array<double>")


def _brute(rows, k):
    have = {r.id: r.v for r in rows if r.v is not None}
    out = set()
    for q, v in have.items():
        score = [(-round(float(np.dot(v, r.v)), 6), r.id) for r in rows if r.v is not None]
        out |= {(q, n, c, -s) for n, (s, c) in enumerate(sorted(score)[:k], 1)}
    return out


@pytest.mark.parametrize("one_group", [False, True])
def test_blocks_join_through_arrow(spark, one_group):
    df = _rows(spark)
    q = df.select(F.col("id").alias("q_id"), F.col("v").alias("q_vec"), F.lit(0).alias("g"))
    c = df.select(F.col("id").alias("c_id"), F.col("v").alias("c_vec"), F.lit(0).alias("g"))
    got = vectors.grouped_topk(q, c, 4, force_blocks=True, one_group=one_group, query_block=64, corpus_block=64)
    assert {(r.q_id, r.rank, r.c_id, round(r.score, 6)) for r in got.collect()} == _brute(df.collect(), 4)


def test_no_pandas_rows_in_the_block_joins(spark, monkeypatch):
    kinds = []
    from pyspark.sql.pandas.group_ops import PandasCogroupedOps as ops

    monkeypatch.setattr(ops, "applyInPandas", lambda *a: kinds.append("pandas"))
    arrow = ops.applyInArrow
    monkeypatch.setattr(ops, "applyInArrow", lambda *a: kinds.append("arrow") or arrow(*a))
    df = _rows(spark)
    q, c = df.select(F.col("id").alias("q_id"), F.col("v").alias("q_vec"), F.lit(0).alias("g")), df.select(F.col("id").alias("c_id"), F.col("v").alias("c_vec"), F.lit(0).alias("g"))
    vectors._block_topk_join(q, c, 4, 64, 64, False)
    bounds.bounded_topk(df, df, 4, q_id="id", q_vec="v", c_id="id", c_vec="v")
    assert kinds == ["arrow", "arrow"]
