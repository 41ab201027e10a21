"""Keyed permutation: a bijection for every n, different by seed and epoch, evenly spread, without a sort."""

import pytest
from pyspark.sql import functions as F

from qaflow.operators import permute


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 31, 100, 1000, 4097])
def test_every_position_once(spark, n):
    got = spark.range(n).select(permute.permuted("id", n, 7).alias("p"))
    assert sorted(r["p"] for r in got.collect()) == list(range(n))


def test_seeds_and_epochs_differ_and_spread(spark):
    n = 2000
    cols = [permute.permuted("id", n, s, e).alias(f"p{s}_{e}") for s, e in ((1, 0), (1, 1), (2, 0))]
    rows = spark.range(n).select("id", *cols).collect()
    for c in ("p1_0", "p1_1", "p2_0"):
        assert sum(r[c] == r["id"] for r in rows) < 10
        near = sum(abs(r[c] - s[c]) < 50 for r, s in zip(rows, rows[1:]))
        assert near < 0.15 * n
        assert abs(sum(r[c] for r in rows[:500]) / 500 - n / 2) < 0.1 * n
    assert sum(r["p1_0"] == r["p1_1"] for r in rows) < 10


def test_outside_and_null_positions(spark):
    df = spark.createDataFrame([(-1,), (5,), (None,), (4,)], "id long")
    got = [r["p"] for r in df.select(permute.permuted("id", 5, 3).alias("p")).collect()]
    assert got[:3] == [None, None, None] and 0 <= got[3] < 5


def test_batches_without_a_range_exchange(spark):
    out = permute.shuffle_batches(spark.range(100), "id", 100, 8, seed=1)
    sizes = {r["batch"]: r["count"] for r in out.groupBy("batch").count().collect()}
    assert sizes == {b: 8 if b < 12 else 4 for b in range(13)}
    plan = out.repartition("batch")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Sort" not in plan
    assert out.select(F.max("slot")).first()[0] == 7
