import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from qaflow.llm import ann_tree as a
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, id string, v int, rep int"


def brute(rows, k, step):
    """Every query's k nearest, by plain comparison with all rows."""
    ok = {i: np.array(v, np.float64) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = []
    for q in sorted(i for i in ok if i % step == 0):
        near = sorted((-(ok[q] * ok[c]).sum() / (np.linalg.norm(ok[q]) * np.linalg.norm(ok[c])), c) for c in ok if c != q)[:k]
        out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(near)]
    return out


def got(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


def test_recall_against_brute_force(spark):
    rows = duckdb.sql(f"select vec_id, embedding from '{SF_SMALL}/embeddings.parquet'").fetchall()
    want = {(q, c) for q, _, c, _ in brute(rows, 5, 50)}
    have = got(a.query(spark, SF_SMALL))
    assert len({(q, c) for q, _, c, _ in have} & want) >= 0.9 * len(want)
    assert len(have) == len(want)


def test_ties_copies_and_rows_that_take_no_part(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 3)]) for i in range(120)]
    rows += [(200, None), (210, []), (220, [0.0, 0.0, 0.0]), (230, [1.0, None, 0.0]), (240, [float("nan"), 1.0, 0.0]), (250, [float("inf"), 0.0, 1.0])]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows] + [(None, [1.0, 0.0, 0.0], "x", 1, 2), (300, [1.0, 1.0], "x", 1, 2), (*rows[0], "y", 3, 4)], SCHEMA)
    have, want = got(a.nearest(df, F.col("id") % 10 == 0, 5, target=1.0)), brute(rows, 5, 10)
    assert [x[:2] for x in have] == [x[:2] for x in want]
    assert [x[3] for x in have] == pytest.approx([x[3] for x in want], abs=1e-12)


def test_few_and_no_rows(spark):
    assert got(a.nearest(spark.createDataFrame([], SCHEMA), F.col("id") % 10 == 0)) == []
    assert got(a.nearest(spark.createDataFrame([(0, [1.0, 2.0], "", 0, 0)], SCHEMA), F.col("id") % 10 == 0)) == []
    two = spark.createDataFrame([(0, [1.0, 0.0], "", 0, 0), (3, [2.0, 0.0], "", 0, 0)], SCHEMA)
    assert got(a.nearest(two, F.col("id") % 10 == 0)) == [(0, 1, 3, 1.0)]


def test_blocks_give_the_same_rows(spark, monkeypatch):
    whole = got(a.query(spark, SF_SMALL))
    monkeypatch.setattr(a, "BLOCK", 5)
    monkeypatch.setattr(a, "QUERY_BLOCK", 2)
    assert got(a.query(spark, SF_SMALL)) == whole


def test_visits_reach_every_leaf_once():
    units = a._unit(np.random.default_rng(2).normal(size=(500, 8)))
    tree = a.fit_tree(units)
    order = tree.visits(units[0])
    assert sorted(order) == np.flatnonzero(tree.count == 0).tolist()
    assert set(tree.leaf_of(units).tolist()) <= set(order)
    assert tree.visits(units[0], 3) == order[:3]


def test_groups_hold_every_leaf_once():
    units = a._unit(np.random.default_rng(3).normal(size=(900, 6)))
    tree = a.fit_tree(units, leaf=4)
    for most in (1, 7, 63):
        group, place = tree.groups(most)
        leaves = np.flatnonzero(tree.count == 0)
        assert (place[leaves] >= 0).all() and place.max() < most and (place[tree.count > 0] == -1).all()
        assert len({(group[x], place[x]) for x in leaves}) == len(leaves)


def test_an_outlier_in_a_leaf_of_its_own_finds_all_its_neighbours(spark, monkeypatch):
    rng = np.random.default_rng(4)
    X = rng.normal(size=(80, 4)) * 0.01 + np.array([1.0, 0, 0, 0])
    X[0] = [-1.0, 0.1, 0, 0]
    df = spark.createDataFrame([(i, x.tolist(), "", 0, 0) for i, x in enumerate(X)], SCHEMA)
    monkeypatch.setattr(a, "calibrate", lambda *args: (1, 0.5))
    have = got(a.nearest(df, F.col("id") % 20 == 0, 5))
    assert [x[:2] for x in have] == [(q, r) for q in (0, 20, 40, 60) for r in range(1, 6)]
