"""Two-level quantiser: agreement with flat search, order and block independence, odd rows."""

import numpy as np
from pyspark.sql import functions as F

from qaflow.operators import quantiser as z
from qaflow.plans import catalog

SCHEMA = "vec_id long, embedding array<double>"


def leaves_of(df):
    return sorted((r["cell"], r["coarse"], tuple(r["centroid"])) for r in df.collect())


def test_agreement_with_flat_search(spark):
    got = catalog.q_tree_cells_agreement(spark, "/root/testdata/sf0.1").first()
    assert got["n"] == 2000 and got["cells"] == 64 and got["agreement"] >= 0.95


def made(spark):
    rng = np.random.default_rng(5)
    X = rng.normal(size=(120, 5))
    X[:50] = X[0]  # copies
    return [(i, X[i].tolist()) for i in range(120)] + [(200, None), (201, [0.0] * 5), (202, [float("nan")] + [1.0] * 4)]


def test_blocks_order_and_fan_in_do_not_matter(spark):
    df = spark.createDataFrame(made(spark), SCHEMA)
    one = z.train_tree(df, "embedding", 9, rounds=3)
    other = z.train_tree(df.orderBy(F.rand(3)).repartition(3), "embedding", 9, rounds=3, block=7, fan_in=2)
    assert leaves_of(one[1]) == leaves_of(other[1]) and one[1].count() == 9
    rows = df.where("vec_id < 202")
    a = {r["vec_id"]: r["cell"] for r in z.assign_tree(rows, *one, "vec_id", "embedding").collect()}
    b = {r["vec_id"]: r["cell"] for r in z.assign_tree(rows.repartition(5), *other, "vec_id", "embedding", block=4).collect()}
    assert a == b and len(a) == 122
    assert a[200] is None and a[201] is not None and len({a[i] for i in range(50)}) == 1


def test_leaves_are_means_of_their_rows(spark):
    rng = np.random.default_rng(6)
    centres = np.eye(4) * 10
    X = np.concatenate([c + rng.normal(size=(20, 4)) * 0.1 for c in centres])
    df = spark.createDataFrame([(i, X[i].tolist()) for i in range(80)], SCHEMA)
    first, leaves = z.train_tree(df, "embedding", 4, rounds=4)
    U = X / np.linalg.norm(X, axis=1, keepdims=True)
    cells = {r["vec_id"]: r["cell"] for r in z.assign_tree(df, first, leaves, "vec_id", "embedding", probes=9).collect()}
    for r in leaves.collect():
        own = U[[i for i in cells if cells[i] == r["cell"]]].sum(axis=0)
        assert np.allclose(own / np.linalg.norm(own), r["centroid"], atol=1e-6)


def test_few_and_no_vectors(spark):
    two = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0])], SCHEMA)
    first, leaves = z.train_tree(two, "embedding", 16)
    assert leaves.count() == 2
    assert len({r["cell"] for r in z.assign_tree(two, first, leaves, "vec_id", "embedding").collect()}) == 2
    first, leaves = z.train_tree(two.where(F.lit(False)), "embedding", 16)
    assert leaves.count() == 0
    assert [r["cell"] for r in z.assign_tree(two, first, leaves, "vec_id", "embedding").collect()] == [None, None]


def test_shares():
    assert z.shares({0: 1, 1: 1, 2: 98}, 10) == {0: 1, 1: 1, 2: 8}
    assert z.shares({0: 50, 1: 50}, 5) == {0: 3, 1: 2}
    assert sum(z.shares({0: 30, 1: 50, 2: 20}, 10).values()) == 10
