"""Neighbour graph: recall and work against exact search, exact scores, bounded degrees, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from qaflow.operators import graph, vectors
from qaflow.plans import catalog

KW = dict(q_id="vec_id", q_vec="embedding")
SCHEMA = "vec_id long, embedding array<double>"


def test_recall_and_share_of_pairs(spark):
    got = catalog.q_graph_top15_recall(spark, "/root/testdata/sf0.1").first()
    assert got["recall"] >= 0.9 and got["n_queries"] == 2000
    assert got["scored_share"] < 0.3  # the band buckets score 0.4


def test_scores_are_exact_and_degrees_bounded(spark):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(150, 8))
    X[100:140] = X[0]  # a hub of copies
    df = spark.createDataFrame([(i, X[i].tolist()) for i in range(150)] + [(200, None), (None, X[1].tolist())], SCHEMA)
    rows, near, built = graph.build_graph(df, "vec_id", "embedding", degree=6)
    sizes = {r["a"]: len(r["near"]) for r in near.collect()}
    assert set(sizes) == set(range(150)) and max(sizes.values()) <= 12 and built < 150 * 149 / 2
    hits = graph.graph_topk(df, rows, near, 5, beam=12, **KW).collect()
    assert {r["q_id"] for r in hits} == set(range(150)) and len(hits) == 750
    assert all(r["score"] == pytest.approx(float(X[r["q_id"]] @ X[r["c_id"]])) for r in hits)


def test_no_one_and_two_rows(spark):
    two = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, 0.5])], SCHEMA)
    for n in (0, 1, 2):
        df = two.where(F.col("vec_id") <= n)
        rows, near, _ = graph.build_graph(df, "vec_id", "embedding")
        got = graph.graph_topk(two, rows, near, 5, **KW).collect()
        want = vectors.exact_topk(two, df, 5, c_id="vec_id", c_vec="embedding", **KW).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_pairs_meet_vectors_by_tiles(spark):
    """Scores of pairs equal the products, whatever the parts; vectors travel once a part of the other side."""
    rng = np.random.default_rng(2)
    X = rng.normal(size=(60, 5))
    v = spark.createDataFrame([(i * 7, X[i].tolist()) for i in range(60)], "id long, v array<double>")
    pairs = spark.createDataFrame([(i * 7, j * 7) for i in range(60) for j in range(i)] + [(7, 999), (999, 7)], "a long, b long")
    for block in (1 << 16, 13):
        got = {(r["a"], r["b"]): r["score"] for r in graph.scored(pairs, v, v, block).collect()}
        assert got == {(i * 7, j * 7): pytest.approx(float(X[i] @ X[j])) for i in range(60) for j in range(i)}


def test_queries_that_have_found_their_rows_leave_the_rounds(spark, monkeypatch):
    """The last rounds hold few queries, and the hits are those of a plain beam search on the same graph."""
    rng = np.random.default_rng(3)
    X = rng.normal(size=(240, 6))
    df = spark.createDataFrame([(i, X[i].tolist()) for i in range(240)], SCHEMA).persist()
    rows, near, _ = graph.build_graph(df, "vec_id", "embedding", degree=4)
    sizes, written = [], graph._written

    def spy(t, name):
        out = written(t, name)
        if name == "graph-beam":
            sizes.append(out.select("a").distinct().count())
        return out

    monkeypatch.setattr(graph, "_written", spy)
    hits = graph.graph_topk(df, rows, near, 5, beam=8, width=2, entries=8, **KW)
    got = {(r["q_id"], r["rank"]): r["c_id"] for r in hits.collect()}
    assert sizes[0] == 240 and 8 * sizes[-1] <= 240
    links = {r["a"]: list(r["near"]) for r in near.collect()}
    begin = [r["id"] for r in rows.orderBy(F.xxhash64("id"), "id").limit(8).collect()]
    scored = 0
    for q in range(240):
        order = lambda i: (-round(float(X[q] @ X[i]), 6), i)
        beam, seen, opened = sorted(begin, key=order)[:8], set(begin), set()
        scored += len(begin)
        while new := [i for i in beam if i not in opened][:2]:
            opened |= set(new)
            fresh = {j for i in new for j in links.get(i, [])} - seen
            seen, scored = seen | fresh, scored + len(fresh)
            beam = sorted([*beam, *fresh], key=order)[:8]
        assert [got[q, k] for k in sorted(k for x, k in got if x == q)] == beam[:5]
    assert hits._qaflow_scored == scored
