"""Encoder and cell assignment of an index refresh work on Arrow columns."""

import datetime

import numpy as np
import pyarrow as pa
import pytest

from qaflow.operators import models, vectors


def test_hash_vectors_of_an_arrow_column():
    texts = pa.array(["skipped", None, "", "one two two", "Ärger 文字", *[f"w{i}" for i in range(1100)]]).slice(1)
    got = models.hash_vectors(texts, 8)
    assert got.type == pa.list_(pa.float64()) and len(got) == len(texts)
    for text, vector in zip(texts.to_pylist(), got.to_pylist()):
        want = np.zeros(8)
        for code in (models.token_code(t, 8) for t in (text or "").split()):
            want[abs(code) - 1] += np.sign(code)
        norm = np.linalg.norm(want)
        assert vector == pytest.approx(want / norm if norm else want)
    assert models.hash_vectors(pa.array([], pa.string()), 8).to_pylist() == []


@pytest.mark.parametrize("n", [1, 2])
def test_cells_leave_other_columns_alone(spark, monkeypatch, n):
    monkeypatch.setattr(vectors, "SCORE_CELLS", 4)  # several steps a batch
    at = datetime.datetime(2024, 1, 2)
    rows = [(1, [1.0, 0.0], None, at), (2, None, "x", None), (None, [0.0, 3.0], "ä", at), (4, [0.0, 0.0], "y", at), (1, [1.0, 0.1], "z", None)]
    df = spark.createDataFrame(rows, "id long, v array<double>, t string, at timestamp").coalesce(1)
    cells = spark.createDataFrame([(3, [1.0, 0.0]), (5, [0.0, 1.0])], "cell int, centroid array<double>")
    plan = vectors.nearest_cells(df, cells, "v", n)
    assert "MapInArrow" in plan._jdf.queryExecution().toString()
    got = [tuple(r) for r in plan.collect()]
    want = [[3, 5], None, [5, 3], [3, 5], [3, 5]]
    assert got == [(*r, w if n > 1 or w is None else w[0]) for r, w in zip(rows, want)]
