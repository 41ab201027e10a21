import numpy as np
import pyarrow as pa
import pytest

from qaflow.llm import quality as q

SF = "/root/testdata/sf0.1"


def test_loss_slopes_equal_differences():
    rng = np.random.default_rng(1)
    score, grade, free = rng.normal(size=40), rng.integers(0, 4, 40), np.array([-1.0, 0.2, -0.3])
    value, by_score, by_free = q.ordinal_loss(score, grade, free)
    for i in (0, 7, 39):
        up = score.copy()
        up[i] += 1e-6
        assert (q.ordinal_loss(up, grade, free)[0] - value) / 1e-6 == pytest.approx(by_score[i], abs=1e-5)
    for i in range(3):
        up = free.copy()
        up[i] += 1e-6
        assert (q.ordinal_loss(score, grade, up)[0] - value) / 1e-6 == pytest.approx(by_free[i], abs=1e-5)


def test_features_do_not_depend_on_the_batch():
    texts = ["The cat*** sat", "", None, "a", "é ÜBER-Maß the the the", " x\n\ty ", "b" * 3_000_000 + " tail", "THE!! end"]
    whole, rows = q.features(pa.array(texts))
    for i, t in enumerate(texts):
        one, _ = q.features(pa.array([t], pa.string()))
        assert (whole[:, rows[i]:rows[i + 1]] == one).all()
    assert (whole[:4, rows[4] + 3] == -1).all() and whole[4, rows[4] + 3] >= 0 and rows[1] == rows[2] == rows[3]


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rated = q.graded(labels)
    train, held = rated.where("doc_id % 4 <> 0"), {r["doc_id"]: r["grade"] for r in rated.where("doc_id % 4 = 0").collect()}
    model = q.fit(docs, train)
    assert model.levels == [0, 1, 2] and (np.diff(model.thresholds) > 0).all()
    got = [r for r in q.score(docs.select("doc_id", "text"), model).collect() if r["doc_id"] in held]
    kept = {g: np.mean([r["tail_probability"] >= q.KEEP_AT for r in got if held[r["doc_id"]] == g]) for g in (0, 1, 2)}
    assert kept[2] > 0.97 and kept[0] < 0.1 and kept[1] < 0.25
    mean = [np.mean([r["expected_grade"] for r in got if held[r["doc_id"]] == g]) for g in (0, 1, 2)]
    assert mean[0] < mean[1] < mean[2]


def test_defined_cases(spark):
    rows = [(1, "good fine text", 1), (1, "good fine text", 1), (2, "bad bad words", 2), (3, None, 3), (4, "", 4), (None, "good", 5), (5, "fine " * 300_000, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, expected_grade int")
    rated = spark.createDataFrame([(1, 5), (2, 1), (None, 1), (3, None), (9, 1)], "doc_id long, grade int")
    model = q.fit(docs, rated)
    assert model.levels == [1, 5]
    got = q.score(docs, model).collect()
    assert len(got) == 7 and len({r["expected_grade"] for r in got if r["doc_id"] == 1}) == 1
    assert all(1 <= r["expected_grade"] <= 5 and 0 <= r["tail_probability"] <= 1 for r in got)
    assert q.fit(docs, rated.where("grade = 5")) is None and q.fit(docs, rated.limit(0)) is None
    none = q.select(q.score(docs, None))
    assert none.count() == 7 and none.schema["expected_grade"].dataType.simpleString() == "double"
    assert q.score(docs.limit(0), model).count() == 0


def test_a_rare_or_absent_grade_does_not_switch_the_filter_off(spark):
    words = ("bad awful poor", "plain middling so", "fine good great")
    rows = [(i, f"{words[2 if i % 2 else 1]} text {i}", 2 if i % 2 else 1) for i in range(4000)] + [(4000 + i, f"{words[0]} text {i}", 0) for i in range(2)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    ratings = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, grade int")
    model = q.fit(docs, ratings, max_rows=200)
    assert list(model.levels) == [0, 1, 2]
    model = q.fit(docs.where("doc_id < 4000"), ratings)
    assert list(model.levels) == [1, 2]
    got = {r.doc_id: r.tail_probability for r in q.score(docs, model).collect()}
    assert got[1] > 0.5 > got[0]
    assert q.fit(docs.where("doc_id >= 4000"), ratings) is None


def test_columns_of_the_names_used_inside(spark):
    df = spark.createDataFrame([(1, "some words", 5, 6)], "doc_id long, text string, scored int, SCORED_ int")
    model = q.Model(np.zeros(1 << q.BITS), np.array([0.0]), [0, 1])
    got = q.score(df, model).first().asDict()
    assert got == {"doc_id": 1, "text": "some words", "scored": 5, "SCORED_": 6, "expected_grade": 0.5, "tail_probability": 0.5}


def test_folded_rows_score_like_whole_features():
    rng = np.random.default_rng(2)
    texts = pa.array([" ".join(rng.choice(["aa", "bb", "ccc", "dd"], rng.integers(0, 40))) for _ in range(30)] + ["", None])
    weights = rng.normal(size=1 << q.BITS)
    whole = q._scores(*q.features(texts), weights)
    parts = [q.folded(*q.features(texts.slice(lo, hi - lo))) for lo, hi in q.slices(texts, 100)]
    assert len(parts) > 5
    docs = q.joined(parts)
    np.testing.assert_allclose(docs.scores(weights), whole, rtol=1e-5, atol=1e-6)
    by = rng.normal(size=len(texts))
    step = 1e-3 * rng.normal(size=1 << q.BITS)
    np.testing.assert_allclose(docs.slope(by, 1 << q.BITS) @ step, by @ (docs.scores(weights + step) - docs.scores(weights)), rtol=1e-4, atol=1e-7)
