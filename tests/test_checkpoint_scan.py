"""Best checkpoint as a segmented scan: equal to a plain loop for every segment length."""

import random

import pytest

from qaflow.operators import metrics


def plain(history, mode, patience):
    best = best_step = stopped = None
    since = 0
    for step, v in sorted(history):
        if best is None or (v > best if mode == "max" else v < best):
            best, best_step, since = v, step, 0
        else:
            since += 1
            if since >= patience and stopped is None:
                stopped = step
    return best_step, best, stopped


@pytest.mark.parametrize("mode", ["max", "min"])
def test_segments_do_not_matter(spark, mode):
    rng = random.Random(3)
    rows = []
    for run in range(12):
        steps = rng.sample(range(400), rng.randint(1, 60))
        rows += [(run, s, float(rng.randint(0, 9 + run * 5))) for s in steps]
    df = spark.createDataFrame(rows, "run int, step long, loss double")
    want = {run: plain([(s, v) for r, s, v in rows if r == run], mode, 4) for run in range(12)}
    for segment in (1, 7, 64, 4096):
        got = metrics.best_checkpoint(df, "loss", mode=mode, patience=4, by=["run"], segment=segment).collect()
        assert {r["run"]: (r["best_step"], r["best"], r["stopped_at"]) for r in got} == want


def test_one_history_and_none(spark):
    df = spark.createDataFrame([(s, 1.0 / (s + 1)) for s in range(40)], "step long, f1 double")
    assert tuple(metrics.best_checkpoint(df, "f1", patience=5, segment=3).first()) == (0, 1.0, 5)
    assert metrics.best_checkpoint(df.where("step < 0"), "f1").collect() == []
