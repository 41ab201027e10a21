import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from qaflow.llm import language_id as m
from qaflow.llm.common import text_bytes
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, score double, label int, place long, id string"


def plain_subwords(text):
    """Buckets of the 2 to 4 bytes long pieces of every marked word, one order after the other."""
    folded = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text.encode())
    words, out = folded.split(), []
    for n in m.GRAMS:
        for w in words:
            marked = b"\0" + w + b"\0"
            for i in range(len(marked) - n + 1):
                x = int.from_bytes(marked[i:i + n], "little")
                x = (x ^ n * 0x3C6EF372 & 0xFFFFFFFF) * 0x9E3779B1 & 0xFFFFFFFF
                x = (x ^ x >> 15) * 0x85EBCA77 & 0xFFFFFFFF
                out.append(x >> 16)
    return out


TEXTS = ["", "a", "Ab  c", "\n12\n", "é", "El niño. ¿Qué?", "x" * 50, " lead", "trail ", "日本 語", "A" * 3 + "-" * 9 + "b"]


def test_subwords_equal_plain_pieces():
    ids, starts = m.subwords(*text_bytes(pa.array([*TEXTS, None])))
    for i, text in enumerate([*TEXTS, ""]):
        assert sorted(ids[starts[i]:starts[i + 1]].tolist()) == sorted(plain_subwords(text)), text


def test_slices_change_nothing(monkeypatch):
    rng = np.random.default_rng(1)
    texts = [" ".join("abcdefé"[: rng.integers(1, 8)] for _ in range(rng.integers(0, 90))) for _ in range(40)]
    data, offsets = text_bytes(pa.array(texts))
    whole = m.subwords(data, offsets)
    monkeypatch.setattr(m, "SLICE", 64)
    counts, found = np.zeros(len(texts), int), []
    for row, cut in m.slices(data, offsets):
        ids, starts = m.subwords(data, cut)
        counts[row:row + len(cut) - 1] += np.diff(starts)
        found.append(ids)
    assert counts.tolist() == np.diff(whole[1]).tolist()
    assert sorted(np.concatenate(found).tolist()) == sorted(whole[0].tolist())


def test_whole_table_against_plain_scoring_and_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = m.learn(docs.where(~m.held_out(F.col("doc_id"))))
    rows = {r["doc_id"]: r for r in m.query(spark, SF_SMALL).collect()}
    truth = duckdb.sql(f"select doc_id, text, lang from '{SF_SMALL}/documents.parquet'").fetchall()
    assert len(rows) == len(truth)
    right = []
    for doc_id, text, lang in truth:
        ids = plain_subwords(text)
        x = np.mean([model.table[i].astype(float) for i in ids], axis=0) @ model.layer / model.temperature
        p = np.exp(x - x.max()) / np.exp(x - x.max()).sum()
        got = rows[doc_id]
        assert got["lang_pred"] == model.langs[int(p.argmax())]
        assert got["score"] == pytest.approx(p.max(), abs=1e-6)
        assert got["accepted"] == (got["score"] >= model.threshold)
        if got["held_out"]:
            right.append(got["lang_pred"] == lang)
    assert np.mean(right) >= 0.95 and len(right) > 20


def test_rejection_is_calibrated():
    rng = np.random.default_rng(4)
    label = rng.integers(0, 2, 4000)
    x = rng.normal(size=4000) + 2 * (2 * label - 1)
    model = m.Model(["a", "b"], np.zeros((1, 2)), np.eye(2))
    logits = np.stack([-10 * x, 10 * x], 1)  # far too sure of itself
    m.calibrate(model, logits, np.ones(4000), label, 0.99)
    p = model.probabilities(logits, np.ones(4000))
    sure = p.max(1) >= model.threshold
    assert 3 < model.temperature < 8
    assert 0.985 <= (p.argmax(1) == label)[sure].mean() and 0.5 < sure.mean() < 1


def test_defined_cases(spark):
    en, de = "the cat and the dog are here ", "der hund und die katze sind da "
    rows = [(i, (en, de)[i % 2] * (1 + i % 5), ("en", "de")[i % 2]) for i in range(200)]
    odd = [(500, None, "en"), (501, "", "de"), (502, "123 ,.", "en"), (503, en, None), (None, de, "de"), (504, de * 40_000, None), (505, en, "en"), (505, en, "en"), (506, "x" * 300_000, "en")]
    df = spark.createDataFrame([(*r, 0.5, 1, 2, "z") for r in rows + odd], SCHEMA)
    model = m.learn(df)
    assert model.langs == ["de", "en"]
    out = [tuple(r) for r in m.identify(df, model).where("doc_id is null or doc_id >= 500").collect()]
    got = {r[0]: r for r in out}
    assert len(out) == len(odd)
    for i in (500, 501, 502):
        assert got[i][1:] == ("und", 0.0, False)
    assert got[503][1] == got[505][1] == "en" and got[None][1] == got[504][1] == "de"
    assert all(0 <= r[2] <= 1 for r in out)


def test_nothing_and_one_language_to_learn(spark):
    df = spark.createDataFrame([(1, "some words", None, 0.0, 0, 0, ""), (2, None, "en", 0.0, 0, 0, ""), (3, "9", "en", 0.0, 0, 0, "")], SCHEMA)
    assert m.learn(df) is None
    assert {tuple(r)[1:] for r in m.identify(df, None).collect()} == {("und", 0.0, False)}
    one = spark.createDataFrame([(1, "some words", "en", 0.0, 0, 0, ""), (2, None, "fr", 0.0, 0, 0, "")], SCHEMA)
    assert sorted(tuple(r) for r in m.identify(one, m.learn(one)).collect()) == [(1, "en", 1.0, True), (2, "und", 0.0, False)]
    none = df.where(F.lit(False))
    assert m.learn(none) is None and m.identify(none, None).count() == 0
