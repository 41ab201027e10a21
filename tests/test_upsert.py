"""Keyed upserts: any order and cut into batches, replays and deletions equal the batch result."""

import datetime as dt
import hashlib
import os
import random
import shutil

import pandas as pd
import pytest
from pyspark.sql import functions as F

from qaflow.streaming import refresh, upsert

SCHEMA = "doc_id long, source string, text string, updated_at timestamp"


def deliveries():
    rng = random.Random(4)
    rows = []
    for doc in range(12):
        for _ in range(rng.randint(1, 5)):
            t = rng.randint(0, 3)
            at = None if rng.random() < 0.1 else dt.datetime(2024, 1, 1, t)
            rows.append((doc, "s", None if rng.random() < 0.15 else f"doc {doc} text {rng.randint(0, 2)}", at))
    rows += [(7, "s", f"hot {i}", dt.datetime(2023, 1, 1)) for i in range(60)] + [(None, "s", "nobody", None)]
    return rows


def put(spark, rows, inbox):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(inbox)


def state(df):
    return sorted((r["doc_id"], r["text"], r["updated_at"]) for r in df.collect())


@pytest.mark.parametrize("order", [1, 2])
def test_any_order_and_cut_equal_the_batch_result(spark, tmp_path, order):
    rows = deliveries()
    want = state(upsert.current_documents(spark.createDataFrame(rows, SCHEMA).where("doc_id is not null"), "updated_at"))
    random.Random(order).shuffle(rows)
    inbox, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    for lo in range(0, len(rows), 40):
        put(spark, rows[lo:lo + 40], inbox)
        upsert.upsert_stream(spark, inbox, out, ckpt, SCHEMA, "updated_at", max_files_per_trigger=1)
    accepted = spark.read.parquet(out)
    assert state(upsert.current_documents(accepted, "updated_at")) == want
    assert accepted.count() < len(rows)


def test_replayed_batch_emits_the_same(spark, tmp_path):
    inbox, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    put(spark, [(1, "s", "a", dt.datetime(2024, 1, 1)), (2, "s", "b", dt.datetime(2024, 1, 1))], inbox)
    upsert.upsert_stream(spark, inbox, out, ckpt, SCHEMA, "updated_at")
    put(spark, [(1, "s", "newer", dt.datetime(2024, 1, 2)), (2, "s", "older", dt.datetime(2023, 1, 1))], inbox)
    upsert.upsert_stream(spark, inbox, out, ckpt, SCHEMA, "updated_at")
    first = state(spark.read.parquet(out))
    assert [r[1] for r in first] == ["a", "newer", "b"]
    for f in (f"{ckpt}/commits/1", f"{ckpt}/commits/.1.crc"):  # as if the driver was lost before the commit
        if os.path.exists(f):
            os.remove(f)
    shutil.rmtree(f"{out}/epoch=1")
    upsert.upsert_stream(spark, inbox, out, ckpt, SCHEMA, "updated_at")
    assert state(spark.read.parquet(out)) == first


def test_refresh_with_keyed_state_keeps_the_newest(spark, tmp_path):
    inbox, base, ckpt = (str(tmp_path / n) for n in ("in", "index", "ckpt"))
    put(spark, [(1, "s", "new words here", dt.datetime(2024, 1, 2)), (2, "s", "other", dt.datetime(2024, 1, 1))], inbox)
    refresh.refresh_stream(spark, inbox, base, ckpt, SCHEMA, event_time="updated_at", nlist=2, keyed_state=True)
    put(spark, [(1, "s", "old words", dt.datetime(2024, 1, 1)), (3, "s", "third", dt.datetime(2024, 1, 1))], inbox)
    refresh.refresh_stream(spark, inbox, base, ckpt, SCHEMA, event_time="updated_at", nlist=2, keyed_state=True)
    _, postings, _ = refresh.read_live(spark, base)
    assert sorted((r["doc_id"], r["text"]) for r in postings.collect()) == [(1, "new words here"), (2, "other"), (3, "third")]
    assert postings.agg(F.count("*")).first()[0] == 3


@pytest.mark.parametrize("name, copies", [("stream_upserts", 3), ("refresh_stream", 1)])
def test_large_deliveries_come_in_several_files(spark, monkeypatch, name, copies):
    """The same rows in four deliveries, of as many files as their size asks for."""
    from qaflow.plans import catalog
    from tests.conftest import SF_SMALL

    class Sent(Exception):
        pass

    def stop(spark, inbox, *_, max_files_per_trigger):
        raise Sent(inbox, max_files_per_trigger)

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    chars = docs.agg(F.sum(F.length("text"))).first()[0]
    monkeypatch.setattr(catalog, "FILE_CHARS", chars // 12)
    monkeypatch.setattr(upsert, "upsert_stream", stop)
    monkeypatch.setattr(refresh, "refresh_stream", stop)
    with pytest.raises(Sent) as e:
        getattr(catalog, f"q_{name}")(spark, SF_SMALL)
    inbox, files = e.value.args
    found = [f for f in os.listdir(inbox.removeprefix("file:")) if f.endswith(".parquet")]
    assert 3 * files < len(found) <= 4 * files and files >= 3 * copies
    assert spark.read.parquet(inbox).count() == copies * docs.count()


class Held:
    """A state value that counts how often it is asked."""

    def __init__(self):
        self.value, self.calls, self.now = None, 0, 0

    def getValueState(self, name, schema, ttl_ms=None):
        return self

    def exists(self):
        self.calls += 1
        return self.value is not None

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def getCurrentProcessingTimeInMs(self):
        return self.now


def test_the_state_is_asked_once_a_bucket_whatever_its_documents(monkeypatch):
    rng = random.Random(9)
    rows = [(d, f"text {rng.randint(0, 3)}", pd.Timestamp(2024, 1, 1, rng.randint(0, 5)) if rng.random() < 0.9 else pd.NaT) for d in range(300) for _ in range(6)]
    rng.shuffle(rows)
    held, got = Held(), {}
    monkeypatch.setattr(upsert, "MOST_HELD", 50)
    state_of = upsert.LatestUpdate("doc_id", "updated_at", "text", ["doc_id", "text", "updated_at"])
    state_of.init(held)
    for batch in (rows[:900], rows[900:]):
        held.calls = 0
        out = list(state_of.handleInputRows((0,), (pd.DataFrame(batch[i:i + 40], columns=["doc_id", "text", "updated_at"]).assign(bucket=0) for i in range(0, 900, 40)), held))
        assert held.calls <= 3 and len(out) == 1 and list(out[0].columns) == ["doc_id", "text", "updated_at"]
        assert out[0]["doc_id"].is_unique
        for doc, text, at in out[0].itertuples(index=False):
            new = (-1 if pd.isna(at) else at.value // 1000, hashlib.md5(text.encode()).hexdigest(), text)
            assert doc not in got or new > got[doc]
            got[doc] = new
    order = lambda r: (-1 if pd.isna(r[2]) else r[2].value // 1000, hashlib.md5(r[1].encode()).hexdigest(), r[1])
    assert got == {d: max(order(r) for r in rows if r[0] == d) for d in range(300)}


def test_a_document_of_a_bucket_is_forgotten_by_itself():
    held = Held()
    state_of = upsert.LatestUpdate("doc_id", "updated_at", "text", ["doc_id", "text", "updated_at"], ttl_ms=100)
    state_of.init(held)

    def put(now, *docs, hour=2):
        held.now = now
        pdf = pd.DataFrame([(d, "t", pd.Timestamp(2024, 1, 1, hour)) for d in docs], columns=["doc_id", "text", "updated_at"])
        return [d for out in state_of.handleInputRows((0,), iter([pdf]), held) for d in out["doc_id"]]

    assert put(0, 1, 2) == [1, 2]
    assert put(60, 2, 3, hour=3) == [2, 3]
    assert put(120, 1, 2, 3, hour=1) == [1]  # 1 is forgotten, the later ones are not
    assert put(130, 1, 2, 3, hour=1) == []


def test_documents_of_one_bucket_stay_apart(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(upsert, "BUCKETS", 2)
    rows = [r for r in deliveries() if r[0] is not None]
    want = state(upsert.current_documents(spark.createDataFrame(rows, SCHEMA), "updated_at"))
    inbox, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    for lo in range(0, len(rows), 45):
        put(spark, rows[lo:lo + 45], inbox)
    upsert.upsert_stream(spark, inbox, out, ckpt, SCHEMA, "updated_at", max_files_per_trigger=1)
    assert state(upsert.current_documents(spark.read.parquet(out), "updated_at")) == want
