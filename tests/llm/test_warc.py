import base64
import gzip
import hashlib
import io
import random

import pytest

from qaflow.llm import warc

SCHEMA = "page_id long, url string, html string, extra string"


def rows(spark, data, **kw):
    return sorted((r.asDict() for r in warc.archive_round_trip(spark.createDataFrame(data, SCHEMA), **kw).collect()),
                  key=lambda r: (r["page_id"] is None, r["page_id"], r["payload_digest"]))


def test_round_trip_with_nulls_ties_and_long_texts(spark):
    long = "x\r\n\r\né" * 200_000
    data = [(1, "http://a/ b", "hi", "x"), (2, None, None, "x"), (3, "u", "hi", "x"), (4, "u", long, None),
            (5, "u", "", "x"), (6, "u", "hi", None), (None, "u", "hi", None), (7, "u", "WARC/1.1\r\n\r\n", None)]
    got = {r["page_id"]: r for r in rows(spark, data)}
    assert {k: r["refers_to"] for k, r in got.items()} == {1: 6, 2: 5, 3: 6, 4: None, 5: None, 6: None, None: 6, 7: None}
    for page, _, html, _ in data:
        raw = (html or "").encode()
        assert got[page]["payload_bytes"] == len(raw) and got[page]["digest_ok"]
        assert got[page]["payload_digest"] == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        assert got[page]["payload"] == (raw if got[page]["refers_to"] is None else None)
    assert got[1]["record_type"] == "revisit" and got[6]["record_type"] == "response" and got[2]["url"] is None


def test_repeated_rows_and_minimum_size(spark):
    got = rows(spark, [(1, "u", "abc", None)] * 3 + [(2, "u", "abc", None)] * 2)
    assert [r["record_type"] for r in got] == ["revisit"] * 3 + ["response"] * 2
    assert all(r["record_type"] == "response" for r in rows(spark, [(1, "u", "abc", None), (2, "u", "abc", None)], min_bytes=4))


def test_empty_table(spark):
    assert rows(spark, []) == []


def test_reader_is_incremental_and_strict():
    payloads = [random.Random(i).randbytes(i * 7919) for i in range(12)]
    parts = [gzip.compress(warc.record_bytes(i, "u", p, None)) for i, p in enumerate(payloads)]
    for size in (1, 17, 4096, 1 << 20):
        use = parts[:3] if size == 1 else parts
        got = list(warc.records_of(io.BytesIO(b"".join(use)), True, size))
        assert [g["payload"] for g in got] == payloads[:len(use)] and all(g["digest_ok"] for g in got)
    with pytest.raises(ValueError):
        list(warc.records_of(io.BytesIO(parts[5][:-9])))
    raw = bytearray(gzip.decompress(parts[5]))
    raw[-20] ^= 1
    assert [g["digest_ok"] for g in warc.records_of(io.BytesIO(gzip.compress(bytes(raw))))] == [False]
    with pytest.raises(ValueError):
        list(warc.records_of(io.BytesIO(gzip.compress(bytes(raw) + b"more"))))


def test_archives_roll_and_every_record_is_one_member(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", "t" * i, None) for i in range(50)], SCHEMA).coalesce(1)
    manifest = warc.write_archives(warc.with_revisits(df).coalesce(1), str(tmp_path / "w"), roll_bytes=2000).collect()
    assert len(manifest) > 3 and sum(m["records"] for m in manifest) == 50
    data = open(manifest[0]["path"], "rb").read()
    assert len(data) == manifest[0]["bytes"] and gzip.decompress(data).count(b"WARC/1.1") == manifest[0]["records"]
