import itertools
import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from qaflow.llm import packing as p

SF = "/root/testdata/sf0.001"
PLAIN = Tokenizer.from_file(p.default_tokenizer())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["it's", " ", "\n", "\x1d", "<|endoftext|>", "ΣΑΣ", "İi", "12½", "don't'S", "ﬁ", "Å", "é", "abc!!..", "　", "😀", "-- ''", "ÿß×", "_a_", "日本"]) | st.text(max_size=6), max_size=10).map("".join))
def test_ids_are_those_of_the_tokenizer(text):
    tok = p.WordTokenizer(open(p.default_tokenizer(), encoding="utf-8").read())
    assert tok.by_word
    for _ in range(2):
        assert np.frombuffer(tok.encode(text), "<u4").tolist() == PLAIN.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=7))
def test_bound_is_below_the_least_number_of_bins(lengths):
    def least(items, rooms):
        if not items:
            return len(rooms)
        tried = [least(items[1:], [*rooms[:i], r - items[0], *rooms[i + 1:]]) for i, r in enumerate(rooms) if r >= items[0]]
        return min([*tried, least(items[1:], [*rooms, 20 - items[0]])])

    bound = p.lower_bound(np.array(lengths), 20)
    bins, offsets = p.best_fit_decreasing(np.array(lengths), 20)
    assert -(-sum(lengths) // 20) <= bound <= least(tuple(lengths), []) <= bins.max() + 1


def check(rows, texts, capacity=2048):
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        b.sort()
        assert b[0][0] == 0 and all(x + n == y for (x, n), (y, _) in itertools.pairwise(b)) and sum(b[-1]) <= capacity
    want = []
    for doc, text in texts:
        ids = [*PLAIN.encode(text or "", add_special_tokens=False).ids, 0]
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a:a + capacity]
            want.append((doc is None, doc or 0, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(want) == sorted((r["doc_id"] is None, r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    return len(bins)


def test_whole_table_and_few_sequences(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = p.query(spark, SF).collect()
    n = check(rows, [(d.doc_id, d.text) for d in docs.select("doc_id", "text").collect()])
    assert n <= p.lower_bound(np.array([r["length"] for r in rows]), 2048) + 1


def test_defined_cases(spark):
    texts = [(1, None), (2, ""), (3, "word " * 9000), (3, "word " * 9000), (None, "x y"), (4, "a" * 70_000)]
    df = spark.createDataFrame([(*t, 5, 6) for t in texts], "doc_id long, text string, sequence_id int, length int")
    check(p.pack_documents(df, p.default_tokenizer()).collect(), texts)
    assert p.pack_documents(df.limit(0), p.default_tokenizer()).collect() == []


def test_exchange_certifies_and_saves_bins(spark):
    rng = np.random.default_rng(5)
    lengths = np.concatenate([rng.integers(1, 2048, 3000), rng.choice([683, 1365, 700, 1024, 1025], 3000)])
    df = spark.createDataFrame([(i, 0, 0, int(n), 0, i) for i, n in enumerate(lengths)], p.PIECES)
    alone = p.pack(df, items_per_partition=500, max_rounds=0).collect()
    rows = p.pack(df, items_per_partition=500).collect()
    assert len(rows) == len({r["rid"] for r in rows}) == len(lengths)
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert all(sum(n for _, n in b) <= 2048 for b in bins.values())
    bound, before = p.lower_bound(lengths, 2048), len({r["sequence_id"] for r in alone})
    assert bound <= len(bins) < before and len(bins) <= bound * 1.01
