import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from qaflow.llm import common, simjoin
from qaflow.llm import jaccard_join as j

SCHEMA = "doc_id long, text string, component_id string, vertex int"


def shingles(text, k):
    words = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset([tuple(words)] if 0 < len(words) < k else [tuple(words[i:i + k]) for i in range(len(words) - k + 1)])


def brute(rows, k, num, den):
    sets, root = {d: shingles(t, k) for d, t in rows}, {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(set)
    for d, s in sets.items():
        for x in s:
            holders[x].add(d)
    for a, b in {(a, b) for h in holders.values() for a in h for b in h if a < b}:
        if den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
            ra, rb = find(a), find(b)
            root[max(ra, rb)] = min(ra, rb)
    return {d: (len(sets[d]), find(d)) for d in sets}


@settings(max_examples=80, deadline=None)
@given(st.lists(st.none() | st.lists(st.sampled_from(["a", "B", "b", " ", "\n", "\x0b", "é", " ", "word"]), max_size=12).map("".join), max_size=8))
def test_shingle_sets_equal_plain_python(texts):
    got = list(j.shingle_sets(pa.array(texts, pa.string()), 3))
    assert [len(g) for g in got] == [len(shingles(t, 3)) for t in texts]
    for x, a in enumerate(texts):
        for y, b in enumerate(texts):
            assert len(np.intersect1d(got[x], got[y])) == len(shingles(a, 3) & shingles(b, 3))


def test_long_rows_are_cut_at_spaces():
    text = " ".join(f"w{i % 9973}" for i in range(400_000))
    assert len(text) > 2 * common._SLICE
    [s], [t] = j.shingle_sets(pa.array([text]), 4), j.shingle_sets(pa.array([" \n" + text]), 4)
    assert len(s) == len(shingles(text, 4)) and (s == t).all()
    assert len(next(j.shingle_sets(pa.array(["x" * (3 * common._SLICE)]), 4))) == 1


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.booleans())
def test_tile_links_span_the_true_links(seed, two):
    rng = np.random.default_rng(seed)
    base = [rng.integers(0, 1 << 62, 30).astype(np.uint64) for _ in range(2)]
    sets = [np.unique(np.where(rng.random(30) < 0.08, rng.integers(0, 1 << 62, 30).astype(np.uint64), base[i % 2])[:rng.integers(24, 31)]) for i in range(14)]
    side = np.arange(14) % 3 % 2 if two else np.zeros(14, int)
    links = simjoin.tile_links(sets, side, 80, 100)
    both = lambda a, b: len(np.intersect1d(sets[a], sets[b]))
    true = {(a, b) for a in range(14) for b in range(a) if (side[a] != side[b] or not two) and 100 * both(a, b) >= 80 * (len(sets[a]) + len(sets[b]) - both(a, b))}
    assert {(max(x), min(x)) for x in links} <= true

    def parts(edges):
        r = list(range(14))
        for a, b in edges:
            r = [r[a] if x == r[b] else x for x in r]
        return [min(i for i in range(14) if r[i] == x) for x in r]

    assert parts(links) == parts(true)


@pytest.mark.parametrize("block", [2, 128])
def test_components_equal_brute_force(spark, monkeypatch, block):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    base = [f"w{i}" for i in range(120)]
    for i in range(60):
        rows.append((1000 + i, " ".join(base[:i] + [f"x{i}"] + base[i + 1:])))
    rows += [(2000 + i, " ".join(base[: 60 + i])) for i in range(60)] + [(3000, "one two"), (3001, "ONE\ttwo "), (3002, " "), (3003, None), (3004, ""), (3005, "word " * 300_000), (3006, "word " * 200_000)]
    monkeypatch.setattr(simjoin.linked_components, "__defaults__", (block,))
    monkeypatch.setattr(simjoin, "SKETCH_BLOCK", 8 * block)
    monkeypatch.setattr(simjoin, "PAIR_SIZE", 200 * block)
    got = j.jaccard_components(spark.createDataFrame([(*r, "c", 1) for r in rows], SCHEMA))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == brute(rows, 4, 85, 100)


def test_defined_cases(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (5, text), (7, text), (7, text), (None, "alone here"), (None, None), (9, text + " more")]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], SCHEMA)
    got = sorted(((r["doc_id"], r["component_id"]) for r in j.jaccard_components(df).collect()), key=str)
    assert got == sorted([(None, 5), (5, 5), (7, 5), (7, 5), (None, None), (None, None), (9, 5)], key=str)
    assert j.jaccard_components(df.limit(0)).count() == 0
    assert sorted(str(r["doc_id"]) for r in j.one_of_each(df).collect()) == ["5", "None", "None", "None"]


def test_documents_that_share_rare_shingles_by_chance_are_no_candidates(spark, monkeypatch):
    import random

    rng, texts = random.Random(5), []
    for i in range(120):
        texts.append([f"w{i}_{n}" for n in range(200)])
    for i in range(119):  # a passage of 20 words that two documents share, in a chain through all of them
        texts[i + 1][:20] = texts[i][180:]
    near = [w if n % 60 else f"new{n}" for n, w in enumerate(texts[7])]
    rows = [(i, " ".join(t)) for i, t in enumerate([*texts, near, rng.sample(near, len(near))])]
    seen = []
    linked = j.linked_components
    monkeypatch.setattr(j, "linked_components", lambda edges, *a, **b: seen.append(edges.collect()) or linked(edges, *a, **b))
    monkeypatch.setattr(j, "cell_ranks", lambda sets: np.zeros(1 << j.CELL_BITS, np.uint8))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in j.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()}
    assert got == brute(rows, 4, 85, 100)
    assert got[120][1] == 7
    assert len(seen[0]) < 30


def test_may_match_loses_no_row_that_is_asked_for(spark):
    df = spark.range(5000).selectExpr("if(id % 50 = 0, null, id * 7919 - 9000000) as k", "id as bit")
    asked = spark.range(0, 5000, 77).selectExpr("id * 7919 - 9000000 as v")
    got = [(r.k, r.bit) for r in common.may_match(df, "k", asked, "v").collect()]
    assert len(got) == len(set(got)) < 200
    assert {n for _, n in got} >= {n for n in range(0, 5000, 77) if n % 50}


def test_passages_of_a_few_dozen_documents_join_nothing_up(spark, monkeypatch):
    # 120 unlike documents; passages of 30 words that 15 documents share; cells as full as they are with millions of documents
    texts = [[f"w{i}_{n}" for n in range(200)] for i in range(120)]
    for i in range(120):
        for at, group in ((20, i // 15), (100, 8 + i % 8)):
            texts[i][at:at + 30] = [f"p{group}_{n}" for n in range(30)]
    near = [w if n % 60 else f"new{n}" for n, w in enumerate(texts[7])]
    rows = [(i, " ".join(t)) for i, t in enumerate([*texts, near])] + [(121 + i, " ".join(near)) for i in range(12)]
    seen = []
    linked = j.linked_components
    monkeypatch.setattr(j, "linked_components", lambda edges, *a, **b: seen.append(edges.collect()) or linked(edges, *a, **b))
    monkeypatch.setattr(j, "cell_ranks", lambda sets: np.full(1 << j.CELL_BITS, 60, np.uint8))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in j.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()}
    assert got == brute(rows, 4, 85, 100)
    assert got[130][1] == 7
    assert len(seen[0]) < 10


def test_shared_shingles_ranks_every_one_of_more_than_eight_documents_last(spark):
    rows = [(" ".join([f"u{i}_{n}" for n in range(30)] + ["every one has these words"] + (["nine have these words too"] if i < 9 else ["eight of these words"] if i < 17 else [])),) for i in range(40)]
    ranks = j.shared_shingles(spark.createDataFrame([*rows, *rows[:3], (None,)], "text string").repartition(3), 4)
    rank = lambda text: ranks.rank(next(j.shingle_sets(pa.array([text]), 4)), np.zeros(len(text.split()) - 3, np.uint8)).tolist()
    assert min(rank("every one has these words")) > max(rank("nine have these words too")) >= min(rank("nine have these words too")) > 127
    assert rank("eight of these words") == [0]
    assert sum(r == 0 for r in rank(rows[20][0])) >= 30


def test_unmatched_keeps_null_keys_and_copies(spark):
    df = spark.range(3000).selectExpr("if(id % 50 = 0, null, id % 1000) as k", "id as bit")
    gone = spark.range(0, 1000, 3).selectExpr("id as k")
    want = sorted(str((r.k, r.bit)) for r in df.collect() if r.k is None or r.k % 3)
    assert sorted(str((r.k, r.bit)) for r in common.unmatched(df, "k", gone).collect()) == want
    assert common.unmatched(df, "k", gone.limit(0)).count() == 3000
