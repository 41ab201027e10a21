import re
import zlib
from collections import Counter

import duckdb
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from qaflow.llm import spelling_variants as v
from tests.conftest import SF_SMALL
from tests.llm.oracle import same

SCHEMA = "doc_id long, text string, word string, n int, near string, part string, cut int"


def near(a, b):
    """One code point inserted, deleted or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) < len(b):
        a, b = b, a
    i = next((i for i in range(len(b)) if a[i] != b[i]), len(b))
    return a[i + 1:] == (b[i + 1:] if len(a) == len(b) else b[i:])


def brute(docs, least_n=3):
    count = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda x: x[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 5 and n >= least_n}
    forms, n_near = {}, {}
    for w in words:
        found = sorted((-words[x], x) for x in words if near(w, x))
        n_near[w] = len(found)
        forms[w] = found[0][1] if found and -found[0][0] >= 2 * words[w] else None
    out = []
    for w in words:
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, words[w], n_near[w], words.get(forms[w])))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_whole_table_equals_brute_force(spark):
    docs = duckdb.sql(f"select doc_id, text from '{SF_SMALL}/documents.parquet'").fetchall()
    want = brute(docs)
    assert got(v.query(spark, SF_SMALL)) == want and sum(r[1] is not None for r in want) > 3


def test_whole_table_equals_sql(spark):
    assert same(spark, v.query, v.SQL, SF_SMALL, ["documents"]) > 100


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text("abc", max_size=5), max_size=60))
def test_composed_machine_accepts_the_near_pairs_once(words):
    found = [tuple(sorted(p)) for p in v.Acceptor(sorted(words)).pairs()]
    assert sorted(found) == sorted((a, b) for a in words for b in words if a < b and near(a, b))


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("aé×z", max_size=6), max_size=40))
def test_acceptor_is_minimal_and_accepts_its_words(words):
    machine = v.Acceptor(sorted(words))
    seen, stack, accepted = {0}, [(0, "")], set()
    while stack:
        s, w = stack.pop()
        accepted |= {w} if machine.final[s] else set()
        stack += [(t, w + c) for c, t in machine.out[s].items()]
        seen |= set(machine.out[s].values())

    def right(s):
        return frozenset(({""} if machine.final[s] else set()) | {c + x for c, t in machine.out[s].items() for x in right(t)})

    assert accepted == words and len({right(s) for s in seen}) == len(seen)


def test_small_partitions_give_the_same_pairs(spark):
    words = sorted({a + b + c + d for a in ("", "a", "b") for b in ("a", "b", "aa") for c in ("ab", "ba", "b") for d in ("", "a", "c")})
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
    want = sorted((a, b) for a in words for b in words if near(a, b))
    for most in (1, 5, 1000):
        rows = v.near_pairs(df, most).collect()
        assert sorted((r["word"], r["near"]) for r in rows) == want
        assert all(r["near_n"] == words.index(r["near"]) for r in rows)


def test_defined_cases(spark, monkeypatch):
    monkeypatch.setattr(v, "PIECE", 40)
    monkeypatch.setattr(v, "PENDING", 10)
    texts = ["Straße straße STRASSE strasse ", "naïve naive Naïve naïves", "coloured colored colour color colors", "ÉCLAIR éclair Éclair eclair", None, "", "123 -- ,", "x" * 3000 + " " + "x" * 2999,
             "привет hello日本hello", "aaaaa aaaaaa aaaaaaa ab×cd ab÷cd"]
    docs = [(i % 7 if i % 5 else None, t) for i, t in enumerate(texts * 6)] + [(3, texts[2] * 30), (3, texts[2] * 30)]
    df = spark.createDataFrame([(*d, "w", 1, "x", "p", 2) for d in docs], SCHEMA)
    assert got(v.variants(v.vocabulary(df))) == brute(docs)
    assert got(v.variants(v.vocabulary(df), most=2)) == brute(docs)
    assert got(v.variants(v.vocabulary(df.where(F.lit(False))))) == []


def test_forms_lead_to_roots(spark):
    chain = [(f"word{'abcdefgh'[i]}" + "s" * i, 2 ** i) for i in range(8)]
    rows = [(a, b) for (a, _), (b, _) in zip(chain, chain[1:])]
    out = v.roots(spark.createDataFrame(rows, "word string, form string")).collect()
    assert {tuple(r) for r in out} == {(a, chain[-1][0]) for a, _ in rows}
