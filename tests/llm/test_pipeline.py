"""The whole chain of the pipeline against a plain one: each stage's decisions by brute force on its own input."""

import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

import corpus_pipeline as p
from qaflow.llm import decontam, linededup, packing, quality
from qaflow.llm.common import read

from .test_decontam import least
from .test_jaccard_join import brute

SF = "/root/testdata/sf0.001"


def plain_kept_lines(texts):
    """Line dedup in plain Python: the text that stays, by text."""
    def tokens(line):
        return tuple("<*>" if re.search("[0-9]", t) else t for t in re.split(r"[ \t\r\f\x0b]+", line) if t)

    lines = {t: [tokens(x) for x in t.split("\n")] for t in set(texts) - {None}}
    held = defaultdict(set)
    for t, xs in lines.items():
        for x in xs:
            if any(w != "<*>" for w in x):
                held[x].add(t)
    leaves = defaultdict(list)
    for x in held:
        leaves[len(x), x[:linededup.DEPTH]].append(x)
    gone = {x for x, ts in held.items() if len(ts) >= linededup.MIN_DOCS}
    for xs in leaves.values():
        if len(xs) < 2 or sum(len(held[x]) for x in xs) < linededup.MIN_DOCS:
            continue
        total, template = sum(len(held[x]) for x in xs), []
        for at in range(len(xs[0])):
            votes = Counter()
            for x in xs:
                votes[x[at]] += len(held[x])
            top, n = max(votes.items(), key=lambda v: (v[1], v[0]))
            template.append(top if 2 * n > total else "<*>")
        fits = [x for x in xs if linededup.SIMILAR[1] * sum(a == b != "<*>" for a, b in zip(x, template)) >= linededup.SIMILAR[0] * len(x)]
        if len(set().union(*(held[x] for x in fits))) >= linededup.MIN_DOCS:
            gone |= set(fits)
    out = {None: None}
    for t, xs in lines.items():
        n, dropped = sum(map(len, xs)), sum(len(x) for x in xs if x in gone)
        out[t] = t if 2 * dropped > n else "\n".join(line for line, x in zip(t.split("\n"), xs) if x not in gone)
    return out


def test_run_equals_the_plain_chain(spark):
    got = p.run(spark, SF).collect()
    docs, labels = read(spark, SF, "documents"), quality.graded(read(spark, SF, "labels"))
    items = [(r.item_id, r.text) for r in read(spark, SF, "benchmark").collect()]

    scored = quality.score(docs, quality.fit(docs, labels)).select("doc_id", "text", "tail_probability").collect()
    rows = [(r.doc_id, r.text) for r in scored if r.tail_probability >= quality.KEEP_AT]
    assert 0 < len(rows) < len(scored)

    kept = plain_kept_lines([t for _, t in rows])
    rows = [(d, kept[t]) for d, t in rows]

    first = brute(rows, 5, 80, 100)
    rows = [(d, t) for d, t in rows if first[d][1] == d]

    leaked = set()
    for d, t in rows:
        y = decontam.normal(t)
        for _, item in items:
            x = decontam.normal(item)
            k = int(len(x) * decontam.ERROR_RATE)
            cuts = [len(x) * j // (k + 1) for j in range(k + 2)]
            if not x or not any(x[a:b] in y for a, b in zip(cuts, cuts[1:])):
                continue
            if x in y or least(x, y) <= k:
                leaked.add(d)
                break
    rows = [(d, t) for d, t in rows if d not in leaked]
    assert rows and leaked

    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    want = {d: len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for d, t in rows}
    lengths, spots = defaultdict(int), defaultdict(list)
    for r in got:
        lengths[r.doc_id] += r.length
        spots[r.sequence_id].append((r.offset, r.length))
    assert lengths == want
    for s in spots.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY


def test_stages_keep_columns_and_clean_documents(spark):
    docs = read(spark, SF, "documents")
    for name, stage in p.STAGES[1:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
    clean = spark.createDataFrame(
        [(n, " ".join(f"w{n}q{i}" for i in range(60)), "en", "s", 1) for n in range(20)], docs.select("doc_id", "text", "lang", "source", "n_chars").schema)
    for name, stage in p.STAGES[1:-1]:
        assert sorted(r.doc_id for r in stage(spark, clean, SF).collect()) == list(range(20)), name
    assert p.pack(spark, clean.limit(0), SF).count() == 0


def test_empty_and_null_rows(spark):
    docs = read(spark, SF, "documents")
    odd = docs.limit(3).withColumns({c: F.lit(None).cast(docs.schema[c].dataType) for c in docs.columns})
    for name, stage in p.STAGES[1:-1]:
        assert stage(spark, odd, SF).count() == 3, name
        assert stage(spark, odd.limit(0), SF).count() == 0, name
