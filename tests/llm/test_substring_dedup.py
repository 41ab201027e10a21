import random

from qaflow.llm import substring_dedup as s

SCHEMA = "doc_id long, text string, cluster int, start string, vertex int"


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    return {r.doc_id: r for r in s.document_removals(s.repeated_spans(df)).collect()}


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))


def test_planted_passages_are_found_and_clean_documents_left_alone(spark):
    passage, rows = prose(0, 60), []
    for i in range(40):
        a, b = prose(100 + i, 45), prose(900 + i, 45)
        rows.append((i, f"{a} {passage} {b}" if i % 4 == 0 else f"{a}\n{b}"))
    got = run(spark, rows)
    assert set(got) == set(range(0, 40, 4))
    assert got[0].removed_words == 0
    for i in range(4, 40, 4):
        assert 30 <= got[i].removed_words <= 60
        assert all(45 <= x.start < x.end <= 105 for x in got[i].spans)


def test_near_copies_of_a_line_form_one_cluster(spark):
    words = prose(5, 80).split()
    near = words[:40] + ["changed"] + words[41:]
    got = run(spark, [(3, "intro\n" + " ".join(words)), (7, " ".join(near)), (9, prose(6, 80)), (9, prose(6, 80))])
    assert set(got) == {3, 7} and got[3].removed_words == 0 and got[7].removed_words == 80


def test_defined_cases(spark):
    assert run(spark, []) == {}
    long = prose(8, 30_000)
    got = run(spark, [(1, None), (2, ""), (None, long), (4, long), (5, long), (6, "few words")])
    assert set(got) == {4, 5} and got[4].removed_words == 0 and got[5].removed_words == 30_000


def test_any_passage_of_32_words_holds_an_anchor():
    import pyarrow as pa

    for seed in range(300):
        passage = prose(seed, 32)
        texts = [f"{prose(1000 + seed, 40)} {passage} {prose(2000 + seed, 37)}", f"{passage} {prose(3000 + seed, 9)}", f"{prose(4000 + seed, 3)} {passage}"]
        [(_, _, words, rows, _)] = s._batches(pa.array(texts))
        row, e = s.anchor_spots(words, rows)
        assert set(e["key"][row == 0]) & set(e["key"][row == 1]) & set(e["key"][row == 2])


def test_exactly_the_planted_passages_go(spark):
    rows, want = [], {}
    for p, n in enumerate((32, 51, 64, 100, 200)):
        for k in range(6):
            passage, before = prose(50 * p + k, n), 20 + 7 * k
            part = " ".join(passage.split()[:n - 5])
            at = 100 * p + 10 * k
            rows += [(at, f"{prose(10_000 + at, 30)} {passage} {prose(20_000 + at, 44)}"), (at + 1, f"{prose(30_000 + at, before)} {passage} {prose(40_000 + at, 33)}"),
                     (at + 2, f"{prose(50_000 + at, 61)}\n{part} {prose(60_000 + at, 50)}"), (at + 3, f"{passage}\n{prose(70_000 + at, 50)}")]
            want |= {at: (0, 30, 30 + n), at + 1: (n, before, before + n), at + 2: (n - 5 if n > 36 else None, 61, 61 + n - 5), at + 3: (n, 0, n)}
    got = run(spark, rows)
    for d, (removed, a, b) in want.items():
        if removed is not None:
            assert got[d].removed_words == removed and all(a <= x.start < x.end <= b for x in got[d].spans), (d, got[d])
            assert [(x.start, x.end) for x in got[d].spans if x.removed == (removed > 0)] == [(a, b)], (d, got[d])


def test_near_copies_of_a_short_line(spark):
    words = prose(11, 19).split()
    lines = [" ".join(words), " ".join([*words[:-1], "other"])]
    got = run(spark, [(i, f"{prose(20 + i, 40)}\n{x}\n{prose(30 + i, 40)}") for i, x in enumerate(lines)])
    assert got[0].removed_words == 0 and got[1].removed_words == 19


def test_short_chance_repeats_stay_where_a_least_length_is_asked(spark):
    rows = []
    for i in range(12):
        short = prose(1, 33) if i % 3 == 0 else prose(500 + i, 33)
        long = prose(2, 51) if i % 2 == 0 else prose(600 + i, 51)
        rows.append((i, f"{prose(700 + i, 40)} {short} {prose(800 + i, 40)}\n{long}\n{prose(900 + i, 30)}"))
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    got = {r.doc_id: r for r in s.document_removals(s.repeated_spans(df, 50), 50).collect()}
    assert set(got) == {0, 2, 4, 6, 8, 10}
    assert all([(x.start, x.end) for x in r.spans] == [(113, 164)] and r.removed_words == (51 if d else 0) for d, r in got.items())
    assert set(run(spark, rows)) == {0, 2, 3, 4, 6, 8, 9, 10}


def test_stretches_and_removals_equal_plain_python(spark):
    import random

    rng = random.Random(3)
    rows = [(rng.choice([-(1 << 63), -5, 0, 3, (1 << 63) - 1]), rng.randrange(300), rng.randrange(1, 12), rng.randrange(-4, 4), rng.choice(s.KINDS)) for _ in range(400)]
    spots = spark.createDataFrame(rows + rows[:50], "doc_id long, start int, words int, cluster long, kind string")

    def merged(spans):
        out = []
        for r in sorted(spans, key=lambda r: (r[1], r[1] + r[2])):
            if out and r[1] <= max(x[1] + x[2] for x in out[-1]):
                out[-1].append(r)
            else:
                out.append([r])
        return [(g, min(x[1] for x in g), max(x[1] + x[2] for x in g)) for g in out]

    want = {r for d in {r[0] for r in rows} for g, a, b in merged({r for r in rows if r[0] == d}) if b - a >= 20 for r in g}
    got = s.in_long_stretches(spots, 20).collect()
    assert sorted((r.doc_id, r.start, r.words, r.cluster, s.KINDS[r.kind]) for r in got) == sorted(want)
    least = {}
    for d, a, _, c, k in sorted(want):
        least.setdefault((d, c, k), a)
    assert all(r.lead == (r.start == least[r.doc_id, r.cluster, s.KINDS[r.kind]]) for r in got)

    flagged = [(*r[:4], rng.random() < 0.5) for r in rows]
    out = {r.doc_id: r for r in s.document_removals(spark.createDataFrame(flagged, "doc_id long, start int, words int, cluster long, removed boolean"), 15).collect()}
    for d in {r[0] for r in rows}:
        parts = [(a, b, gone, min(x[3] for x in g)) for gone in (False, True) for g, a, b in merged([r for r in flagged if r[0] == d and r[4] == gone]) if b - a >= 15]
        assert ([tuple(x) for x in out[d].spans] if parts else d not in out) == (sorted(p[:3] for p in parts) or True)
        if parts:
            assert (out[d].cluster, out[d].removed_words) == (min(p[3] for p in parts), sum(b - a for a, b, gone, _ in parts if gone))
