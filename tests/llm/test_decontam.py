from hypothesis import given, settings
from hypothesis import strategies as st

from qaflow.llm import decontam as d

SF = "/root/testdata/sf0.001"
ITEMS = "item_id long, text string"
DOCS = "doc_id long, text string, leaks int"


def least(pattern, text):
    """Least edit distance of the pattern to any stretch, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


words = st.lists(st.sampled_from(["ab", "abc", "b", "cab", "é1", "x_y", "AB", "a-b"]), min_size=1, max_size=12)


@settings(max_examples=300, deadline=None)
@given(st.lists(words.map(" ".join), min_size=1, max_size=3), st.lists(words.map("\n".join) | st.just("!?"), max_size=5).map(" ".join), st.sampled_from([0.0, 0.1, 0.2, 0.34]))
def test_search_equals_the_plain_table(items, text, rate):
    got = {i: (dist, a, b) for i, dist, a, b in d.Matcher(list(enumerate(items)), rate).search(text)}
    for i, item in enumerate(items):
        x, y = d.normal(item), d.normal(text)
        want = least(x, y) if x and y else None
        if want is not None and want <= int(len(x) * rate) and want < len(x):
            assert got[i][0] == want and least(x, f" {d.normal(text[got[i][1]:got[i][2]])} ") == want
        else:
            assert i not in got


def edited(text):
    w = text.split()
    w[len(w) // 3] = w[len(w) // 3][:-1] + "#q"
    return "  ".join([*w[:5], w[5].upper(), *w[6:]]) + "!"


def test_planted_items_and_defined_cases(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    long = [x for x in items if len(x[1].split()) > 20][:6]
    clean = "the quick brown fox jumps over the lazy dog " * 5
    docs = [(n, f"{clean}\n{edited(t)}\n{clean}", 0) for n, (_, t) in enumerate(long)]
    docs += [(100, None, 0), (101, "", 0), (102, clean * 2000, 1), (None, clean + long[0][1], 1), (7, long[1][1], 2), (7, long[1][1], 2)]
    bench = spark.createDataFrame([*items, (900, None), (901, "?! _"), (902, long[0][1])], ITEMS)
    one = sorted((str(r.doc_id), tuple(map(tuple, r.leaks))) for r in d.find_leaks(spark.createDataFrame(docs, DOCS), bench).collect())
    two = sorted((str(r.doc_id), tuple(sorted(map(tuple, r.leaks)))) for r in d.find_leaks(spark.createDataFrame(docs, DOCS), bench, block_items=7).collect())
    assert one == two and len(one) == len(docs)
    by = dict(one)
    for n, (item, _) in enumerate(long):
        assert item in {x[0] for x in by[str(n)]}
    assert {x[0] for x in by["None"]} == {long[0][0], 902} and by["100"] == by["101"] == by["102"] == ()
    df = spark.createDataFrame(docs, DOCS)
    assert d.find_leaks(df, bench.limit(0)).where("size(leaks) > 0").count() == 0 and d.find_leaks(df.limit(0), bench).count() == 0


def test_columns_of_the_names_used_inside(spark):
    from qaflow.llm import decontam

    docs = spark.createDataFrame([(1, "nothing here", 5)], "doc_id long, text string, searched int")
    items = spark.createDataFrame([(1, "an item that no document holds at all, whatever its length")], "item_id long, text string")
    assert decontam.find_leaks(docs, items).first()["searched"] == 5
