import pytest

from qaflow.llm import linededup as l
from tests.llm.oracle import same


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_equals_sql(spark, sf):
    assert same(spark, l.query, l.SQL, f"/root/testdata/{sf}", ["documents"]) > 0


def own(i):
    return "\n".join(f"unique{chr(97 + i % 26)} text{chr(97 + j)} only here {'abcdefghij'[i % 10] * (i + 1)}{j * 'z'} and more words" for j in range(4))


CASES = [(i, f"{own(i)}\nUser {i} logged in from host{i}.example at noon {'today' if i % 4 else 'yesterday'}\n{own(i + 40)}", "k") for i in range(12)]
CASES += [(100 + i, "shared boilerplate\nUser 9 logged in from hostA9 at noon today", "copy") for i in range(30)]
CASES += [(200 + i, f"Read more here\n\n{own(60 + i)}\n \t\nRead more here", "b") for i in range(6)]
CASES += [(300 + i, f"{own(80 + i)}\n{i} {i + 1} {i + 2}", "n") for i in range(8)]
CASES += [(400, None, "x"), (401, "", "x"), (402, "\n\n", "x"), (None, own(99) + "\nRead more here", "x"), (None, own(99) + "\nRead more here", "x"),
          (403, "lone " * 200_000 + "\nRead more here", "x"), (404, "Read more here", "x"), (405, "q" * 500_000 + "1 x", "x")]


def test_cases_equal_sql_and_meaning(spark, tmp_path):
    df = spark.createDataFrame([(*c, 7) for c in CASES], "doc_id long, text string, source string, n_lines int")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    assert same(spark, l.query, l.SQL, str(tmp_path), ["documents"]) == len(CASES)
    got = {r.doc_id: r for r in l.drop_templates(df).collect()}
    assert all("logged" not in got[i].text and got[i].text == f"{own(i)}\n{own(i + 40)}" for i in range(12))
    assert got[103].text == CASES[12][1] and got[404].text == "Read more here"
    assert got[200].text == f"\n{own(60)}\n \t" and got[200].n_dropped == 2 and got[None].text == own(99)
    assert got[301].text == CASES[49][1] and got[400].text is None and got[401].text == "" and got[402].n_lines == 3
    assert l.drop_templates(df).columns == ["doc_id", "text", "source", "n_lines", "n_dropped"]


def test_empty_table(spark):
    assert l.drop_templates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_no_python_in_the_plans(spark):
    lines = l._lines(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), "text")
    plan = l.drop_templates(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(w in plan + lines._jdf.queryExecution().toString() for w in ("Python", "Arrow", "Pandas"))


def test_columns_of_the_names_used_inside(spark):
    df = spark.createDataFrame([(i, f"{own(i)}\nRead more here", i, "x", 2) for i in range(6)], "doc_id long, text string, copy int, drop string, Copy_ int")
    got = sorted(tuple(r) for r in l.drop_templates(df).collect())
    assert got == [(i, own(i), i, "x", 2, 5, 1) for i in range(6)]


def test_lines_are_spelled_out_in_one_place(spark, tmp_path, monkeypatch):
    """A line that stands in many documents is cut into tokens again in one of them, with places sent or shuffled."""
    docs = spark.createDataFrame([(i, f"{own(i)}\nUser {i % 2}x of {'a' if i % 3 else 'b'} logged in at noon today\n{own(i + 40)}", "k") for i in range(12)], "doc_id long, text string, source string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spelled, cut = [], l._with_tokens
    monkeypatch.setattr(l, "_with_tokens", lambda raw: spelled.append(raw) or cut(raw))
    for most in (l.BROADCAST_ROWS, 0):
        monkeypatch.setattr(l, "BROADCAST_ROWS", most)
        assert same(spark, l.query, l.SQL, str(tmp_path), ["documents"]) == 12
    every, again = (x.count() for x in spelled[:2])
    assert (every, again) == (12 * 9, 2)
