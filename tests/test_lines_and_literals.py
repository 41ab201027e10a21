"""Positional line files, escaped line sinks and list literals."""

import ast

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from qaflow.functions import literals
from qaflow.sources import readers, writers


def lines(spark, path, **kw):
    return [r["value"] for r in readers.read_lines(spark, str(path), **kw).orderBy("line_no").collect()]


def test_one_large_file_is_read_by_many_tasks_in_order(spark, tmp_path):
    want = [f"{i} {'x' * (i * 7 % 190)}" for i in range(6000)]
    (tmp_path / "big.txt").write_text("\n".join(want))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = readers.read_lines(spark, str(tmp_path / "big.txt"))
        assert got.rdd.getNumPartitions() > 10
        assert [(r["line_no"], r["value"]) for r in got.orderBy("line_no").collect()] == list(enumerate(want))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("text", ["", "a", "a\n", "a\n\n", "\n", "a\r\nb\rc\n\r\nd", "a\\nb\n\\\\", "\r"])
def test_lines_as_python_reads_them(spark, tmp_path, text):
    (tmp_path / "f.txt").write_bytes(text.encode())
    with open(tmp_path / "f.txt") as f:
        assert lines(spark, tmp_path / "f.txt") == [x.rstrip("\n") for x in f.readlines()]


def test_files_follow_their_names(spark, tmp_path):
    for name, text in (("b", "3\n4"), ("a", "1\n2\n"), ("c", ""), ("d", "5\n")):
        (tmp_path / f"{name}.txt").write_text(text)
    assert lines(spark, tmp_path) == ["1", "2", "3", "4", "5"]


ODD = ["a\nb", "c\r\nd", "\\n", "\\", "\n", "", None, "e\\\\\nf", "plain", "tab\there", "  x", "'\"", "é🙂"]


def test_values_with_line_breaks_survive(spark, tmp_path):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ODD)], "line_no long, prediction string")
    writers.write_predictions(df, str(tmp_path / "p"), recalculate=True)
    assert lines(spark, tmp_path / "p", escaped=True) == [x or "" for x in ODD]
    pairs = df.select(F.lit("t").alias("split"), "line_no", F.col("prediction").alias("source"), F.reverse("prediction").alias("target"))
    writers.write_parallel_lines(pairs, str(tmp_path / "q"), "line_no")
    got, rest = readers.read_parallel_lines(spark, *writers.line_file_paths(str(tmp_path / "q"), "t"), escaped=True)
    assert [(r["source"], r["target"]) for r in got.orderBy("line_no").collect()] == [(x or "", (x or "")[::-1]) for x in ODD]
    assert rest.count() == 0


LITERALS = [r"['a', 'b']", r'["it\'s", "x"]', r"['say \"hi\"']", r"""['a\\', "b\n\t\x41é\U0001F642\101"]""", "[]", "[ ]", "['a',]", "[ 'a' , \"b\" ]", r"['\d\q']", "['a' 'b', 'c' \"d\"]", "['']",
            "['a, b', ']']", "['['] ", r"['\'']"]
BAD = ["['a'", "'a'", "[1]", "['a' , , 'b']", "[['a']]", "", "['a'] x", "[a]", "['a\nb']", "[,]", "['a\\']"]


def test_literals_as_python_reads_them(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(LITERALS + BAD)], "i int, x string").select("i", literals.parse_list("x").alias("v"))
    got = [r["v"] for r in df.orderBy("i").collect()]
    assert got[:len(LITERALS)] == [ast.literal_eval(x.strip()) for x in LITERALS]
    assert got[len(LITERALS):] == [None] * len(BAD)


def test_long_literals(spark):
    long = ["a'\"\\" * 20_000, "b" * 300_000] + ["c"] * 3000
    df = spark.createDataFrame([(repr(long),)], "x string")
    assert df.select(literals.parse_list("x").alias("v")).first()["v"] == long


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text("ab'\"\\\n\r\té🙂[], ", max_size=12), max_size=4))
def test_written_literals_mean_the_same_to_python(values):
    from pyspark.sql import SparkSession

    df = SparkSession.getActiveSession().createDataFrame([(values,)], "v array<string>").select(literals.list_literal("v").alias("x"))
    row = df.select("x", literals.parse_list("x").alias("back"), literals.unescape_line(literals.escape_line("x")).alias("line")).first()
    assert ast.literal_eval(row["x"]) == values == row["back"] and row["line"] == row["x"]


def test_gold_file_with_quarantine(spark, tmp_path):
    (tmp_path / "gold.tsv").write_text("who\t['a', \"it's\"]\nbad\t['open\n\"quoted\tq\"\t\"['x', \"\"y's\"\"]\"\nnone\nlast\t[]")
    good, bad = readers.read_gold(spark, str(tmp_path / "gold.tsv"), "qa")
    assert [(r["line_no"], r["golds"]) for r in good.orderBy("line_no").collect()] == [(0, ["a", "it's"]), (2, ["x", "y's"]), (4, [])]
    assert [r["line_no"] for r in bad.orderBy("line_no").collect()] == [1, 3]
