"""Hand-made rows the driver tables lack (FIXTURES.md) and source/sink round trips."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from qaflow.operators import chunk, metrics, prep, retrieve, vectors
from qaflow.sources import readers, writers


def _tmp():
    return tempfile.mkdtemp(prefix="qaflow-test-")


def test_kb_tsv_and_split(spark):
    d = _tmp()
    p = os.path.join(d, "kb.csv")
    w1 = " ".join(f"alpha{i}" for i in range(292))
    w2 = " ".join(f'be"ta{i}' if i == 5 else f"beta{i}" for i in range(296))
    with open(p, "w") as f:  # headerless TSV, quoted title with quotes inside, no final newline
        f.write(f"Aaron\t{w1}\n")
        f.write('"""Pokémon"""\t"' + w2.replace('"', '""') + '"')
    kb = readers.read_kb_tsv(spark, p).withColumn("doc_id", F.monotonically_increasing_id())
    rows = kb.orderBy("doc_id").collect()
    assert [r.title for r in rows] == ["Aaron", '"Pokémon"']
    assert len(rows[1].text.split(" ")) == 296 and 'be"ta5' in rows[1].text
    P = chunk.split_passages(kb, 100).orderBy("doc_id", "idx").collect()
    assert [len(r.text.split(" ")) for r in P] == [100, 100, 92, 100, 100, 96]


def test_null_text_and_title(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "t", None), (3, "t", ""), (4, "t", "   ")],
                               "doc_id long, title string, text string")
    P = chunk.split_passages(df, 100).orderBy("doc_id").collect()
    assert [(r.doc_id, r.title, r.text) for r in P] == [(1, "", "x"), (3, "t", ""), (4, "t", "")]


def test_gold_fallback_empty_aliases(spark):
    df = spark.createDataFrame([([], "v"), (["a1", "a2"], "v"), (None, "w")],
                               "aliases array<string>, value string")
    got = [list(r[0]) for r in df.select(prep.gold_list(F.struct("aliases", "value"))).collect()]
    assert got == [["v"], ["a1", "a2"], ["w"]]


def test_parallel_lines_final_newline(spark):
    d = _tmp()
    with open(os.path.join(d, "test.source"), "w") as f:
        f.write("q1\nq2\nq3\n")
    with open(os.path.join(d, "test.target"), "w") as f:
        f.write("a1\na2\na3\n")
    pairs, unmatched = readers.read_parallel_lines(spark, f"{d}/test.source", f"{d}/test.target")
    assert pairs.count() == 3 and unmatched.count() == 0


def test_parallel_lines_mismatch_reported(spark):
    d = _tmp()
    with open(os.path.join(d, "a.source"), "w") as f:
        f.write("q1\nq2\nq3")
    with open(os.path.join(d, "a.target"), "w") as f:
        f.write("a1\na2")
    pairs, unmatched = readers.read_parallel_lines(spark, f"{d}/a.source", f"{d}/a.target")
    assert pairs.count() == 2 and unmatched.count() == 1


def test_gold_qa_mode_apostrophe(spark):
    d = _tmp()
    p = os.path.join(d, "gold.tsv")
    with open(p, "w") as f:
        f.write("q1\t['one', 'two']\nq2\t[\"it's\"]\nq3\t['x\\'y']\n")
    gold, bad = readers.read_gold(spark, p, "qa")
    g = {r.line_no: list(r.golds) for r in gold.collect()}
    assert g[0] == ["one", "two"] and g[1] == ["it's"]
    assert gold.count() + bad.count() == 3


def test_gold_literal_writer(spark):
    df = spark.createDataFrame([(["it's", "b"],)], "g array<string>")
    assert df.select(writers.gold_literal("g")).first()[0] == "[\"it's\", 'b']"


def test_empty_prediction_scores(spark):
    df = spark.createDataFrame([("", ["x"]), ("x", [""])], "prediction string, golds array<string>")
    rows = metrics.score_answers(df).collect()
    assert rows[0].em == 0 and rows[0].f1 == 0.0
    assert rows[1].em == 0 and rows[1].f1 == 0.0


def test_answer_containment_empty_gold(spark):
    hits = spark.createDataFrame([(1, 1, "Some Text")], "item_id long, rank int, text string")
    qs = spark.createDataFrame([(1, [""]), (2, ["zzz"])], "item_id long, golds array<string>")
    got = {r.item_id: r.hit for r in retrieve.answer_containment(hits, qs).collect()}
    assert got == {1: 1, 2: 0}


def test_topk_k_larger_than_candidates_and_ties(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0])], "q_id long, v array<double>")
    c = spark.createDataFrame([(10, [1.0, 0.0]), (11, [1.0, 0.0]), (12, [0.0, 1.0]), (13, [0.0, 0.0])],
                              "c_id long, w array<double>")
    for force in (False, True):
        hits = vectors.exact_topk(q, c, 10, q_id="q_id", q_vec="v", c_id="c_id", c_vec="w",
                                  force_blocks=force, corpus_block=2, query_block=1)
        rows = sorted((r.q_id, r.rank, r.c_id, r.score) for r in hits.collect())
        assert [r for r in rows if r[0] == 1] == [(1, 1, 10, 1.0), (1, 2, 11, 1.0), (1, 3, 12, 0.0), (1, 4, 13, 0.0)]
        # zero query vector: all ties, ordered by id
        assert [r[2] for r in rows if r[0] == 2] == [10, 11, 12, 13]


def test_duplicate_and_zero_vectors_normalize(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([3.0, 4.0],)], "v array<double>")
    got = [list(r[0]) for r in df.select(vectors.l2_normalize("v")).collect()]
    assert got == [[0.0, 0.0], [0.6, 0.8]]


def test_precision_at_k_sets(spark):
    df = spark.createDataFrame([(["a", "a", "b", "c"], ["a", "c", "z"])], "h array<string>, r array<string>")
    assert df.select(metrics.precision_at_k("h", "r", 3)).first()[0] == pytest.approx(1 / 3)


def test_read_corpus_subset_and_qa_split(spark):
    d = _tmp()
    corpus = spark.createDataFrame([(1, "a", "2022"), (2, "b", "2023")], "doc_id long, text string, subset string")
    corpus.write.partitionBy("subset").parquet(f"{d}/corpus")
    got = readers.read_corpus(spark, f"{d}/corpus", "2023")
    assert [r.doc_id for r in got.collect()] == [2]
    assert "PartitionFilters: [isnotnull(subset" in got._jdf.queryExecution().executedPlan().toString()
    qa = spark.createDataFrame([("q2", (["x"], "x"), "train"), ("q1", ([], "y"), "train"), ("q3", (["z"], "z"), "val")],
                               "question string, answer struct<aliases: array<string>, value: string>, split string")
    qa.write.json(f"{d}/qa")
    tr = readers.read_qa(spark, f"{d}/qa", "train", max_samples=1, fmt="json")
    assert [r.question for r in tr.collect()] == ["q1"]
    golds = tr.select(prep.gold_list("answer").alias("g")).first().g
    assert list(golds) == ["y"]


def test_read_jsonl_head_and_shard_check(spark):
    d = _tmp()
    spark.createDataFrame([("b", "x", ["c1"]), ("a", "y", [])], "question string, answer string, contexts array<string>") \
        .write.json(f"{d}/j")
    assert [r.question for r in readers.read_jsonl(spark, f"{d}/j", max_samples=1, order="question").collect()] == ["a"]
    e = spark.createDataFrame([(0, 1), (1, 2)], "shard int, pos long")
    m_ok = spark.createDataFrame([(0, 1), (1, 5)], "shard int, pos long")
    m_bad = spark.createDataFrame([(0, 1), (2, 5)], "shard int, pos long")
    assert readers.shard_counts_match(e, m_ok) and not readers.shard_counts_match(e, m_bad)


def test_preretrieved_with_scores(spark):
    qs = spark.createDataFrame([(1, "q", ["g1", "g2"])], "item_id long, question string, golds array<string>")
    hits = spark.createDataFrame([(1, 2, "second", 0.5), (1, 1, "first", 0.9)],
                                 "item_id long, rank int, text string, score double")
    plain = writers.preretrieved_records(qs, hits).first()
    assert plain.answer == "g1" and list(plain.contexts) == ["first", "second"]
    scored = writers.preretrieved_records(qs, hits, with_scores=True).first()
    assert [(c.text, c.score) for c in scored.contexts] == [("first", 0.9), ("second", 0.5)]
