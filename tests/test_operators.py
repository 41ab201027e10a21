"""Layers 2-3: operators against DuckDB at sf0.001 and properties."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from qaflow.operators import retrieve, split, vectors
from qaflow.plans import catalog
from qaflow.plans.oracles import ORACLES
from tests.conftest import SF_SMALL

FAST = ["passages_100w", "sliding_chunks_100_20", "dense_passage_ids", "shards_floor_7", "shards_balanced_7",
        "split_80_10_10", "qa_pairs", "em_f1_bag", "normalize_b", "exact_top15", "ivf_top15_probe3",
        "hash_encode", "retrieve_top15", "recall_at_15", "rerank_6", "answers_base", "encode_pad_trim",
        "parse_scores", "best_checkpoint", "gold_literal_roundtrip"]


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple(round(v, 6) if isinstance(v, float) else v for v in r))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["documents", "benchmark", "embeddings", "conversations", "labels", "events"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_against_duckdb(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    order = sorted(df.columns)
    s = _norm(tuple(r[c] for c in order) for r in df.collect())
    di = [dcols.index(c) for c in order]
    d = _norm(tuple(r[i] for i in di) for r in res.fetchall())
    assert s == d


def test_every_query_has_callable_and_most_have_oracles():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    core = {k[2:] for k, f in vars(catalog).items() if k.startswith("q_") and callable(f)}
    assert core <= set(q) and set(ORACLES) <= core
    assert len(ORACLES) >= len(core) - 8


def test_ivf_full_probe_equals_exact(spark):
    e = catalog.table(spark, SF_SMALL, "embeddings")
    cents = vectors.label_mean_centroids(e, "label", "embedding")
    nlist = cents.count()
    postings = vectors.assign_cells(e.select("vec_id", "embedding"), cents, "embedding")
    kw = dict(q_id="vec_id", q_vec="embedding", c_id="vec_id", c_vec="embedding")
    ivf = vectors.ivf_topk(e, postings, cents, 15, nlist, **kw)
    exact = vectors.exact_topk(e, e, 15, **kw)
    assert vectors.ann_recall(ivf, exact, 15).first()["recall"] == pytest.approx(1.0)


def test_block_path_equals_broadcast_path(spark):
    e = catalog.table(spark, SF_SMALL, "embeddings")
    kw = dict(q_id="vec_id", q_vec="embedding", c_id="vec_id", c_vec="embedding")
    a = vectors.exact_topk(e, e, 7, **kw)
    b = vectors.exact_topk(e, e, 7, force_blocks=True, query_block=64, corpus_block=100, **kw)
    ra = sorted((r.q_id, r.rank, r.c_id) for r in a.collect())
    rb = sorted((r.q_id, r.rank, r.c_id) for r in b.collect())
    assert ra == rb


def test_lsh_scores_are_exact(spark):
    e = catalog.table(spark, SF_SMALL, "embeddings")
    kw = dict(q_id="vec_id", q_vec="embedding", c_id="vec_id", c_vec="embedding")
    approx = vectors.lsh_topk(e, e, 15, tables=4, bits=3, **kw)
    j = approx.join(e.select(F.col("vec_id").alias("q_id"), F.col("embedding").alias("qv")), "q_id") \
        .join(e.select(F.col("vec_id").alias("c_id"), F.col("embedding").alias("cv")), "c_id")
    bad = j.where(F.abs(F.round(vectors.dot("qv", "cv"), 6) - F.round("score", 6)) > 1e-6).count()
    assert bad == 0
    r = vectors.ann_recall(approx, vectors.exact_topk(e, e, 15, **kw), 15).first()["recall"]
    assert 0 <= r <= 1


def test_shards_partition_input(spark):
    docs = catalog.table(spark, SF_SMALL, "documents").select("doc_id")
    n = docs.count()
    pos = split.dense_ids(docs, ["doc_id"])
    for rule in (split.floor_shards, split.balanced_shards):
        sizes = [r[1] for r in pos.groupBy(rule("pos", n, 7).alias("s")).count().orderBy("s").collect()]
        assert sum(sizes) == n and len(sizes) == 7
    assert [r[0] for r in pos.orderBy("pos").select("pos").collect()] == list(range(n))


def test_dense_ids_beyond_the_range_sample(spark):
    rows = spark.range(400_000).select(F.pmod(F.xxhash64("id"), F.lit(10**12)).alias("k"), "id", F.concat(F.lit("payload "), "id").alias("text"))
    for parts in (3, 64):
        pos = split.dense_ids(rows, ["k", "id"], num_partitions=parts)
        got = pos.agg(F.count_distinct("pos").alias("n"), F.min("pos").alias("lo"), F.max("pos").alias("hi")).first()
        assert tuple(got) == (400_000, 0, 399_999)
        assert pos.alias("a").join(pos.alias("b"), F.expr("b.pos = a.pos + 1")).where("struct(b.k, b.id) < struct(a.k, a.id)").isEmpty()


def test_seeded_split_sizes(spark):
    b = catalog.table(spark, SF_SMALL, "benchmark").select("item_id")
    n = b.count()
    s = {r[0]: r[1] for r in split.seeded_split(b, "item_id", 0.8, 42).groupBy("split").count().collect()}
    assert s["train"] == int(n * 0.8) and s["val"] == (n - int(n * 0.8)) // 2
    assert sum(s.values()) == n


def test_entry_runs(spark):
    out = E.entry(spark).collect()
    assert len(out) == 1 and out[0]["n"] > 0


def test_ivf_and_lsh_block_paths_split_hot_groups(spark):
    e = catalog.table(spark, SF_SMALL, "embeddings")
    kw = dict(q_id="vec_id", q_vec="embedding", c_id="vec_id", c_vec="embedding")
    cents = vectors.label_mean_centroids(e, "label", "embedding")
    postings = vectors.assign_cells(e.select("vec_id", "embedding"), cents, "embedding", key="vec_id")
    a = vectors.ivf_topk(e, postings, cents, 10, 2, **kw)
    # tiny blocks: every cell is "hot" and split into many (query, corpus) sub-blocks
    b = vectors.ivf_topk(e, postings, cents, 10, 2, force_blocks=True, query_block=16, corpus_block=8, **kw)
    assert sorted((r.q_id, r.rank, r.c_id) for r in a.collect()) == \
        sorted((r.q_id, r.rank, r.c_id) for r in b.collect())
    la = vectors.lsh_topk(e, e, 10, tables=4, bits=3, **kw)
    lb = vectors.lsh_topk(e, e, 10, tables=4, bits=3, force_blocks=True, query_block=32, corpus_block=16, **kw)
    assert sorted((r.q_id, r.rank, r.c_id) for r in la.collect()) == \
        sorted((r.q_id, r.rank, r.c_id) for r in lb.collect())


def test_kmeans_ivf_recall_full_probe_is_exact(spark):
    rows = {r.nprobe: r.recall for r in E.queries()["kmeans_ivf_recall"](spark, SF_SMALL).collect()}
    assert set(rows) == {1, 4, 16}
    assert rows[16] == pytest.approx(1.0)
    assert 0 <= rows[1] <= rows[4] <= rows[16]


def test_benchmark_questions_lose_no_word(spark):
    b = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    odd = spark.createDataFrame([(900, "one"), (901, ""), (902, None), (903, "a b. c  d\ne"), (904, " lead and trail ")], b.schema)
    rows = retrieve.benchmark_questions(b.union(odd)).join(b.union(odd), "item_id").collect()
    for r in rows:
        if r["text"] is not None:
            assert (r["question"] + " " + r["answer"]["value"]).split() == r["text"].split()
            assert r["golds"][0] == r["answer"]["value"] or not r["answer"]["value"]


def test_quoted_items_are_right_answers(spark):
    got = catalog.q_answers_base(spark, "/root/testdata/sf0.01").agg(F.sum("em").alias("em"), F.sum("hit").alias("hit")).first()
    assert got["em"] > 0 and got["hit"] > 0


def test_passage_keys_never_collide_silently(spark):
    ok = spark.createDataFrame([(1, 999_999), (2, 0), (None, 3)], "doc_id long, idx int")
    assert [r["k"] for r in ok.select(retrieve.passage_key().alias("k")).collect()] == [1_999_999, 2_000_000, None]
    with pytest.raises(Exception, match="more than 1000000 parts"):
        spark.createDataFrame([(1, 1_000_000)], "doc_id long, idx int").select(retrieve.passage_key().alias("k")).collect()
