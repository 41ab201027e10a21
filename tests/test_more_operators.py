"""Operators without a registered query of their own."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from qaflow.operators import chunk, metrics, models, prep, retrieve, split, vectors
from qaflow.sources import readers, writers
from qaflow.streaming import refresh


def test_pair_by_position_strict(spark):
    a = spark.createDataFrame([(0, "x"), (1, "y"), (2, "z")], "line_no long, p string")
    b = spark.createDataFrame([(0, "X"), (1, "Y")], "line_no long, g string")
    paired, orphans = retrieve.pair_by_position(a, b, ("line_no",))
    assert paired.count() == 2 and orphans.count() == 1
    with pytest.raises(Exception):
        retrieve.pair_predictions(a, b, strict=True).collect()


def test_user_code_may_return_more_rows(spark):
    import pyarrow as pa

    def letters(batch):
        rows = [(d, c) for d, t in zip(*(batch.column(i).to_pylist() for i in (0, 1))) for c in t or ""]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], names=["doc_id", "letter"])

    df = spark.createDataFrame([(1, "ab"), (2, ""), (3, None), (4, "c")], "doc_id long, text string")
    got = models.explode_batches(df, letters, "doc_id long, letter string").collect()
    assert sorted((r.doc_id, r.letter) for r in got) == [(1, "a"), (1, "b"), (4, "c")]


def test_stream_on_a_built_index_loses_no_batch(spark):
    from qaflow import scratch_path
    from qaflow.streaming import refresh

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 60")
    base, inbox = scratch_path(spark, "t_built"), scratch_path(spark, "t_built_in")
    assert refresh.refresh_index(spark, base, docs.where("doc_id < 40"), nlist=2) == 1
    docs.where("doc_id >= 40").coalesce(1).write.parquet(inbox)
    first = scratch_path(spark, "t_built_c1")
    assert refresh.refresh_stream(spark, inbox, base, first, docs.schema, nlist=2) == 2
    _, live, _ = refresh.read_live(spark, base)
    assert live.select("doc_id").distinct().count() == docs.where("text is not null").count()
    batch = docs.where("doc_id >= 40")
    assert refresh.refresh_index(spark, base, batch, nlist=2, stream=first, epoch=0) == 2  # replayed
    assert refresh.refresh_index(spark, base, batch, nlist=2, stream="other", epoch=0) == 3


def test_encoder_change_encodes_every_passage_anew(spark):
    from qaflow import scratch_path
    from qaflow.sources import writers
    from qaflow.streaming import refresh

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 40")
    base = scratch_path(spark, "t_encoder")
    refresh.refresh_index(spark, base, docs, nlist=2)
    small = models.hash_encoder(8)
    refresh.refresh_index(spark, base, docs.where("doc_id < 3"), nlist=2, encoder=small, encoder_version="v2")
    _, live, cents = refresh.read_live(spark, base)
    assert [r[0] for r in live.select(F.size("embedding")).distinct().collect()] == [8]
    assert [r[0] for r in cents.select(F.size("centroid")).distinct().collect()] == [8]
    ptr = writers.current_pointer(spark, base)
    n = docs.where("text is not null").count()
    assert (ptr["version"], ptr["encoder"], ptr["n_docs"]) == (2, "v2", n) and live.select("doc_id").distinct().count() == n


def test_unreadable_pointer_raises(spark):
    from qaflow import scratch_path
    from qaflow.sources import writers

    base = scratch_path(spark, "t_pointer")
    assert writers.current_version(spark, base) is None
    spark.range(1).selectExpr("'x' AS value").write.text(f"{base}/_current")
    with pytest.raises(Exception):
        writers.current_version(spark, base)


def test_null_vectors_have_no_cell_and_no_bucket(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 2.0])], "id long, v array<double>")
    cents = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0])], "cell int, centroid array<double>")
    assert {r.id: r.cell for r in vectors.assign_cells(df, cents, "v").collect()} == {1: 0, 2: None, 3: 1}
    two = vectors.nearest_cells(df, cents, "v", 2, out="probe", as_list=True)
    assert {r.id: r.probe for r in two.collect()} == {1: [0, 1], 2: None, 3: [1, 2]}
    hits = vectors.lsh_topk(df, df, 1, q_id="id", q_vec="v", c_id="id", c_vec="v").collect()
    assert sorted((r.q_id, r.c_id) for r in hits) == [(1, 1), (3, 3)]


def test_mode_comparison_pivot(spark):
    s = spark.createDataFrame([("base", 0.5, 0.6, 0.7), ("rag", 0.1, 0.2, 0.0)],
                              "mode string, em double, f1 double, recall double")
    rows = {r.metric: (r.base, r.rag) for r in metrics.mode_comparison(s).collect()}
    assert rows == {"em": (0.5, 0.1), "f1": (0.6, 0.2), "recall": (0.7, 0.0)}


def test_metrics_history_append(spark):
    d = tempfile.mkdtemp(prefix="qaflow-hist-")
    m = spark.createDataFrame([("base", 0.5)], "mode string, em double")
    refresh.append_metrics_history(m, f"{d}/h", 1)
    refresh.append_metrics_history(m, f"{d}/h", 2)
    assert sorted(r.step for r in spark.read.json(f"{d}/h").collect()) == [1, 2]
    writers.write_metrics(m, f"{d}/k6")
    writers.write_metrics(m, f"{d}/k6")
    assert spark.read.json(f"{d}/k6").count() == 2


def test_shuffle_epoch_and_head_limit(spark):
    df = spark.range(20).withColumn("split", F.when(F.col("id") < 15, "train").otherwise("val"))
    e1 = split.shuffle_epoch(df, "id", 42, 1)
    e2 = split.shuffle_epoch(df, "id", 42, 2)
    o1 = [r.id for r in e1.where("split = 'train'").orderBy("order_key").collect()]
    o2 = [r.id for r in e2.where("split = 'train'").orderBy("order_key").collect()]
    assert sorted(o1) == sorted(o2) == list(range(15)) and o1 != o2
    val = [r.id for r in e1.where("split = 'val'").orderBy("order_key").collect()]
    assert val == list(range(15, 20))
    assert [r.id for r in prep.head_limit(df, 3, ["id"]).collect()] == [0, 1, 2]
    assert prep.head_limit(df, -1, ["id"]).count() == 20


def test_cast_vectors_checks_length(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "v array<double>")
    ok = vectors.cast_vectors(df.limit(1), "v", dim=2)
    assert ok.schema["v"].dataType.simpleString() == "array<float>" and ok.count() == 1
    with pytest.raises(Exception):
        vectors.cast_vectors(df, "v", dim=2).collect()


def test_versions_are_snapshots(spark):
    base = tempfile.mkdtemp(prefix="qaflow-ver-")
    docs = spark.createDataFrame([(1, "alpha beta gamma", "s1"), (2, "delta epsilon", "s2")],
                                 "doc_id long, text string, source string")
    v1 = refresh.refresh_index(spark, base, docs, nlist=2)
    upd = spark.createDataFrame([(2, "delta changed text here", "s2")], "doc_id long, text string, source string")
    v2 = refresh.refresh_index(spark, base, upd, nlist=2)
    assert (v1, v2) == (1, 2)
    old = spark.read.parquet(f"{base}/version=1/postings").where("doc_id = 2").first().text
    _, live, _ = refresh.read_live(spark, base)
    new = live.where("doc_id = 2").first().text
    assert old == "delta epsilon" and new == "delta changed text here" and live.count() == 2
    # re-applying an already published version is a no-op
    assert refresh.refresh_index(spark, base, upd, nlist=2, version=2) == 2


def test_micro_batch_last_short(spark):
    df = spark.range(70).withColumnRenamed("id", "pos")
    sizes = [r[1] for r in df.groupBy(split.micro_batch("pos", 32).alias("b")).count().orderBy("b").collect()]
    assert sizes == [32, 32, 6]


def test_cell_assignment_block_fallback_matches_broadcast(spark):
    from qaflow.plans import catalog
    from tests.conftest import SF_SMALL

    e = catalog.table(spark, SF_SMALL, "embeddings").select("vec_id", "embedding")
    cents = vectors.label_mean_centroids(catalog.table(spark, SF_SMALL, "embeddings"), "label", "embedding")
    a = vectors.assign_cells(e, cents, "embedding")
    b = vectors.assign_cells(e, cents, "embedding", max_bytes=0, key="vec_id")
    ra = sorted((r.vec_id, r.cell) for r in a.collect())
    rb = sorted((r.vec_id, r.cell) for r in b.collect())
    assert ra == rb
    p1 = vectors.nearest_cells(e, cents, "embedding", 3, normalize=False, out="probe")
    p2 = vectors.nearest_cells(e, cents, "embedding", 3, normalize=False, out="probe", max_bytes=0, key="vec_id")
    assert sorted((r.vec_id, tuple(r.probe)) for r in p1.collect()) == \
        sorted((r.vec_id, tuple(r.probe)) for r in p2.collect())


def test_encode_tokens_dict_and_join_paths_agree(spark):
    df = spark.createDataFrame([(1, ["b", "a", "zz", "a"]), (2, []), (3, None)], "k long, t array<string>")
    vocab = chunk.build_vocab(spark.createDataFrame([("a",), ("b",), ("c",)], "token string"))
    d = {r.k: r.ids for r in chunk.encode_tokens(df, "k", "t", vocab).collect()}
    j = {r.k: r.ids for r in chunk.encode_tokens(df, "k", "t", vocab, broadcast_max_rows=0).collect()}
    first = chunk.FIRST_WORD_ID
    assert list(d[1]) == [first + 1, first, chunk.UNK_ID, first] and list(d[2]) == []
    assert list(j[1]) == list(d[1]) and list(j[2]) == [] and list(d[3]) == list(j[3]) == []


def test_null_vectors_take_no_part(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "q_id long, v array<double>")
    c = spark.createDataFrame([(10, [1.0, 0.0]), (11, None)], "c_id long, w array<double>")
    for force in (False, True):
        rows = vectors.exact_topk(q, c, 5, q_id="q_id", q_vec="v", c_id="c_id", c_vec="w",
                                  force_blocks=force).collect()
        assert [(r.q_id, r.c_id) for r in rows] == [(1, 10)]


def test_stream_latest_update_wins_over_late_older_one(spark):
    import datetime as dt

    from qaflow import scratch_path

    schema = "doc_id long, text string, source string, ts timestamp"
    t = [dt.datetime(2026, 1, 1, 0, 0, i) for i in range(4)]
    inbox, base, ckpt = (scratch_path(spark, n) for n in ("t_inbox", "t_base", "t_ckpt"))
    batches = [
        [(1, "first text of one", "s", t[0]), (2, "two", "s", t[0]), (1, "newer text of one", "s", t[1])],
        [(1, "late older text", "s", t[0]), (2, "two updated", "s", t[2])],
    ]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)
        v = refresh.refresh_stream(spark, inbox, base, ckpt, schema, event_time="ts", nlist=2)
        assert v == i + 1
    _, live, _ = refresh.read_live(spark, base)
    texts = {r.doc_id: r.text for r in live.collect()}
    assert texts == {1: "newer text of one", 2: "two updated"}


def test_index_passages_title_pair(spark):
    p = spark.createDataFrame([(1, "Zebra", "stripes here"), (2, None, "stripes here")],
                              "passage_id long, title string, text string")
    plain = {r.passage_id: list(r.embedding) for r in retrieve.index_passages(p).collect()}
    pair = {r.passage_id: list(r.embedding) for r in retrieve.index_passages(p, with_title=True).collect()}
    assert plain[1] == plain[2] == pair[2] and pair[1] != plain[1]


def test_checkpoint_sweep_groups(spark):
    df = spark.createDataFrame([("c1", "base", 1, 1.0, 1), ("c1", "base", 0, 0.5, 0), ("c2", "base", 1, 1.0, 1)],
                               "checkpoint string, mode string, em int, f1 double, hit int")
    rows = {(r.checkpoint, r.mode): (r.n, r.em, r.f1, r.recall) for r in metrics.checkpoint_sweep(df).collect()}
    assert rows == {("c1", "base"): (2, 0.5, 0.75, 0.5), ("c2", "base"): (1, 1.0, 1.0, 1.0)}


def test_periodic_refresh_stream(spark):
    from qaflow import scratch_path

    schema = "doc_id long, text string, source string"
    inbox, base, ckpt = (scratch_path(spark, n) for n in ("p_inbox", "p_base", "p_ckpt"))
    spark.createDataFrame([(1, "alpha beta", "s"), (2, "gamma delta", "s")], schema).write.parquet(inbox)
    q = refresh.refresh_stream(spark, inbox, base, ckpt, schema, nlist=2, processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    _, live, _ = refresh.read_live(spark, base)
    assert live.count() == 2


def test_should_refresh_trigger(spark):
    base = tempfile.mkdtemp(prefix="qaflow-trig-")
    docs = spark.createDataFrame([(i, f"text number {i}", "s") for i in range(20)],
                                 "doc_id long, text string, source string")
    assert refresh.should_refresh(spark, base, docs)
    refresh.refresh_index(spark, base, docs, nlist=2)
    assert not refresh.should_refresh(spark, base, docs)
    assert refresh.should_refresh(spark, base, docs, encoder_version="other")
    more = docs.unionByName(spark.createDataFrame([(100 + i, "new", "s") for i in range(5)],
                                                  "doc_id long, text string, source string"))
    assert refresh.should_refresh(spark, base, more)


def test_hot_group_is_split_and_exact(spark):
    import numpy as np

    rng = np.random.default_rng(7)
    n = 600
    X = rng.normal(size=(n, 8))
    # half of the corpus sits in cell 0 (a hot cell); the rest spread over cells 1..9
    cells = np.where(np.arange(n) < n // 2, 0, 1 + np.arange(n) % 9)
    corpus = spark.createDataFrame([(int(i), X[i].tolist(), int(cells[i])) for i in range(n)],
                                   "c_id long, c_vec array<double>, g long")
    Qv = rng.normal(size=(40, 8))
    queries = spark.createDataFrame([(int(j), Qv[j].tolist(), int(j % 3)) for j in range(40)],
                                    "q_id long, q_vec array<double>, g long")
    plan = {r.g: (r.qs, r.cs) for r in vectors.block_plan(queries, corpus, 8, 50).collect()}
    assert plan[0][1] == 6 and plan[0][0] == 2  # 300 rows / 50 and 14 queries / 8
    got = vectors.grouped_topk(queries, corpus, 5, force_blocks=True, query_block=8, corpus_block=50)
    got = sorted((r.q_id, r.rank, r.c_id) for r in got.collect())
    want = []
    for j in range(40):
        idx = np.nonzero(cells == j % 3)[0]
        sc = np.round(X[idx] @ Qv[j], 6)
        order = sorted(range(len(idx)), key=lambda t: (-sc[t], idx[t]))[:5]
        want += [(j, r + 1, int(idx[t])) for r, t in enumerate(order)]
    assert got == sorted(want)


def test_small_delta_rewrites_only_touched_cells(spark):
    import glob

    base = tempfile.mkdtemp(prefix="qaflow-cells-")
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "theta"]
    docs = spark.createDataFrame([(i, " ".join(words[(i + j) % 8] for j in range(5)) + f" w{i}", "s")
                                  for i in range(40)], "doc_id long, text string, source string")
    refresh.refresh_index(spark, base, docs, nlist=6)
    all_cells = {p.split("cell=")[1] for p in glob.glob(f"{base}/version=1/postings/cell=*")}
    upd = spark.createDataFrame([(3, "completely new words here", "s")], "doc_id long, text string, source string")
    refresh.refresh_index(spark, base, upd, nlist=6)
    v2_cells = {p.split("cell=")[1] for p in glob.glob(f"{base}/version=2/postings/cell=*")}
    assert 1 <= len(v2_cells) <= 2 < len(all_cells)
    _, live, _ = refresh.read_live(spark, base)
    rows = {r.doc_id: r.text for r in live.collect()}
    assert len(rows) == 40 and rows[3] == "completely new words here"
    refresh.refresh_index(spark, base, upd.limit(0), nlist=6, compact=True)
    v3_cells = {p.split("cell=")[1] for p in glob.glob(f"{base}/version=3/postings/cell=*")}
    _, live3, _ = refresh.read_live(spark, base)
    assert v3_cells == {str(c) for c in {r.cell for r in live3.collect()}} and live3.count() == live.count()


def test_lookup_without_bound_matches(spark):
    hits = spark.createDataFrame([(1, 1, 10, 0.9), (2, 1, 10, 0.8), (2, 2, 11, 0.5), (3, 1, 99, 0.1)],
                                 "item_id long, rank int, passage_id long, score double")
    passages = spark.createDataFrame([(10, "t", "ten"), (11, "t", "eleven"), (12, "t", "twelve")],
                                     "passage_id long, title string, text string")
    got = sorted((r.item_id, r.passage_id, r.text) for r in retrieve.lookup_passages(hits, passages).collect())
    assert got == [(1, 10, "ten"), (2, 10, "ten"), (2, 11, "eleven")]


def test_centroids_depend_on_the_vectors_alone(spark):
    import random

    rng = random.Random(3)
    rows = [([rng.gauss(c == i % 3, 0.2) for c in range(6)],) for i in range(1500)] + [([0.0] * 6,), (None,)]
    first = None
    for parts in (1, 3, 7):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "v array<double>").repartition(parts)
        got = [tuple(r) for r in vectors.train_centroids(df, "v", 3).orderBy("cell").collect()]
        first = first or got
        assert got == first and len(got) == 3
    assert all(max(c) > 0.9 for _, c in first) and len({c.index(max(c)) for _, c in first}) == 3
    assert vectors.train_centroids(df.limit(0), "v", 3).count() == 0
    assert vectors.train_centroids(spark.createDataFrame([([1.0, 2.0],)] * 4, "v array<double>"), "v", 3).count() == 1


def test_throughput_reports_every_mode(spark):
    from qaflow.plans import catalog, modes

    got = catalog.q_throughput_modes(spark, "/root/testdata/sf0.001").collect()
    assert [r["mode"] for r in got] == list(modes.MODES) and len({r["answered"] for r in got}) == 1


def test_each_retrieval_encodes_once(spark):
    """Two rounds over an index that is only described: as many encodings of the passages as retrievals that are read."""
    seen = spark.sparkContext.accumulator(0)
    plain = models.hash_encoder()

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    P = spark.createDataFrame([(i, f"word{i} word{i % 5} other") for i in range(40)], "passage_id long, text string")
    Q = spark.createDataFrame([(1, "word3 other"), (2, "word7")], "item_id long, question string")
    index = P.mapInPandas(counted, P.schema).select("passage_id", plain(F.col("text")).alias("embedding"))
    hist, _ = retrieve.iterative_retrieve(Q, index, P, 3, 2)
    assert len(hist.collect()) == 4
    assert seen.value == 2 * 40


def test_token_codes_equal_the_long_form(spark):
    """Vectors of texts, with repeated tokens, none and null, beyond a slice: as the long form has them."""
    texts = [None, "", "the", "One two  two, two!", "\u00c4rger \u6587\u5b57 x"] + [f"w{i % 37} w{i} w{i}" for i in range(1100)]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string").coalesce(1)
    got = {r["i"]: r["e"] for r in df.select("i", models.hash_encoder()(F.col("t")).alias("e")).collect()}
    want = {i: [0.0] * 64 for i in range(len(texts))}
    for r in models.hash_encode_long(df, ["i"], "t").collect():
        want[r["i"]][r["bucket"]] = float(r["weight"])
    for i, w in want.items():
        n = sum(x * x for x in w) ** 0.5
        assert got[i] == pytest.approx([x / n if n else 0.0 for x in w])


def test_checksum_of_passage_ids_goes_on_beyond_the_range_of_a_long(spark, tmp_path):
    """As with millions of documents: the ids' sum has no BIGINT, the checksum is that sum modulo 2**64."""
    from qaflow.plans import catalog
    from qaflow.streaming import refresh

    for n, (first, count) in enumerate([(5_000_000_000_000, 2), (5_000_000_000_000, 4), (3, 2)]):
        ids, base = [first + i for i in range(count)], str(tmp_path / f"index{n}")
        docs = spark.createDataFrame([(i, "s", f"some words {i}") for i in ids], "doc_id long, source string, text string")
        refresh.refresh_index(spark, base, docs, nlist=2)
        got = catalog._final_state(spark, base)
        total = sum(i * 1_000_000 for i in ids)
        assert dict(got.dtypes)["checksum"] == "bigint"
        assert got.collect() == [(1, count, (total + 2 ** 63) % 2 ** 64 - 2 ** 63, count)]
    assert spark.range(0).transform(lambda d: d.agg(catalog._checksum("id").alias("c"))).first()["c"] is None
