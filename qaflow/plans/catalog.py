"""Registered queries: one DataFrame plan per operator group of SURVEY §7.4.

Each ``q_*`` function takes ``(spark, sf_dir)``, reads the given tables (or
data Spark derives from them) in full and returns a DataFrame whose columns
match the DuckDB oracle of the same name in :mod:`qaflow.plans.oracles`.
Integers are returned as BIGINT and scores rounded to 6 digits on both
sides, so the value hash is engine-independent.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaflow.functions import text as T
from qaflow.operators import chunk, metrics, models, prep, retrieve, split, vectors

K = 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from qaflow.sources.readers import read_table

    return read_table(spark, f"{sf_dir}/{name}.parquet")


def _passages(spark, sf_dir):
    return retrieve.corpus_passages(table(spark, sf_dir, "documents"))


def _stored_passages(spark, sf_dir):
    """The passages from a table bucketed by id: cut once for the index and every lookup."""
    from qaflow.sources import store

    return store.store_passages(_passages(spark, sf_dir))


def _encoded_passages(spark, sf_dir):
    """Passages with their vectors, cut and encoded once for several retrievals: what they read is stored."""
    from qaflow.operators import models
    from qaflow.sources import store

    return store.store_index(_passages(spark, sf_dir).withColumn("embedding", models.hash_encoder()(F.col("text"))))


def _questions(spark, sf_dir):
    return retrieve.benchmark_questions(table(spark, sf_dir, "benchmark"))


def _hits(spark, sf_dir, k=K):
    """Exact top-k of the benchmark questions over all document passages."""
    P, Q = _passages(spark, sf_dir), _questions(spark, sf_dir)
    return P, Q, retrieve.similarity_join(Q, retrieve.index_passages(P), k)


# --- chunking -----------------------------------------------------------------

def q_passages_100w(spark, sf_dir):
    P = _passages(spark, sf_dir)
    return P.select("doc_id", F.col("idx").cast("bigint"), "title", "text")


def q_lead_chunk_100(spark, sf_dir):
    return chunk.lead_chunk(table(spark, sf_dir, "documents"), 100)


def q_sliding_chunks_100_20(spark, sf_dir):
    out = chunk.sliding_chunks(table(spark, sf_dir, "documents"), 100, 20)
    return out.select("doc_id", F.col("idx").cast("bigint"), F.col("n_tokens").cast("bigint"), "text")


def q_dense_passage_ids(spark, sf_dir):
    P = _passages(spark, sf_dir).select("doc_id", "idx")
    return split.dense_ids(P, ["doc_id", "idx"], out="passage_id").select(
        "passage_id", "doc_id", F.col("idx").cast("bigint"))


# --- sharding, splitting, batching -------------------------------------------

def _shards(spark, sf_dir, rule):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    n = docs.count()
    pos = split.dense_ids(docs, ["doc_id"])
    return pos.withColumn("shard", rule("pos", n, 7)).groupBy("shard").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("min_id"), F.max("doc_id").alias("max_id")
    ).select(F.col("shard").cast("bigint"), "n", "min_id", "max_id")


def q_shards_floor_7(spark, sf_dir):
    return _shards(spark, sf_dir, split.floor_shards)


def q_shards_balanced_7(spark, sf_dir):
    return _shards(spark, sf_dir, split.balanced_shards)


def q_split_80_10_10(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark").select("item_id")
    s = split.seeded_split(b, "item_id", 0.8, 42)
    return s.groupBy("split").agg(F.count("*").alias("n"), F.sum("item_id").alias("key_sum"))


def q_train_val_90_10(spark, sf_dir):
    pairs = retrieve.qa_pairs(table(spark, sf_dir, "conversations")).select(
        F.concat_ws(":", "conv_id", "turn").alias("key"), "conv_id")
    s = split.train_val_split(pairs, "key", 0.1, 7)
    return s.groupBy("split").agg(F.count("*").alias("n"), F.sum("conv_id").alias("key_sum"))


def q_micro_batches_32(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    pos = split.dense_ids(c, ["conv_id", "turn"])
    b = pos.withColumn("batch", split.micro_batch("pos", 32))
    return b.groupBy("batch").agg(F.count("*").alias("n"),
                                  F.round(F.avg(F.length("text")), 6).alias("mean_len"))


# --- QA records ---------------------------------------------------------------

def q_qa_pairs(spark, sf_dir):
    pairs = retrieve.qa_pairs(table(spark, sf_dir, "conversations"))
    valid, _rejected = prep.require_nonempty_pairs(pairs, "question", "answer")
    return valid


def _gold_records(spark, sf_dir):
    """QA records with aliases: the answer's lines when it has several, else none."""
    conv = table(spark, sf_dir, "conversations")
    pairs = retrieve.qa_pairs(conv)
    raw = conv.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("a_raw"))
    lines = F.filter(F.transform(F.split("a_raw", "\n", -1), lambda x: T.strip(x)), lambda x: x != "")
    rec = pairs.join(raw, ["conv_id", "turn"]).withColumn(
        "answer_rec", F.struct(F.when(F.size(lines) > 1, lines).otherwise(F.array().cast("array<string>"))
                               .alias("aliases"), F.col("answer").alias("value")))
    return rec.withColumn("golds", prep.gold_list("answer_rec"))


def q_gold_fallback(spark, sf_dir):
    r = _gold_records(spark, sf_dir)
    return r.select("conv_id", "turn", F.size("golds").cast("bigint").alias("n_golds"),
                    prep.first_gold("golds").alias("first_gold"),
                    F.array_join("golds", "|").alias("golds_joined"))


def q_em_f1_set(spark, sf_dir):
    r = _gold_records(spark, sf_dir)
    return r.select("conv_id", "turn", T.em_a("question", "golds").cast("bigint").alias("em"),
                    F.round(T.max_over_golds(T.f1_set, "question", "golds"), 6).alias("f1"))


def q_em_f1_bag(spark, sf_dir):
    r = _gold_records(spark, sf_dir)
    em = T.max_over_golds(T.em_b, "question", "golds")
    return r.select("conv_id", "turn", em.cast("bigint").alias("em"),
                    F.round(T.max_over_golds(T.f1_bag, "question", "golds"), 6).alias("f1"))


def q_eval_pct(spark, sf_dir):
    r = _gold_records(spark, sf_dir)
    out = metrics.qa_summary_pct(r, pred="question", golds="golds")
    return out.select(F.round("em", 6).alias("em"), F.round("f1", 6).alias("f1"))


def q_batch_mean_of_means(spark, sf_dir):
    r = _gold_records(spark, sf_dir)
    pos = split.dense_ids(r, ["conv_id", "turn"])
    s = pos.withColumn("batch", split.micro_batch("pos", 8)).withColumn(
        "f1", T.max_over_golds(T.f1_set, "question", "golds")).withColumn(
        "em", T.em_a("question", "golds").cast("double"))
    flat = metrics.exact_match_rate(s, "em").withColumnRenamed("em", "em_mean")
    f1 = metrics.exact_match_rate(s, "f1").withColumnRenamed("f1", "em").withColumnRenamed("em", "f1_mean")
    means = metrics.batch_mean_of_means(s, "batch", ["em", "f1"]).select(
        F.col("em").alias("em_mean_of_means"), F.col("f1").alias("f1_mean_of_means"))
    one = reduce(lambda a, b: a.withColumn("_k", F.lit(0)).join(b.withColumn("_k", F.lit(0)), "_k").drop("_k"), [flat, f1, means])  # a row each
    return one.select(*[F.round(F.coalesce(c, F.lit(0.0)), 6).alias(c) for c in one.columns])


def q_normalize_a(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where(F.col("text").isNotNull())
    return d.select("doc_id", T.norm_a("text").alias("norm"))


def q_normalize_b(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where(F.col("text").isNotNull())
    return d.select("doc_id", T.norm_b("text").alias("norm"))


# --- vectors --------------------------------------------------------------------

def _emb(spark, sf_dir):
    return table(spark, sf_dir, "embeddings")


def q_unit_vectors(spark, sf_dir):
    e = _emb(spark, sf_dir)
    u = e.select("vec_id", vectors.l2_norm("embedding").alias("norm"),
                 vectors.l2_normalize("embedding").alias("u"))
    return u.select("vec_id", F.round("norm", 6).alias("norm"),
                    F.round(F.element_at("u", 1), 6).alias("first"),
                    F.round(F.aggregate("u", F.lit(0.0), lambda s, x: s + x), 6).alias("coord_sum"))


def q_exact_top15(spark, sf_dir):
    e = _emb(spark, sf_dir)
    hits = vectors.exact_topk(e, e, K, q_id="vec_id", q_vec="embedding", c_id="vec_id", c_vec="embedding")
    return hits.select("q_id", F.col("rank").cast("bigint"), "c_id", F.round("score", 6).alias("score"))


def _label_centroids(e):
    return vectors.label_mean_centroids(e, "label", "embedding")


def q_label_cells(spark, sf_dir):
    e = _emb(spark, sf_dir)
    cells = vectors.assign_cells(e.select("vec_id", "embedding"), _label_centroids(e), "embedding", key="vec_id")
    return cells.groupBy(F.col("cell").cast("bigint").alias("cell")).agg(F.count("*").alias("n"))


def q_ivf_top15_probe3(spark, sf_dir):
    e = _emb(spark, sf_dir)
    cents = _label_centroids(e)
    postings = vectors.assign_cells(e.select("vec_id", "embedding"), cents, "embedding", key="vec_id")
    hits = vectors.ivf_topk(e, postings, cents, K, 3, q_id="vec_id", q_vec="embedding",
                            c_id="vec_id", c_vec="embedding")
    return hits.select("q_id", F.col("rank").cast("bigint"), "c_id", F.round("score", 6).alias("score"))


def q_kmeans_ivf_recall(spark, sf_dir):
    e = _emb(spark, sf_dir)
    cents = vectors.train_centroids(e, "embedding", 16, seed=42)
    postings = vectors.assign_cells(e.select("vec_id", "embedding"), cents, "embedding", key="vec_id").cache()
    exact = vectors.exact_topk(e, e, K, q_id="vec_id", q_vec="embedding", c_id="vec_id",
                               c_vec="embedding").cache()
    outs = []
    for nprobe in (1, 4, 16):
        approx = vectors.ivf_topk(e, postings, cents, K, nprobe, q_id="vec_id", q_vec="embedding",
                                  c_id="vec_id", c_vec="embedding")
        outs.append(vectors.ann_recall(approx, exact, K).select(
            F.lit(nprobe).cast("bigint").alias("nprobe"), F.round("recall", 6).alias("recall")))
    return reduce(DataFrame.unionByName, outs)


def q_skewed_norm_top15(spark, sf_dir):
    """E9 by block bounds: the vectors get norms that fall like 1 / rank, and blocks that cannot
    reach a query's k-th best score are not scored."""
    from qaflow.operators import bounds

    e = _emb(spark, sf_dir)
    scale = 100.0 / (1 + F.pmod("vec_id", F.lit(211)))
    s = e.select("vec_id", F.transform("embedding", lambda x: x.cast("double") * scale).alias("embedding"))
    hits = bounds.bounded_topk(e, s, K, q_id="vec_id", q_vec="embedding", c_id="vec_id", c_vec="embedding", block_rows=64)
    return hits.select("q_id", F.col("rank").cast("bigint"), "c_id", F.round("score", 6).alias("score"))


def q_cell_bounds_top15(spark, sf_dir):
    """E9 by block bounds inside cells: every vector against every vector, blocks cut within label cells."""
    from qaflow.operators import bounds

    e = _emb(spark, sf_dir)
    hits = bounds.bounded_topk(e, e, K, q_id="vec_id", q_vec="embedding", c_id="vec_id", c_vec="embedding", cell="label", block_rows=64)
    return hits.select("q_id", F.col("rank").cast("bigint"), "c_id", F.round("score", 6).alias("score"))


def q_tree_cells_agreement(spark, sf_dir):
    """E5 + E6 in two levels: 64 leaves trained over all vectors; the share of vectors that get the leaf of a flat search."""
    from qaflow.operators import quantiser

    e = _emb(spark, sf_dir).select("vec_id", "embedding")
    first, leaves = quantiser.train_tree(e, "embedding", 64)
    tree = quantiser.assign_tree(e, first, leaves, "vec_id", "embedding")
    flat = vectors.assign_cells(e, leaves.select("cell", "centroid"), "embedding", out="flat", key="vec_id").select("vec_id", "flat")
    same = tree.join(flat, "vec_id")
    return same.agg(F.count("*").alias("n"), F.countDistinct("cell").alias("cells"),
                    F.round(F.avg((F.col("cell") == F.col("flat")).cast("double")), 6).alias("agreement"))


def q_lsh_top15_recall(spark, sf_dir):
    e = _emb(spark, sf_dir)
    exact = vectors.exact_topk(e, e, K, q_id="vec_id", q_vec="embedding", c_id="vec_id", c_vec="embedding")
    approx = vectors.lsh_topk(e, e, K, q_id="vec_id", q_vec="embedding", c_id="vec_id",
                              c_vec="embedding", tables=8, bits=4)
    return vectors.ann_recall(approx, exact, K).select(F.round("recall", 6).alias("recall"), "n_queries")


def q_graph_top15_recall(spark, sf_dir):
    """E8 + E10: build the neighbour graph of all vectors, search it for every vector, compare with exact search.

    ``scored_share`` is the share of all (query, row) pairs that the search scored."""
    from qaflow.operators import graph

    e = _emb(spark, sf_dir).select("vec_id", "embedding")
    rows, near, _built = graph.build_graph(e, "vec_id", "embedding")
    approx = graph.graph_topk(e, rows, near, K, q_id="vec_id", q_vec="embedding")
    exact = vectors.exact_topk(e, e, K, q_id="vec_id", q_vec="embedding", c_id="vec_id", c_vec="embedding")
    n = rows.count()
    return vectors.ann_recall(approx, exact, K).select(
        F.round("recall", 6).alias("recall"), "n_queries",
        F.round(F.lit(approx._qaflow_scored) / (F.col("n_queries") * F.lit(n)), 6).alias("scored_share"))


def q_precision_at_5(spark, sf_dir):
    e = _emb(spark, sf_dir)
    hits = vectors.exact_topk(e, e, 5, q_id="vec_id", q_vec="embedding", c_id="vec_id", c_vec="embedding")
    lab = e.select("vec_id", "label")
    j = (hits.join(lab.withColumnRenamed("vec_id", "q_id").withColumnRenamed("label", "q_label"), "q_id")
         .join(lab.withColumnRenamed("vec_id", "c_id"), "c_id"))
    per_q = j.groupBy("q_id").agg((F.sum((F.col("label") == F.col("q_label")).cast("int")) / 5.0).alias("p"))
    return per_q.agg(F.lit(5).cast("bigint").alias("k"), F.round(100.0 * F.avg("p"), 6).alias("precision"))


# --- text retrieval over documents ----------------------------------------------

def q_hash_encode(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark")
    return models.hash_encode_long(b, ["item_id"], "text").select(
        "item_id", F.col("bucket").cast("bigint"), "weight")


def q_retrieve_top15(spark, sf_dir):
    _, _, hits = _hits(spark, sf_dir)
    return hits.select("item_id", F.col("rank").cast("bigint"), "passage_id", "score")


def q_recall_at_15(spark, sf_dir):
    P, Q, hits = _hits(spark, sf_dir)
    rec = retrieve.answer_containment(retrieve.lookup_passages(hits, P, ("text",)), Q)
    return rec.agg(F.count("*").alias("n"), F.sum("hit").cast("bigint").alias("hits"),
                   F.round(F.sum("hit") / F.count("*"), 6).alias("recall"))


def q_retrieve_full(spark, sf_dir):
    P = _passages(spark, sf_dir)
    idx = retrieve.index_passages(P)
    hits = retrieve.similarity_join(_questions(spark, sf_dir), idx, 5)
    full = retrieve.retrieve_full(hits, P, idx)
    return full.select(
        "item_id", F.size("docs").cast("bigint").alias("n_docs"),
        F.array_join(F.transform("docs", lambda d: d["passage_id"].cast("string")), ",").alias("ids"),
        F.array_join(F.transform("docs", lambda d: d["title"]), ",").alias("titles"),
        F.round(F.aggregate("docs", F.lit(0.0), lambda s, d: s + d["score"]), 6).alias("score_sum"),
        F.round(F.aggregate("docs", F.lit(0.0), lambda s, d: s + F.element_at(d["embedding"], 1)), 6)
        .alias("emb1_sum"))


def q_train_source(spark, sf_dir):
    P, Q, hits = _hits(spark, sf_dir, 5)
    ctx = retrieve.contexts_by_rank(retrieve.lookup_passages(hits, P, ("text",)))
    j = Q.join(ctx, "item_id", "left")
    return j.select("item_id", prep.add_prefix(prep.assemble_source("question", "contexts"), "").alias("src"),
                    prep.first_gold("golds").alias("tgt"))


def q_qa_prompt(spark, sf_dir):
    P, Q, hits = _hits(spark, sf_dir, 5)
    ctx = retrieve.contexts_by_rank(retrieve.lookup_passages(hits, P, ("text",)))
    j = Q.join(ctx, "item_id", "left")
    return j.select("item_id", prep.qa_prompt("question", "contexts").alias("prompt"),
                    prep.rerank_prompt("question", F.element_at("contexts", 1)).alias("rr_prompt"),
                    prep.expand_query("question", prep.first_gold("golds")).alias("expanded"))


def q_bucketed_lookup(spark, sf_dir):
    """J1 + K2: the hits of all questions, without a known bound, meet passages stored in buckets by id."""
    P, Q = _stored_passages(spark, sf_dir), _questions(spark, sf_dir)
    hits = retrieve.similarity_join(Q, retrieve.index_passages(P), K).select("item_id", "rank", "passage_id")
    return retrieve.lookup_passages(hits, P, ("title", "text")).select(
        "item_id", F.col("rank").cast("bigint"), "passage_id", "title", F.md5("text").alias("text_md5"))


def q_rerank_6(spark, sf_dir):
    P, Q, hits = _hits(spark, sf_dir)
    rr = retrieve.rerank(retrieve.lookup_passages(hits, P, ("text",)), Q, 6)
    return rr.select("item_id", F.col("rr_rank").cast("bigint").alias("rank"), "passage_id",
                     F.round("rr_score", 6).alias("rr_score"))


def q_provenance_lines(spark, sf_dir):
    P, Q, hits = _hits(spark, sf_dir, 5)
    t = retrieve.lookup_passages(hits, P, ("title",))
    lines = t.groupBy("item_id").agg(F.sort_array(F.collect_list(
        F.struct("rank", T.strip_title("title").alias("t")))).alias("s"))
    return lines.select("item_id", F.concat_ws("\t", F.col("s.t")).alias("provenance"))


def q_char_lengths(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    out = metrics.char_lengths(d, "text", by=["lang"])
    return out.select("lang", "n", F.col("min_len").cast("bigint"), F.round("avg_len", 6).alias("avg_len"),
                      F.col("max_len").cast("bigint"))


# --- I/O round trips (sources and sinks) -------------------------------------------

def q_gold_literal_roundtrip(spark, sf_dir):
    """K5 + S7 + F10/F13: write the gold file in ``qa`` mode, read it back; two golds more hold both
    quotes, a backslash and line breaks."""
    from qaflow import scratch_path
    from qaflow.sources import readers, writers

    first = F.element_at("golds", 1)
    odd = F.array(F.concat(F.lit("it's \""), first, F.lit("\"")), F.concat(F.lit("a\\n"), first, F.lit("\n\t'end'")))
    Q = _questions(spark, sf_dir).withColumn("golds", F.concat("golds", odd))
    path = scratch_path(spark, "gold")
    lines = Q.select("item_id", F.concat_ws("\t", "question", writers.gold_literal("golds")).alias("line"))
    writers.write_predictions(lines, path, col="line", order="item_id", recalculate=True)
    gold, _quarantine = readers.read_gold(spark, path, "qa", escaped=True)
    return gold.select("line_no", F.size("golds").cast("bigint").alias("n"), F.element_at("golds", 1).alias("first"),
                       F.element_at("golds", -2).alias("quotes"), F.element_at("golds", -1).alias("breaks"))


def q_line_breaks_roundtrip(spark, sf_dir):
    """K4 + S6: whole turns, line breaks included, written as parallel line files and paired back."""
    from qaflow import scratch_path
    from qaflow.sources import readers, writers

    c = table(spark, sf_dir, "conversations").select(
        F.lit("all").alias("split"), F.struct("conv_id", "turn").alias("key"),
        F.concat_ws("\r", "role", F.col("conv_id").cast("string")).alias("source"), F.col("text").alias("target"))
    d = scratch_path(spark, "breaks")
    writers.write_parallel_lines(c, d, "key")
    got, _unmatched = readers.read_parallel_lines(spark, *writers.line_file_paths(d, "all"), escaped=True)
    parts = F.split("source", "\r")
    return got.select("line_no", parts[0].alias("role"), parts[1].cast("bigint").alias("conv_id"), F.md5("target").alias("text_md5"))


def q_jsonl_roundtrip(spark, sf_dir):
    """K3 + S5: pre-retrieved JSON lines (question, answer, contexts), read back."""
    from qaflow import scratch_path
    from qaflow.sources import readers, writers

    P, Q, hits = _hits(spark, sf_dir, 5)
    rec = writers.preretrieved_records(Q, retrieve.lookup_passages(hits, P, ("text",)))
    path = scratch_path(spark, "jsonl")
    writers.write_preretrieved(rec.drop("item_id"), path)
    back = readers.read_jsonl(spark, path)
    return back.agg(F.count("*").alias("n"),
                    F.sum(F.size("contexts")).cast("bigint").alias("n_contexts"),
                    F.sum(F.aggregate("contexts", F.lit(0), lambda s, c: s + F.length(c))).cast("bigint")
                    .alias("ctx_chars"),
                    F.sum(F.length("answer")).cast("bigint").alias("answer_chars"),
                    F.sum(F.length("question")).cast("bigint").alias("question_chars"))


def q_line_files_roundtrip(spark, sf_dir):
    """D3 + K4 + S6 + P8: split QA pairs, write source/target line files, pair them back."""
    from qaflow import scratch_path
    from qaflow.sources import readers, writers

    pairs = retrieve.qa_pairs(table(spark, sf_dir, "conversations")).withColumn(
        "key", F.concat_ws(":", "conv_id", "turn"))
    s = split.seeded_split(pairs, "key", 0.8, 42)
    d = scratch_path(spark, "lines")
    writers.write_parallel_lines(s.select("split", "key", F.col("question").alias("source"),
                                          F.col("answer").alias("target")), d, "key")
    outs = []
    for name in ("train", "val", "test"):
        src, tgt = writers.line_file_paths(d, name)
        got, unmatched = readers.read_parallel_lines(spark, src, tgt, escaped=True)
        valid, _rej = prep.require_nonempty_pairs(got, "source", "target")
        outs.append(valid.agg(F.lit(name).alias("split"), F.count("*").alias("n"),
                              F.sum(F.length("source")).cast("bigint").alias("src_chars"),
                              F.sum(F.length("target")).cast("bigint").alias("tgt_chars")))
    return reduce(DataFrame.unionByName, outs)


def q_passages_roundtrip(spark, sf_dir):
    """S1 + C1 + K2 + S8: documents as a headerless KB TSV, split, saved, reloaded."""
    from qaflow import scratch_path
    from qaflow.sources import readers, writers

    docs = table(spark, sf_dir, "documents")
    tsv = scratch_path(spark, "kb")
    docs.select(F.col("source").alias("title"), "text").write.mode("overwrite").csv(
        tsv, sep="\t", quote='"', escape='"', header=False)
    kb = readers.read_kb_tsv(spark, tsv).withColumn("doc_key", F.monotonically_increasing_id())
    P = chunk.split_passages(kb, 100, key="doc_key")
    out = scratch_path(spark, "passages")
    writers.write_passages(P, out)
    back = readers.read_passages(spark, out)
    return back.agg(F.count("*").alias("n"), F.countDistinct("title").alias("n_titles"),
                    F.sum(F.length("text")).cast("bigint").alias("text_chars"),
                    F.sum("idx").cast("bigint").alias("idx_sum"))


def q_vector_shards_roundtrip(spark, sf_dir):
    """D1 + K1 + S4 + E4 + J2: embeddings written as shards, read back and re-paired."""
    from qaflow import scratch_path
    from qaflow.sources import readers, writers

    e = _emb(spark, sf_dir)
    n = e.count()
    pos = split.dense_ids(e, ["vec_id"]).withColumn("shard", split.floor_shards("pos", n, 4))
    emb_path, meta_path = scratch_path(spark, "emb"), scratch_path(spark, "meta")
    writers.write_vector_shard(pos.select("shard", "pos", "embedding"), emb_path)
    writers.write_vector_shard(pos.select("shard", "pos", "vec_id", "label"), meta_path)
    emb = readers.read_vector_shards(spark, emb_path)
    meta = readers.read_vector_shards(spark, meta_path)
    paired = emb.join(meta, ["shard", "pos"], "full_outer")
    return paired.groupBy(F.col("shard").cast("bigint").alias("shard")).agg(
        F.count("*").alias("n"), F.sum("vec_id").alias("id_sum"),
        F.round(F.sum(F.element_at("embedding", 1).cast("double")), 6).alias("first_sum"),
        F.sum(F.when(F.col("vec_id").isNull() | F.col("embedding").isNull(), 1).otherwise(0))
        .cast("bigint").alias("unpaired"))


# --- index refresh: batch swap and stream ------------------------------------------

def _checksum(col):
    """The sum as BIGINT; beyond its range (some millions of documents' passage ids) modulo 2**64, where a sum of longs fails."""
    two = lambda n: F.lit(Decimal(2 ** n))
    low = F.pmod(F.sum(F.col(col).cast("decimal(19,0)")), two(64))
    return F.when(low >= two(63), low - two(64)).otherwise(low).cast("bigint")


def _final_state(spark, base):
    from qaflow.streaming import refresh

    v, postings, _ = refresh.read_live(spark, base)
    return postings.agg(F.lit(v).cast("bigint").alias("version"), F.count("*").alias("n"),
                        _checksum("passage_id").alias("checksum"),
                        F.countDistinct("doc_id").alias("n_docs"))


def q_refresh_swap(spark, sf_dir):
    """E11 + K7 + K8: build version 1 from the first half of the documents, then
    fold in the second half plus re-delivered documents of the first (upserts)."""
    from qaflow import scratch_path
    from qaflow.streaming import refresh

    docs = table(spark, sf_dir, "documents")
    mid = docs.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
    base = scratch_path(spark, "index")
    refresh.refresh_index(spark, base, docs.where(F.col("doc_id") <= mid))
    refresh.refresh_index(spark, base, docs.where(F.col("doc_id") > F.lit(mid) * 0.9))
    return _final_state(spark, base)


FILE_CHARS = 64 << 20


def _files_a_delivery(docs, deliveries, copies=1, file_chars=None):
    """How many files a delivery has: one while it is small, else as many as hold about ``FILE_CHARS`` characters each."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    return max(1, -(-chars * copies // (deliveries * (file_chars or FILE_CHARS))))


def q_refresh_stream(spark, sf_dir):
    """E12 + W1: documents arrive by ranges in four deliveries, of a file each while they are small; each
    micro-batch publishes a version."""
    from qaflow import scratch_path
    from qaflow.streaming import refresh

    docs = table(spark, sf_dir, "documents")
    inbox, base, ckpt = (scratch_path(spark, n) for n in ("inbox", "sindex", "sckpt"))
    files = _files_a_delivery(docs, 4)
    docs.repartitionByRange(4 * files, "doc_id").write.mode("overwrite").parquet(inbox)
    refresh.refresh_stream(spark, inbox, base, ckpt, docs.schema,
                           max_files_per_trigger=files)
    return _final_state(spark, base)


def q_stream_upserts(spark, sf_dir):
    """E12 / W1 by keyed state: every document arrives three times, its newest version first in half of the
    cases, in four deliveries (of a file each while they are small); the accepted updates reduced to the latest a document."""
    from qaflow import scratch_path
    from qaflow.streaming import upsert

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    at = lambda n: F.timestamp_seconds(F.lit(1_700_000_000) + F.lit(n))
    versions = F.array(*[F.struct(at(n).alias("updated_at"), F.concat(F.lit(f"v{n} "), F.col("text")).alias("text"), F.lit(n).alias("n")) for n in (1, 2, 2)])
    sent = docs.select("doc_id", "source", F.posexplode(versions).alias("copy", "x")).select(
        "doc_id", "source", "x.text", "x.updated_at", F.pmod(F.col("doc_id") * 7 + F.col("copy") * 3, F.lit(4)).alias("file"))
    inbox, out, ckpt = (scratch_path(spark, n) for n in ("uinbox", "updates", "uckpt"))
    files = _files_a_delivery(docs, 4, 3)
    sent.repartitionByRange(4 * files, "file", *(["doc_id"] if files > 1 else [])).drop("file").write.parquet(inbox)
    upsert.upsert_stream(spark, inbox, out, ckpt, "doc_id long, source string, text string, updated_at timestamp", "updated_at", max_files_per_trigger=files)
    now = upsert.current_documents(spark.read.parquet(out), "updated_at")
    return now.select("doc_id", "source", F.unix_seconds("updated_at").alias("at"), F.md5("text").alias("text_md5"))


def q_shuffle_epoch(spark, sf_dir):
    """D6 by a keyed permutation: two epochs of shuffled batches of 32 over all documents, placed without a sort."""
    from qaflow.operators import permute

    d = table(spark, sf_dir, "documents").select("doc_id")
    n = d.agg(F.max("doc_id")).first()[0] + 1  # the ids are positions 0..n-1
    parts = [permute.shuffle_batches(d, "doc_id", n, 32, seed=42, epoch=e).withColumn("epoch", F.lit(e).cast("bigint")) for e in (0, 1)]
    return reduce(DataFrame.unionByName, parts).select("epoch", "doc_id", "batch", "slot")


# --- sequence shaping ----------------------------------------------------------------

def q_encode_pad_trim(spark, sf_dir):
    """C4-C8 + P17 over a word vocabulary built from the benchmark texts."""
    b = _questions(spark, sf_dir).select("item_id", F.col("answer.value").alias("value")).join(
        table(spark, sf_dir, "benchmark"), "item_id")
    t = b.select("item_id", T.tokens(T.norm_a("text")).alias("st"), T.tokens(T.norm_a("value")).alias("tt"))
    words = t.select(F.explode("st").alias("token")).unionByName(t.select(F.explode("tt").alias("token")))
    vocab = chunk.build_vocab(words)
    enc = chunk.encode_tokens(chunk.encode_tokens(t, "item_id", "st", vocab, "sid"), "item_id", "tt", vocab, "tid")
    src, mask = chunk.encode_fixed(chunk.append_eos("sid"), 64)
    tgt, _ = chunk.encode_fixed(chunk.append_eos("tid"), 8)
    e = enc.select("item_id", src.alias("src"), mask.alias("mask"), tgt.alias("tgt"))
    pos = split.dense_ids(e, ["item_id"]).withColumn("batch", split.micro_batch("pos", 8))
    trimmed = chunk.trim_batch(pos, "batch", ["src", "mask"])
    _, _, dec_in = chunk.shift_targets(F.col("tgt"))
    labels = F.transform("tgt", lambda x: F.when(x == chunk.PAD_ID, F.lit(-100)).otherwise(x))
    shaped = trimmed.withColumn("dec_in", dec_in).withColumn("labels", chunk.mask_to_pad(labels))
    per = shaped.groupBy("batch").agg(
        F.count("*").alias("n"), F.max(F.size("src")).cast("bigint").alias("width"),
        F.sum(F.aggregate("src", F.lit(0).cast("bigint"), lambda s, x: s + x)).cast("bigint").alias("src_id_sum"),
        F.sum(F.aggregate("mask", F.lit(0).cast("bigint"), lambda s, x: s + x)).cast("bigint").alias("mask_sum"),
        F.sum(F.aggregate("dec_in", F.lit(0).cast("bigint"), lambda s, x: s + x)).cast("bigint").alias("dec_sum"),
        F.sum(F.aggregate("labels", F.lit(0).cast("bigint"), lambda s, x: s + x)).cast("bigint").alias("label_sum"))
    tok = chunk.tokens_per_batch(shaped, "batch", "src", "tgt")
    return per.join(tok, "batch").select(F.col("batch").cast("bigint"), "n", "width", "tokens",
                                         "src_id_sum", "mask_sum", "dec_sum", "label_sum")


# --- score parsing, checkpoints, reports ----------------------------------------------

def q_parse_scores(spark, sf_dir):
    """R3 over strings cut from ``events.props`` and ``documents``."""
    ev = table(spark, sf_dir, "events").select(
        F.lit("event_k").alias("src"), F.col("event_id").alias("key"),
        F.get_json_object("props", "$.k").alias("s"))
    d = table(spark, sf_dir, "documents")
    # every space-separated token of every document (key = doc_id * 10**6 + position)
    words = d.select(F.lit("doc_word").alias("src"), "doc_id",
                     F.posexplode(F.split("text", " ", -1)).alias("p", "s")).select(
        "src", retrieve.passage_key("doc_id", "p").alias("doc_id"), "s")
    docs = words.unionByName(
        d.select(F.lit("doc_us").alias("src"), "doc_id",
                 F.concat(F.col("n_chars").cast("string"), F.lit("_5")).alias("s"))).unionByName(
        d.select(F.lit("doc_d").alias("src"), "doc_id",
                 F.concat(F.col("n_chars").cast("string"), F.lit("d")).alias("s"))).unionByName(
        d.select(F.lit("doc_frac").alias("src"), "doc_id",
                 F.concat(F.lit(" ."), F.col("n_chars").cast("string"), F.lit("e-2 ")).alias("s")))
    allv = ev.unionByName(docs.withColumnRenamed("doc_id", "key"))
    return allv.select("src", "key", F.round(T.parse_score("s"), 6).alias("score"))


def q_best_checkpoint(spark, sf_dir):
    """Metric histories per step (labels grouped by doc_id range of 25)."""
    lab = table(spark, sf_dir, "labels")
    h = lab.groupBy((F.col("doc_id") / 25).cast("bigint").alias("step")).agg(
        F.avg("quality").alias("quality"), F.avg("toxic").alias("toxic"))
    long = h.select("step", F.lit("quality").alias("metric"), F.col("quality").alias("v")).unionByName(
        h.select("step", F.lit("toxic").alias("metric"), F.col("toxic").alias("v")))
    best_q = metrics.best_checkpoint(long.where(F.col("metric") == "quality"), "v", mode="max",
                                     patience=3, by=["metric"])
    best_t = metrics.best_checkpoint(long.where(F.col("metric") == "toxic"), "v", mode="min",
                                     patience=3, by=["metric"])
    out = best_q.unionByName(best_t)
    return out.select("metric", "best_step", F.round("best", 6).alias("best"), "stopped_at").orderBy("metric")


def q_counts(spark, sf_dir):
    """G13 + K6: rows loaded and produced per stage, counted by the jobs that write the products; the counts are
    kept as a metrics history and read back, one row per item."""
    from qaflow import scratch_path
    from qaflow.sources import writers

    def keep(df, name):
        df.write.parquet(scratch_path(spark, name))

    docs, n_docs = metrics.observed(table(spark, sf_dir, "documents"), "documents")
    passages, n_passages = metrics.observed(retrieve.corpus_passages(docs), "passages")
    keep(passages, "counted-passages")
    questions, n_questions = metrics.observed(_questions(spark, sf_dir), "questions")
    keep(questions, "counted-questions")
    pairs, n_pairs = metrics.observed(retrieve.qa_pairs(table(spark, sf_dir, "conversations")), "qa_pairs")
    keep(pairs, "counted-pairs")
    vecs, n_vectors = metrics.observed(_emb(spark, sf_dir), "vectors")
    keep(vecs, "counted-vectors")
    seen = {"documents": n_docs, "passages": n_passages, "questions": n_questions, "qa_pairs": n_pairs, "vectors": n_vectors}
    path = scratch_path(spark, "counts")
    writers.write_metrics(spark.createDataFrame([("counts", k, o.get["n"]) for k, o in seen.items()], "mode string, item string, n long"), path)
    return spark.read.schema("item string, n long, mode string").json(path).select("item", "n")


def q_token_report(spark, sf_dir):
    """G9 + T4 + G14: token counts per language and the step count of a 3-epoch run."""
    docs = table(spark, sf_dir, "documents").where(F.col("text").isNotNull())
    per_doc = docs.select("lang", T.chunk_words("text", 100).alias("chunks"))
    flat = per_doc.select("lang", metrics.flatten(F.transform(
        "chunks", lambda c: chunk.ws_tokens(c))).alias("toks"))
    rep = flat.groupBy("lang").agg(F.count("*").alias("n_docs"),
                                   F.round(F.avg(F.size("toks")), 6).alias("mean_tokens"),
                                   F.sum(F.size("toks")).cast("bigint").alias("total_tokens"))
    return rep.select("lang", "n_docs", "mean_tokens", "total_tokens",
                      F.round(metrics.total_steps(F.col("n_docs"), 4, 1, 1, 3), 6).alias("steps"))


# --- answering modes, text metrics, streams --------------------------------------------

def q_rouge_l(spark, sf_dir):
    """F7 over question/answer pairs."""
    pairs = retrieve.qa_pairs(table(spark, sf_dir, "conversations"))
    return pairs.select("conv_id", "turn", F.round(T.rouge_l("answer", "question"), 6).alias("rouge_l"))


def q_answers_base(spark, sf_dir):
    """M1: retrieve 15 -> extractive answer -> EM / F1 / hit per question."""
    from qaflow.plans import modes

    P, Q = _passages(spark, sf_dir), _questions(spark, sf_dir)
    preds = modes.predictions(Q, P, modes=("base",))
    scored = metrics.score_answers(preds, "prediction", "golds")
    return scored.select("item_id", "prediction", F.col("em").cast("bigint"), F.round("f1", 6).alias("f1"),
                         F.col("hit").cast("bigint"))


def q_iterate_2(spark, sf_dir):
    """Two rounds of answer -> expand query -> retrieve."""
    P, Q = _encoded_passages(spark, sf_dir), _questions(spark, sf_dir)
    hist, _state = retrieve.iterative_retrieve(Q, P.select("passage_id", "embedding"), P, K, 2)
    return hist.select("item_id", F.col("round").cast("bigint"), "query", "answer")


def q_six_modes(spark, sf_dir):
    """M1-M6 + G1 + G10: every mode over the same questions, one summary."""
    from qaflow.plans import modes

    P, Q = _stored_passages(spark, sf_dir), _questions(spark, sf_dir)
    s = modes.mode_summary(modes.predictions(Q, P))
    return s.select("mode", "n", F.round("em", 6).alias("em"), F.round("f1", 6).alias("f1"),
                    F.round("recall", 6).alias("recall"))


def q_provenance_precision(spark, sf_dir):
    """M7 + K5 + S9 + J3 + G3: retrieved titles vs titles of answer-bearing
    passages, both written as provenance line files and paired back by line."""
    from qaflow import scratch_path
    from qaflow.sources import readers, writers

    P, Q, hits = _hits(spark, sf_dir)
    ht = retrieve.lookup_passages(hits, P, ("title", "text")).join(Q.select("item_id", "golds"), "item_id")
    contains = F.exists("golds", lambda g: F.contains(F.lower(F.col("text")), T.norm_a(g)))
    per_q = ht.groupBy("item_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", T.strip_title("title").alias("t")))).alias("hyp"),
        F.sort_array(F.collect_list(F.when(contains, F.struct("rank", T.strip_title("title").alias("t")))))
        .alias("ref"))
    lines = Q.select("item_id").join(per_q, "item_id", "left").select(
        "item_id", F.concat_ws("\t", F.col("hyp.t")).alias("hyp"), F.concat_ws("\t", F.col("ref.t")).alias("ref"))
    lines = lines.checkpoint()  # each writer reads its rows twice, once for the range sort: the retrieval runs once
    hyp_path, ref_path = scratch_path(spark, "prov_hyp"), scratch_path(spark, "prov_ref")
    writers.write_predictions(lines, hyp_path, col="hyp", order="item_id", recalculate=True)
    writers.write_predictions(lines, ref_path, col="ref", order="item_id", recalculate=True)
    hyp = readers.read_provenance(spark, hyp_path, escaped=True).withColumnRenamed("titles", "hyp")
    ref = readers.read_provenance(spark, ref_path, escaped=True).withColumnRenamed("titles", "ref")
    paired = hyp.join(ref, "line_no")
    return paired.agg(F.lit(5).cast("bigint").alias("k"), F.count("*").alias("n"),
                      F.round(100.0 * F.avg(metrics.precision_at_k("hyp", "ref", 5)), 6).alias("precision"))


def q_stream_answers(spark, sf_dir):
    """Questions arriving as files are answered batch by batch and appended."""
    from qaflow import scratch_path
    from qaflow.streaming import refresh

    P, Q = _passages(spark, sf_dir), _questions(spark, sf_dir)
    index = retrieve.index_passages(P)
    inbox, out, ckpt = (scratch_path(spark, n) for n in ("qinbox", "answers", "qckpt"))
    Q.select("item_id", "question").repartitionByRange(2, "item_id").write.mode("overwrite").parquet(inbox)

    def answer_batch(batch):
        hits = retrieve.lookup_passages(retrieve.similarity_join(batch, index, 5), P, ("text",))
        ctx = batch.join(retrieve.contexts_by_rank(hits), "item_id", "left")
        return ctx.select("item_id", models.extractive_generator(F.col("question"), F.col("contexts"))
                          .alias("prediction"))

    seen = scratch_path(spark, "qmetrics")
    refresh.answer_stream(spark, inbox, out, ckpt, "item_id long, question string", answer_batch, metrics=seen)
    kept = spark.read.schema("answered long, empty long, epoch int").json(seen).agg(F.sum("answered").alias("all_answered"))
    return spark.read.parquet(out).select("item_id", "prediction").withColumn("all_answered", F.lit(kept.first()[0]))


def q_eval_e2e_pct(spark, sf_dir):
    """M8 + K5 + S7 + J3 + G2: base answers and golds written as line files,
    read back, paired by line and scored in percent with normaliser B."""
    from qaflow import scratch_path
    from qaflow.plans import modes
    from qaflow.sources import readers, writers

    P, Q = _passages(spark, sf_dir), _questions(spark, sf_dir)
    preds = modes.predictions(Q, P, modes=("base",))
    pred_path, gold_path = scratch_path(spark, "preds"), scratch_path(spark, "golds")
    writers.write_predictions(preds, pred_path, col="prediction", order="item_id", recalculate=True)
    writers.write_predictions(Q.withColumn("g", prep.first_gold("golds")), gold_path, col="g",
                              order="item_id", recalculate=True)
    hyp = readers.read_predictions(spark, pred_path, escaped=True)
    gold, _quarantine = readers.read_gold(spark, gold_path, "ans", escaped=True)
    paired = retrieve.pair_predictions(hyp, gold, strict=True)
    out = metrics.qa_summary_pct(paired, "prediction", "golds")
    return out.select(F.round("em", 6).alias("em"), F.round("f1", 6).alias("f1"))


def q_throughput_modes(spark, sf_dir):
    """G8 + K5 + K6: answered / seconds / qps per mode, counted by the write of its predictions and kept as
    a metrics history (timings vary: rows-only check)."""
    from qaflow import scratch_path
    from qaflow.plans import modes
    from qaflow.sources import writers

    P, Q = _encoded_passages(spark, sf_dir), _questions(spark, sf_dir)
    index = P.select("passage_id", "embedding")
    path = scratch_path(spark, "throughput")
    for m in modes.MODES:
        preds = modes.predictions(Q, P, modes=(m,), index=index)
        writers.write_metrics(metrics.throughput_report(preds, m, scratch_path(spark, f"preds-{m}")), path)
    out = spark.read.schema("mode string, answered bigint, seconds double, qps double").json(path)
    return out.orderBy(F.array_position(F.array(*[F.lit(m) for m in modes.MODES]), F.col("mode")))  # a row a mode


def q_ivf_from_index(spark, sf_dir):
    """E5-E7 + K7/K8 serving path: build a versioned cell index of the document
    passages, then answer the benchmark questions from the stored version,
    reading only the probed cell directories (nlist 8, nprobe 3)."""
    from qaflow import scratch_path
    from qaflow.operators import models
    from qaflow.streaming import refresh

    base = scratch_path(spark, "ivf")
    refresh.refresh_index(spark, base, table(spark, sf_dir, "documents"), nlist=8)
    _v, postings, cents = refresh.read_live(spark, base)
    Q = _questions(spark, sf_dir)
    q = Q.select("item_id", models.hash_encoder()(F.col("question")).alias("q_vec"))
    hits = vectors.ivf_topk(q, postings, cents, K, 3, q_id="item_id", q_vec="q_vec",
                            c_id="passage_id", c_vec="embedding")
    return hits.select(F.col("q_id").alias("item_id"), F.col("rank").cast("bigint"),
                       F.col("c_id").alias("passage_id"), F.round("score", 6).alias("score"))


# --- inputs, limits and conversions ------------------------------------------------------

def q_corpus_subsets(spark, sf_dir):
    """S2 + R6 + T1 + C1: documents stored by language, two snapshots read with partition pruning, their union cut
    into passages; the files behind each subset are counted by name."""
    from qaflow import scratch_path
    from qaflow.sources import readers

    path = scratch_path(spark, "corpus")
    table(spark, sf_dir, "documents").withColumnRenamed("lang", "subset").write.partitionBy("subset").parquet(path)
    both = metrics.union_shards(*[split.sort_files(readers.read_corpus(spark, path, s)) for s in ("de", "fr")])
    P = chunk.split_passages(both.select("doc_id", F.col("source").alias("title"), "text", "subset"), 100)
    docs = both.groupBy("subset").agg(F.count("*").alias("n"), (F.countDistinct("file_name") > 0).alias("in_files"))
    cut = P.join(both.select("doc_id", "subset"), "doc_id").groupBy("subset").agg(
        F.count("*").alias("n_passages"), F.sum(F.length("text")).cast("bigint").alias("chars"))
    return docs.join(cut, "subset").select("subset", "n", "in_files", "n_passages", "chars")


def q_qa_head(spark, sf_dir):
    """S3 + P6: a stored QA set, one split, the first 20 questions in order; then the first 5 of those backwards."""
    from qaflow import scratch_path
    from qaflow.sources import readers

    path = scratch_path(spark, "qa")
    Q = _questions(spark, sf_dir).withColumn("split", F.when(F.col("item_id") % 2 == 0, "train").otherwise("validation"))
    Q.select("item_id", "question", "answer", "split").write.parquet(path)
    head = readers.read_qa(spark, path, "validation", max_samples=20)
    last = prep.head_limit(head, 5, [F.desc("question")]).select("item_id", F.lit(True).alias("last"))
    return head.join(last, "item_id", "left").select("item_id", "question", F.coalesce("last", F.lit(False)).alias("last"))


def q_vectors_as_double(spark, sf_dir):
    """Vectors checked for their length and widened."""
    e = vectors.cast_vectors(_emb(spark, sf_dir), "embedding", dim=64, to="double")
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    return e.select("vec_id", F.size("embedding").cast("bigint").alias("dim"), F.round(total, 6).alias("squares"))


def q_decoded_answers(spark, sf_dir):
    """P16 + P9 + R5 + G9: padded lines of turns decoded to clean texts, prefixed, the first three lines kept."""
    c = table(spark, sf_dir, "conversations")
    padded = F.transform(F.split("text", "\n", -1), lambda x: F.concat(F.lit(" \t"), x, F.lit("\n ")))
    t = c.select("conv_id", "turn", F.transform(padded, lambda x: prep.ids_to_clean_text(x)).alias("lines"))
    one = t.select("conv_id", "turn", prep.add_prefix(F.array_join(retrieve.rank_truncate("lines", 3), " | "), "answer: ").alias("text"), "lines")
    mean = metrics.mean_output_length(one, "lines").first()["gen_len"]
    return one.select("conv_id", "turn", "text", F.round(F.lit(mean), 6).alias("mean_lines"))


def q_exploded_words(spark, sf_dir):
    """User code on Arrow batches that returns other rows than it gets -- one row a word of every item."""
    import pyarrow as pa

    def words(batch):
        ids, out = [], []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for w in (text or "").split():
                ids.append(item)
                out.append(w)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.string())], names=["item_id", "word"])

    b = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return models.explode_batches(b, words, "item_id long, word string").groupBy("item_id", "word").agg(F.count("*").alias("n"))


# --- evaluation of several checkpoints and of supplied predictions --------------------------

def q_checkpoint_sweep(spark, sf_dir):
    """G12 + G1 + R7: answers of five checkpoints (the first 5, 10, ... words of the gold's first line) scored in one aggregation."""
    r = _gold_records(spark, sf_dir).select(F.posexplode(F.array(*[F.lit(5 * i) for i in range(1, 6)])).alias("checkpoint", "words"), "golds")
    first = F.split(prep.first_gold("golds"), " ", -1)
    p = r.select(F.col("checkpoint").cast("bigint"), F.lit("lead").alias("mode"), "golds",
                 F.array_join(F.slice(first, F.lit(1), F.col("words")), " ").alias("prediction"))
    s = metrics.score_answers(p).withColumn("hit", F.col("em"))
    out = metrics.checkpoint_sweep(s)
    return out.select("checkpoint", "mode", "n", *[F.round(c, 6).alias(c) for c in ("em", "f1", "recall")]).orderBy("checkpoint")


def q_rag_supplied(spark, sf_dir):
    """M6: predictions of another system (here every item's first sentence) scored as the mode ``rag`` without retrieval."""
    from qaflow.plans import modes

    Q = _questions(spark, sf_dir)
    given = Q.select("item_id", F.element_at("golds", -1).alias("prediction"))
    s = modes.mode_summary(modes.predictions(Q, None, modes=("gen_only", "rag"), rag_predictions=given))
    return s.select("mode", "n", *[F.round(c, 6).alias(c) for c in ("em", "f1", "recall")])


def q_metrics_history(spark, sf_dir):
    """W3 + K6: two evaluations appended to one history, which is never rewritten."""
    from qaflow import scratch_path
    from qaflow.streaming import refresh

    path = scratch_path(spark, "history")
    r = _gold_records(spark, sf_dir)
    for step, answer in enumerate(("question", "answer")):
        em = F.max(T.em_a(answer, "golds")).cast("bigint").alias("best_em")
        refresh.append_metrics_history(r.agg(F.count("*").alias("n"), em), path, step)
    return spark.read.schema("n long, best_em long, step long").json(path).select("step", "n", "best_em")


def q_trained_cells(spark, sf_dir):
    """E5 + E6: cells trained over all vectors; every vector is in its nearest cell, and each centroid is its members' direction
    within the last round's change (counted as 1 where the cosine is at least 0.95)."""
    e = _emb(spark, sf_dir).select("vec_id", "embedding")
    cents = vectors.train_centroids(e, "embedding", 8)
    cells = vectors.assign_cells(e, cents, "embedding", key="vec_id").withColumn("u", vectors.l2_normalize("embedding"))
    means = vectors.label_mean_centroids(cells, "cell", "u").withColumnRenamed("centroid", "mean")
    close = vectors.dot(vectors.l2_normalize("mean"), "centroid") >= 0.95
    return means.join(cents, "cell").agg(F.count("*").alias("cells"), F.sum(close.cast("bigint")).alias("close"))
