"""Layer 4: physical plan checks (pushdown, no whole-table single-partition window,
top-k pushed into the window, no unchecked broadcast of the corpus)."""

from qaflow.operators import retrieve, vectors
from qaflow.plans import catalog
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_projection_pushdown(spark):
    d = catalog.table(spark, SF_SMALL, "documents")
    p = _plan(retrieve.corpus_passages(d))
    assert "PushedFilters: [IsNotNull(text)]" in p
    assert "ReadSchema: struct<doc_id:bigint,text:string,source:string>" in p


def test_topk_uses_window_group_limit(spark):
    e = catalog.table(spark, SF_SMALL, "embeddings")
    hits = vectors.exact_topk(e, e, 15, q_id="vec_id", q_vec="embedding", c_id="vec_id", c_vec="embedding")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = _plan(hits)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "WindowGroupLimit" in p
    assert "SinglePartition" not in p
    # the corpus is scanned by the batch scorer, never broadcast
    assert "BroadcastExchange" not in p


def test_vector_scan_prunes_label(spark):
    e = catalog.table(spark, SF_SMALL, "embeddings")
    hits = vectors.exact_topk(e, e, 5, q_id="vec_id", q_vec="embedding", c_id="vec_id", c_vec="embedding")
    assert "ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in _plan(hits)


def test_ivf_reads_only_probed_cells(spark, tmp_path):
    from pyspark.sql import functions as F

    from qaflow.operators import vectors

    e = catalog.table(spark, SF_SMALL, "embeddings")
    cents = vectors.label_mean_centroids(e, "label", "embedding")
    post = vectors.assign_cells(e.select("vec_id", "embedding"), cents, "embedding", key="vec_id")
    path = str(tmp_path / "postings")
    post.write.partitionBy("cell").parquet(path)
    stored = spark.read.parquet(path)
    q = e.where(F.col("label") == 3).select("vec_id", "embedding")
    hits = vectors.ivf_topk(q, stored, cents, 5, 1, q_id="vec_id", q_vec="embedding",
                            c_id="vec_id", c_vec="embedding")
    plan = _plan(hits)
    import re
    assert re.search(r"PartitionFilters: \[cell#\d+ IN \(", plan), plan
    assert hits.count() == q.count() * 5


def test_lookup_broadcasts_bounded_hits(spark):
    P, Q, hits = catalog._hits(spark, SF_SMALL)
    assert hits._qaflow_max_rows == Q.count() * 15
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = _plan(retrieve.lookup_passages(hits, P, ("text",)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" in p and "BuildLeft" in p


def test_lookup_moves_hits_to_the_buckets_not_passages(spark):
    from pyspark.sql import functions as F

    from qaflow.sources import store

    P = store.store_passages(retrieve.corpus_passages(catalog.table(spark, SF_SMALL, "documents")), buckets=4)
    hits = retrieve.corpus_passages(catalog.table(spark, SF_SMALL, "documents")).select("passage_id", F.lit(1).alias("rank"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = hits.join(P.select("passage_id", "text"), "passage_id")
        plan = _plan(joined)
        assert joined.count() == P.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan, plan  # only the hits move
