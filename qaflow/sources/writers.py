"""Sinks.

Writes go through the DataFrame writer so they are distributed and
atomic per job (the output committer).  Versioned datasets never overwrite
the path being read: a new ``version=N`` directory is written, then a
one-row pointer table is replaced.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qaflow.functions import literals


def write_vector_shard(df: DataFrame, path: str, shard: str = "shard") -> None:
    """K1: embeddings + texts, one directory per shard."""
    df.write.mode("overwrite").partitionBy(shard).parquet(path)


def write_passages(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K2: columnar passage dataset."""
    df.write.mode(mode).parquet(path)


def preretrieved_records(questions: DataFrame, hits_text: DataFrame, key: str = "item_id",
                         with_scores: bool = False) -> DataFrame:
    """K3 rows: ``question, answer (first gold), contexts`` in rank order.

    ``with_scores`` gives the documented form (contexts with their scores).
    """
    item = F.struct("rank", F.col("text").alias("text"), F.col("score")) if with_scores else \
        F.struct("rank", F.col("text").alias("text"))
    ctx = hits_text.groupBy(key).agg(F.sort_array(F.collect_list(item)).alias("_c"))
    sel = F.transform("_c", lambda x: F.struct(x["text"].alias("text"), x["score"].alias("score"))) \
        if with_scores else F.col("_c.text")
    return questions.join(ctx, key, "left").select(
        key, "question", F.element_at("golds", 1).alias("answer"),
        F.coalesce(sel, F.array()).alias("contexts"))


def write_preretrieved(records: DataFrame, path: str) -> None:
    """K3: JSON lines."""
    records.write.mode("overwrite").json(path)


def one_line(col) -> Column:
    """What a line sink writes for a value."""
    return F.coalesce(literals.escape_line(col), F.lit(""))


def write_parallel_lines(df: DataFrame, data_dir: str, key: str, split: str = "split",
                         source: str = "source", target: str = "target",
                         num_partitions: int | None = None) -> None:
    """K4: ``split=S/side=source`` and ``split=S/side=target`` line files in one job.

    Each row is written to both sides by the same task, after a range sort
    by key: part file *i* of the source pairs line by line with part file *i*
    of the target, and both are committed together.  Values are escaped
    (:func:`qaflow.functions.literals.escape_line`), so a line break inside one shifts no line;
    a null value is an empty line.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the split goes through the explode as well: a constant one would be folded out of the sort, and the
    # writer would sort anew by (split, side) alone and lose the order of the keys
    side = lambda name, col: F.struct(F.col(split).alias("split"), F.lit(name).alias("side"), one_line(col).alias("value"))
    both = df.select(key, F.explode(F.array(side("source", source), side("target", target))).alias("x"))
    (both.select(F.col("x.split").alias("split"), key, "x.side", "x.value")
     .repartitionByRange(n, "split", key).sortWithinPartitions("split", "side", key)
     .select("split", "side", "value")
     .write.mode("overwrite").partitionBy("split", "side").text(data_dir))


def line_file_paths(data_dir: str, split: str) -> tuple[str, str]:
    """Where :func:`write_parallel_lines` put one split's two sides."""
    return f"{data_dir}/split={split}/side=source", f"{data_dir}/split={split}/side=target"


def write_predictions(df: DataFrame, path: str, col: str = "prediction", order: str = "line_no",
                      recalculate: bool = False) -> None:
    """K5: one prediction per line in ``order``, escaped (null: an empty line); an existing result is kept
    unless ``recalculate`` (key the path by checkpoint to avoid the reference's reuse)."""
    mode = "overwrite" if recalculate else "ignore"
    df.orderBy(order).select(one_line(col).alias("value")).write.mode(mode).text(path)


gold_literal = literals.list_literal  # the inverse of the gold parser


def write_metrics(metrics: DataFrame, path: str, partition_by=("mode",)) -> None:
    """K6: append-only metrics history as JSON, partitioned by mode/split."""
    metrics.write.mode("append").partitionBy(*partition_by).json(path)


def publish_index(postings: DataFrame, centroids: DataFrame, base: str, version: int,
                  cell: str = "cell") -> str:
    """K7: postings (``partitionBy(cell)``) and centroids under one version directory."""
    root = f"{base}/version={version}"
    postings.write.mode("overwrite").partitionBy(cell).parquet(f"{root}/postings")
    centroids.write.mode("overwrite").parquet(f"{root}/centroids")
    return root


POINTER_SCHEMA = "version int, encoder string, n_docs long, stream string, epoch long"


def swap_version(spark: SparkSession, base: str, version: int, encoder: str = "hash64",
                 n_docs: int | None = None, stream: str | None = None, epoch: int | None = None) -> None:
    """K8: point readers at ``version``: one immutable row per version, appended.

    The append is one committed file, so a reader sees the version before or
    after it and never a missing pointer; the live version is the highest.
    The row also records the encoder that built the version and its document
    count (what a refresh trigger compares against), and the stream and epoch
    it came from (what a replayed micro-batch compares against).
    """
    spark.createDataFrame([(version, encoder, n_docs, stream, epoch)], POINTER_SCHEMA) \
        .coalesce(1).write.mode("append").parquet(f"{base}/_current")


def _pointers(spark: SparkSession, base: str) -> DataFrame | None:
    """The pointer rows (one per version), or None before the first publish.

    Only a path that does not exist reads as "no index"; any other read error
    is raised, so a refresh never rebuilds over an index it cannot read.
    """
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(POINTER_SCHEMA).parquet(f"{base}/_current")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def current_pointer(spark: SparkSession, base: str) -> dict | None:
    """The live pointer row as a dict, or None before the first publish."""
    rows = _pointers(spark, base)
    row = rows.orderBy(F.col("version").desc()).limit(1).first() if rows is not None else None
    return row.asDict() if row else None


def current_version(spark: SparkSession, base: str) -> int | None:
    ptr = current_pointer(spark, base)
    return int(ptr["version"]) if ptr else None


def last_epoch(spark: SparkSession, base: str, stream: str) -> int | None:
    """The highest epoch of ``stream`` that a published version holds."""
    rows = _pointers(spark, base)
    return rows.where(F.col("stream") == stream).agg(F.max("epoch")).first()[0] if rows is not None else None


def metrics_json(summary_rows: list[dict]) -> str:
    """K6 text form: ``{mode: {metric: value}}``."""
    out = {}
    for r in summary_rows:
        out[r["mode"]] = {k: v for k, v in r.items() if k != "mode"}
    return json.dumps(out, sort_keys=True)
