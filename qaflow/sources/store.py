"""Passages stored once, bucketed and sorted by id.

Chunking is the most expensive step before encoding, and a question needs the passages twice: for the
index and for the lookup of its hits.  Here they are cut once, shuffled once by ``passage_id`` and saved as a
bucketed table.  Every later join on ``passage_id`` reads the buckets as they lie: the hits move to the
buckets, the passages don't move.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from qaflow.session import scratch_path


def write_bucketed(df: DataFrame, path: str, key: str = "passage_id", buckets: int | None = None, table: str | None = None) -> str:
    """Saves ``df`` at ``path`` in ``buckets`` by ``key``, each bucket one sorted file; returns the table's name.

    The rows are dealt to tasks by the bucketing's own hash, so a task writes one bucket.  At scale choose
    ``buckets`` for files of a few hundred megabytes; the default is the session's shuffle partitions.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = table or f"qaflow_{key}_{uuid.uuid4().hex[:12]}"
    (df.repartition(n, key).write.format("parquet").bucketBy(n, key).sortBy(key)
     .option("path", path).mode("overwrite").saveAsTable(table))
    return table


def store_passages(passages: DataFrame, buckets: int | None = None) -> DataFrame:
    """The passages from a bucketed table in the shared scratch folder, cut and shuffled once."""
    spark = passages.sparkSession
    return spark.table(write_bucketed(passages, scratch_path(spark, "passages-by-id"), buckets=buckets))


def store_index(index: DataFrame) -> DataFrame:
    """Passage vectors (and what else ``index`` has) written to the shared scratch folder: encoded once, read many times."""
    spark = index.sparkSession
    path = scratch_path(spark, "index")
    index.write.parquet(path)
    return spark.read.schema(index.schema).parquet(path)


def drop_table(spark: SparkSession, table: str) -> None:
    """Forgets the table's name; the files at its path stay."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
