"""A corpus pipeline over ``documents``: each stage applies one operator to all that the stage before kept.

1. quality classifier: documents that are not of the top grade with a probability of a half go;
2. line dedup: lines of recurring templates leave the texts (``n_chars`` follows);
3. n-gram Jaccard join on five-word shingles, similarity 0.8: the smallest ``doc_id`` of each group stays;
4. benchmark decontamination: documents in which a test item is found go;
5. best-fit packing of what is left into sequences.

Every stage is written to the shared folder as Parquet and read again as the next one's input, so a lost
executor costs at most the running stage's tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaflow.llm import decontam, jaccard_join, linededup, packing, quality
from qaflow.llm.common import materialise, read


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept_documents(spark, docs, sf_dir).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = linededup.drop_templates(docs)
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(docs, read(spark, sf_dir, "benchmark")).where(F.size("leaks") == 0).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, packing.default_tokenizer())


STAGES = [("quality", keep_quality), ("line_dedup", drop_lines), ("jaccard_join", keep_one_of_each), ("decontamination", drop_leaks), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
