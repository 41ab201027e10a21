"""Sources.

Positional files (line files, predictions, gold) get an explicit ``line_no``
in (file name, offset) order.  A text scan cuts large files into byte ranges
and tells each row's range; one pass counts the lines of every range, a
running sum turns the counts into offsets, and the second pass numbers the
lines.  No file is read by a single task because of its position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qaflow.functions import literals, text as T

KB_SCHEMA = "title string, text string"
QA_SCHEMA = "question string, answer struct<aliases: array<string>, value: string>"
PRERETRIEVED_SCHEMA = "question string, answer string, contexts array<string>"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table, spread over the session's cores when it arrives in too few files.

    A large table comes as many files and row groups and the scan already
    yields one task per split; a table of a single file (one row group)
    would put all per-row text work into one task, so it is round-robin
    repartitioned to ``spark.default.parallelism``.  The check is on the
    file listing only, so big inputs never pay for the extra exchange.
    """
    df = spark.read.parquet(path)
    want = spark.sparkContext.defaultParallelism
    if len(df._jdf.inputFiles()) < want:  # a JVM array proxy: counted JVM-side, not shipped
        df = df.repartition(want)
    return df


def read_kb_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Headerless two-column TSV (``title``, ``text``), quotes as in CSV."""
    return spark.read.csv(path, sep="\t", schema=KB_SCHEMA, quote='"', escape='"',
                          multiLine=True, header=False)


def read_corpus(spark: SparkSession, path: str, subset: str | None = None) -> DataFrame:
    """Article corpus; ``subset`` selects a snapshot partition (pruned at scan)."""
    df = spark.read.parquet(path)
    return df.where(F.col("subset") == subset) if subset is not None else df


def read_qa(spark: SparkSession, path: str, split: str | None = None, max_samples: int | None = None,
            fmt: str = "parquet", order: str = "question") -> DataFrame:
    """S3: nested QA set, one split, optional head limit under an explicit order."""
    df = spark.read.format(fmt).load(path) if fmt == "parquet" else \
        spark.read.schema(QA_SCHEMA + ", split string").json(path)
    if split is not None and "split" in df.columns:
        df = df.where(F.col("split") == split)
    if max_samples is not None and max_samples >= 0:
        df = df.orderBy(order).limit(max_samples)
    return df


def read_vector_shards(spark: SparkSession, path: str) -> DataFrame:
    """All shards with the file name exposed (lexical order, as the reference sorts)."""
    return spark.read.parquet(path).withColumn("file_name", F.col("_metadata.file_name"))


def shard_counts_match(emb: DataFrame, meta: DataFrame, shard: str = "shard") -> bool:
    """S4 assert: the same shards on both sides (two small aggregates)."""
    a = emb.select(shard).distinct().withColumn("_a", F.lit(1))
    b = meta.select(shard).distinct().withColumn("_b", F.lit(1))
    return a.join(b, shard, "full_outer").where(F.col("_a").isNull() | F.col("_b").isNull()).count() == 0


def read_jsonl(spark: SparkSession, path: str, schema: str = PRERETRIEVED_SCHEMA,
               max_samples: int | None = None, order: str | None = None) -> DataFrame:
    """JSON lines with a fixed schema; first N under an explicit order."""
    df = spark.read.schema(schema).json(path)
    if max_samples:
        df = df.orderBy(order or df.columns[0]).limit(max_samples)
    return df


def line_offsets(raw: DataFrame) -> DataFrame:
    """``file, start, first_id, first_line, n`` of every byte range of a scan (one row a range).

    The running sum is over this small table, in order of file name and offset.
    """
    ranges = raw.groupBy("file", "start").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))
    before = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    return ranges.select("file", "start", "first_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_line"), "n")


def read_lines(spark: SparkSession, path: str, col: str = "value", escaped: bool = False) -> DataFrame:
    """Text lines with their 0-based position: files in name order, then offset.

    A line ends at a line feed, a carriage return or both (as Python's text mode reads it); a last
    line without an end counts, an end without a further line doesn't.  With ``escaped``, lines
    are those of the sinks of this package and get their line breaks back.

    Both passes read the same listing, so their ranges and the order of rows in them agree; a row
    whose place falls outside its range fails the query rather than getting a wrong number.
    """
    raw = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"))
    offsets = F.broadcast(line_offsets(raw))  # one row a byte range of at least a block
    place = F.col("id") - F.col("first_id")
    right = F.assert_true((place >= 0) & (place < F.col("n")), "the line files changed while they were read").isNull()
    value = literals.unescape_line("value") if escaped else F.col("value")
    return raw.join(offsets, ["file", "start"]).select(
        F.when(right, F.col("first_line") + place).cast("bigint").alias("line_no"), value.alias(col))


def read_parallel_lines(spark: SparkSession, source_path: str, target_path: str,
                        strict: bool = False, escaped: bool = False) -> tuple[DataFrame, DataFrame]:
    """A source and a target line file paired by line number.

    Returns (pairs, unmatched): the reference's ``zip`` truncates silently;
    here unmatched lines are reported, and ``strict`` fails on any.
    """
    src = read_lines(spark, source_path, "source", escaped)
    tgt = read_lines(spark, target_path, "target", escaped)
    full = src.join(tgt, "line_no", "full_outer")
    pairs = full.where(F.col("source").isNotNull() & F.col("target").isNotNull())
    unmatched = full.where(F.col("source").isNull() | F.col("target").isNull())
    if strict:
        pairs = full.where(F.assert_true(
            F.col("source").isNotNull() & F.col("target").isNotNull(), "unpaired line").isNull())
    return pairs, unmatched


def read_predictions(spark: SparkSession, path: str, escaped: bool = False) -> DataFrame:
    """S7 hypotheses: one per line, stripped."""
    return read_lines(spark, path, "raw", escaped).select("line_no", T.strip("raw").alias("prediction"))


def read_gold(spark: SparkSession, path: str, mode: str = "qa", escaped: bool = False) -> tuple[DataFrame, DataFrame]:
    """S7 gold.  ``qa``: ``question<TAB>python-list-literal``; ``ans``: one answer per line.

    A field of a ``qa`` line may be quoted as in CSV.  Returns (gold, quarantine): lines whose second
    field is no list of strings go to the quarantine frame instead of being dropped.
    """
    lines = read_lines(spark, path, "raw", escaped)
    if mode == "qa":
        fields = F.from_csv("raw", "question string, golds string", {"sep": "\t", "quote": '"', "escape": '"', "maxCharsPerColumn": "-1"})
        plain = F.try_element_at(F.split("raw", "\t", -1), F.lit(2))
        quoted = F.col("raw").startswith('"') | F.coalesce(plain, F.lit("")).startswith('"')
        parsed = lines.withColumn("golds", literals.parse_list(F.when(quoted, fields["golds"]).otherwise(plain)))
        good = parsed.where(F.col("golds").isNotNull()).select("line_no", "golds")
        bad = parsed.where(F.col("golds").isNull()).select("line_no", "raw")
        return good, bad
    gold = lines.select("line_no", F.array(T.strip("raw")).alias("golds"))
    return gold, lines.where(F.lit(False))


def read_passages(spark: SparkSession, *paths: str) -> DataFrame:
    """One or many saved passage datasets, concatenated (keys make order irrelevant)."""
    return spark.read.parquet(*paths)


def read_provenance(spark: SparkSession, path: str, escaped: bool = False) -> DataFrame:
    """Tab-separated titles per line."""
    return read_lines(spark, path, "raw", escaped).select("line_no", T.split_join("raw", "\t").alias("titles"))
