"""Dense positions, sharding, splitting, batching.

The reference relies on list position everywhere.  Here a position is a
column computed by :func:`dense_ids`: a distributed range sort, then
per-partition counts turned into offsets.  The only driver-side data is one
count per partition, and no window runs over a whole table in a single
partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qaflow.session import scratch_path

_LOW_BITS = 33  # monotonically_increasing_id: partition id << 33 | row number


def dense_ids(df: DataFrame, order: list, out: str = "pos", num_partitions: int | None = None) -> DataFrame:
    """0..n-1 following ``order`` (which must be a total order on the rows).

    ``repartitionByRange`` + ``sortWithinPartitions`` orders the data across
    tasks; ``monotonically_increasing_id`` numbers rows inside each task.
    The numbered rows are written once to the shared folder: range boundaries
    are sampled per exchange, so counts and rows must come from the same one.
    A per-partition count table (one row per partition) then gives the
    offsets, joined back by broadcast.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
    mid = F.monotonically_increasing_id()
    tagged = ranged.withColumn("_mid", mid).withColumn("_part", F.shiftright("_mid", _LOW_BITS))
    path = scratch_path(spark, "dense-ids")
    tagged.write.parquet(path)
    tagged = spark.read.schema(tagged.schema).parquet(path)
    counts = tagged.groupBy("_part").agg(F.count("*").alias("_n"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    low = F.col("_mid").bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
    return (tagged.join(F.broadcast(offsets), "_part")
            .withColumn(out, (F.col("_off") + low).cast("bigint"))
            .drop("_mid", "_part", "_off"))


def sort_files(df: DataFrame, out: str = "file_name") -> DataFrame:
    """Expose the source file name so shard order can be made explicit."""
    return df.withColumn(out, F.col("_metadata.file_name"))


def floor_shards(pos, n_rows: int, num: int) -> Column:
    """Shard s = [s*floor(N/m), (s+1)*floor(N/m)), last takes the rest.

    N < m puts every row in the last shard, as the reference does.
    """
    per = n_rows // num
    if per == 0:
        return F.lit(num - 1)
    return F.least(F.floor(F.col(pos) / per), F.lit(num - 1)).cast("int")


def balanced_shards(pos, n_rows: int, num: int) -> Column:
    """Contiguous shards, the first ``N mod m`` get one extra row."""
    q, r = divmod(n_rows, num)
    p = F.col(pos)
    big = r * (q + 1)
    if q == 0:
        return F.floor(p / (q + 1)).cast("int")
    return F.when(p < big, F.floor(p / (q + 1))).otherwise(
        F.lit(r) + F.floor((p - big) / q)).cast("int")


def seeded_order(key, seed: int, epoch: int | None = None) -> Column:
    """A reproducible shuffle order, ``md5(seed|[epoch|]key)``."""
    parts = [F.lit(str(seed))] + ([F.lit(str(epoch))] if epoch is not None else []) + \
        [F.col(key).cast("string") if isinstance(key, str) else key.cast("string")]
    return F.md5(F.concat_ws("|", *parts))


def seeded_split(df: DataFrame, key: str, split: float = 0.8, seed: int = 42,
                 out: str = "split") -> DataFrame:
    """D3: shuffle by seed; train = int(n*split), val = rest // 2, test = the rest."""
    n = df.count()
    n_train = int(n * split)
    n_val = (n - n_train) // 2
    ranked = dense_ids(df.withColumn("_o", seeded_order(key, seed)), ["_o", key], out="_pos")
    p = F.col("_pos")
    return ranked.withColumn(out, F.when(p < n_train, "train")
                             .when(p < n_train + n_val, "val").otherwise("test")).drop("_o", "_pos")


def train_val_split(df: DataFrame, key: str, val_ratio: float = 0.1, seed: int = 42,
                    out: str = "split") -> DataFrame:
    """train = int(n*(1-r)) rows of a seeded shuffle, validation the rest."""
    n = df.count()
    n_train = int(n * (1 - val_ratio))
    ranked = dense_ids(df.withColumn("_o", seeded_order(key, seed)), ["_o", key], out="_pos")
    return ranked.withColumn(out, F.when(F.col("_pos") < n_train, "train").otherwise("validation")) \
        .drop("_o", "_pos")


def micro_batch(pos, size: int) -> Column:
    """Consecutive batches of ``size``; the last one may be short."""
    return F.floor(F.col(pos) / size).cast("bigint")


def shuffle_epoch(df: DataFrame, key: str, seed: int, epoch: int, split_col: str = "split",
                  out: str = "order_key") -> DataFrame:
    """Training rows get a per-epoch shuffled order key, val/test keep their key."""
    return df.withColumn(out, F.when(F.col(split_col) == "train", seeded_order(key, seed, epoch))
                         .otherwise(F.lpad(F.col(key).cast("string"), 20, "0")))
