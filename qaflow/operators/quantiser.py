"""Two-level coarse quantiser (E5 / E6): a tree over centroids, trained and kept on the executors.

The first level holds about the square root of ``nlist`` centroids and is the only matrix the driver
ever sees.  Each first-level cell then trains its own share of the ``nlist`` leaf centroids, in
proportion to its rows.  A round of training is one pass over the vectors, which stay partitioned
by (cell, block of at most ``BLOCK`` rows); only the leaf centroids of a cell travel to its blocks.  Every
block returns the sums of the vectors of each leaf, and the sums are added up by a tree of ``FAN_IN``
blocks at a time, so a cell that holds a third of all rows is many bounded tasks in every step.

A vector is assigned among the leaves of its ``probes`` best first-level cells, so training and
assignment cost about ``probes * sqrt(nlist)`` products a vector instead of ``nlist``.

The result depends on the vectors alone: starts are chosen by hash, and sums are of whole numbers,
which add up exactly in any order (as in :func:`qaflow.operators.vectors.train_centroids`).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qaflow.operators import vectors
from qaflow.session import scratch_path

BLOCK = 4096
FAN_IN = 32
PROBES = 4

_SUMS = "coarse int, part long, leaf int, n long, s array<long>"


def _written(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shares(sizes: dict[int, int], nlist: int) -> dict[int, int]:
    """``nlist`` leaves dealt out in proportion to ``sizes`` (largest remainders first), at least one each."""
    total = sum(sizes.values())
    exact = {c: nlist * n / total for c, n in sizes.items()}
    out = {c: max(1, math.floor(x)) for c, x in exact.items()}
    by_rest = sorted(exact, key=lambda c: (math.floor(exact[c]) - exact[c], c))
    for c in by_rest[:max(0, nlist - sum(out.values()))]:
        out[c] += 1
    for _ in range(sum(out.values()) - nlist):  # small cells were rounded up to one
        out[max(out, key=lambda c: (out[c], -c))] -= 1
    return {c: min(n, sizes[c]) for c, n in out.items()}


def _sum_tree(partial: DataFrame, fan_in: int, parts: int) -> DataFrame:
    """Adds up the rows of equal (coarse, leaf), ``fan_in`` parts of a cell at a time: ``coarse, leaf, n, s``."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        leaf, at = np.unique(pdf["leaf"].to_numpy(), return_inverse=True)
        total = np.zeros((len(leaf), len(pdf["s"].iloc[0])), dtype=np.int64)
        np.add.at(total, at, np.stack(pdf["s"].to_numpy()))
        return pd.DataFrame({"coarse": pdf["coarse"].iloc[0], "part": pdf["part"].iloc[0], "leaf": leaf,
                             "n": np.bincount(at, weights=pdf["n"]).astype(np.int64), "s": list(total)})

    while True:
        partial = partial.withColumn("part", F.floor(F.col("part") / fan_in))
        partial = partial.groupBy("coarse", "part").applyInPandas(add, _SUMS)
        parts = -(-parts // fan_in)
        if parts <= 1:
            return partial.select("coarse", "leaf", "n", "s")


def train_tree(df: DataFrame, vec: str, nlist: int, *, seed: int = 42, rounds: int = 8, block: int = BLOCK,
               fan_in: int = FAN_IN) -> tuple[DataFrame, DataFrame]:
    """E5 in two levels: ``(first level: cell int, centroid; leaves: cell int, coarse int, centroid)``.

    ``cell`` of the leaves runs from 0, in order of (coarse, place).  At most ``nlist`` leaves, fewer if there are
    fewer different vectors.  Rows whose vector is null, zero or not finite do not train.
    """
    spark = df.sparkSession
    norm = vectors.l2_norm(vec)
    data = _written(df.where((norm > 0) & (norm < float("inf"))).select(vectors.l2_normalize(vec).alias("v")), "tree-vectors")
    first = vectors.train_centroids(data, "v", max(1, math.isqrt(nlist)), seed=seed, max_iter=rounds)
    placed = vectors.nearest_cells(data, first, "v", out="coarse")
    placed = _written(placed.withColumn("no", F.xxhash64(F.monotonically_increasing_id())), "tree-placed")  # deals out copies too

    order = F.xxhash64(F.lit(seed), "v")
    distinct = placed.groupBy("coarse", "v").agg(F.count("*").alias("c"))
    counts = {r["coarse"]: (r["n"], r["d"]) for r in distinct.groupBy("coarse").agg(F.sum("c").alias("n"), F.count("*").alias("d")).collect()}
    if not counts:
        return first, spark.createDataFrame([], "cell int, coarse int, centroid array<double>")
    leaves = {c: min(n, counts[c][1]) for c, n in shares({c: x[0] for c, x in counts.items()}, nlist).items()}
    plan = spark.createDataFrame([(c, leaves[c], -(-counts[c][0] // block), sum(leaves[x] for x in leaves if x < c)) for c in leaves],
                                 "coarse int, leaves int, blocks int, first_leaf int")  # one row a first-level cell
    w = Window.partitionBy("coarse").orderBy(order, "v")
    start = distinct.withColumn("r", F.row_number().over(w)).where(F.col("r") <= max(leaves.values()))
    start = start.join(F.broadcast(plan), "coarse").where(F.col("r") <= F.col("leaves"))
    centroids = _written(start.select("coarse", (F.col("r") - 1).cast("int").alias("leaf"), F.col("v").alias("c")), "tree-start")

    salted = placed.join(F.broadcast(plan.select("coarse", "blocks")), "coarse")
    salted = salted.select("coarse", F.pmod("no", F.col("blocks").cast("long")).alias("part"), "v")
    salted = salted.repartition("coarse", "part").persist(StorageLevel.MEMORY_AND_DISK)  # recomputed from the written rows if lost

    def sums(rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("leaf")
        C = np.rint(vectors._matrix(own["c"]) * vectors.UNIT)
        total, n = np.zeros(C.shape, dtype=np.int64), np.zeros(len(C), dtype=np.int64)
        step = max(1, vectors.SCORE_CELLS // max(1, len(C)))
        for lo in range(0, len(rows), step):
            X = np.rint(vectors._matrix(rows["v"].iloc[lo:lo + step]) * vectors.UNIT)
            at = (X @ C.T).argmax(axis=1)
            by = np.argsort(at, kind="stable")
            found, begin = np.unique(at[by], return_index=True)
            total[found] += np.add.reduceat(X[by], begin, axis=0).astype(np.int64)
            n += np.bincount(at, minlength=len(C))
        used = np.flatnonzero(n)
        return pd.DataFrame({"coarse": rows["coarse"].iloc[0] if len(rows) else 0, "part": rows["part"].iloc[0] if len(rows) else 0,
                             "leaf": own["leaf"].to_numpy()[used], "n": n[used], "s": list(total[used])})

    most = max(-(-x[0] // block) for x in counts.values())
    keys = ["coarse", "part"]
    for _ in range(rounds):
        sent = centroids.join(F.broadcast(plan.select("coarse", "blocks")), "coarse") \
            .select("coarse", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)).alias("part"), "leaf", "c")
        partial = salted.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(sums, _SUMS)
        added = _sum_tree(partial, fan_in, most).withColumn("u", vectors.l2_normalize("s"))
        moved = centroids.join(added.select("coarse", "leaf", "u"), ["coarse", "leaf"], "left")
        lost = F.col("u").isNull() | ~F.exists("u", lambda x: x != 0)  # a leaf without rows, or whose rows cancel out, stays
        centroids = _written(moved.select("coarse", "leaf", F.when(lost, F.col("c")).otherwise(F.col("u")).alias("c")), "tree-leaves")
    salted.unpersist()
    out = centroids.join(F.broadcast(plan.select("coarse", "first_leaf")), "coarse")
    return first, _written(out.select((F.col("first_leaf") + F.col("leaf")).cast("int").alias("cell"), "coarse", F.col("c").alias("centroid")), "tree-cells")


def assign_tree(df: DataFrame, first: DataFrame, leaves: DataFrame, key: str, vec: str, *, probes: int = PROBES,
                block: int = BLOCK) -> DataFrame:
    """E6 in two levels: ``key, cell`` -- the best leaf (rounded product desc, cell asc) among those of the ``probes``
    best first-level cells.  A null vector has no cell, a zero vector the lowest one looked at."""
    rows = _written(df.select(F.col(key).alias("k"), F.col(vec).cast("array<double>").alias("v")), "tree-rows")
    near = vectors.nearest_cells(rows, first, "v", probes, out="coarse", as_list=True)
    unit = near.where("coarse is not null").select("k", vectors.l2_normalize("v").alias("v"), "coarse")
    spread = unit.select("k", "v", F.explode("coarse").alias("coarse"))
    sizes = F.broadcast(spread.groupBy("coarse").agg(F.ceil(F.count("*") / block).alias("blocks")))  # one row a first-level cell
    spread = spread.join(sizes, "coarse").select("coarse", F.pmod(F.xxhash64("k"), F.col("blocks")).alias("part"), "k", "v")
    sent = leaves.join(sizes, "coarse").select("coarse", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("part"), "cell", "centroid")
    schema = f"k {df.schema[key].dataType.simpleString()}, score double, cell int"

    def best(rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("cell")
        if not len(rows) or not len(own):
            return pd.DataFrame({"k": [], "score": [], "cell": []})
        C, out = vectors._matrix(own["centroid"]), []
        step = max(1, vectors.SCORE_CELLS // len(C))
        for lo in range(0, len(rows), step):
            S = np.round(vectors._matrix(rows["v"].iloc[lo:lo + step]) @ C.T, 6)
            at = S.argmax(axis=1)
            out.append(pd.DataFrame({"k": rows["k"].iloc[lo:lo + step], "score": S[np.arange(len(S)), at], "cell": own["cell"].to_numpy()[at]}))
        return pd.concat(out)

    keys = ["coarse", "part"]
    found = spread.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(best, schema)
    top = found.groupBy("k").agg(F.min(F.struct((-F.col("score")).alias("s"), "cell")).alias("b"))
    return rows.select("k").join(top, "k", "left").select(F.col("k").alias(key), F.col("b.cell").alias("cell"))
