"""Aggregations and set operations.

Every metric is a Column expression evaluated per row and then one
``groupBy(...).agg`` -- partial aggregation map-side, one small shuffle.
"""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from qaflow.functions import text as T


# --- T1-T4 ------------------------------------------------------------------

def union_shards(*dfs: DataFrame) -> DataFrame:
    """Bag union by column name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def set_intersect(a, b) -> Column:
    """Set intersection of two lists."""
    return F.array_intersect(T._c(a), T._c(b))


multiset_intersect_size = T.bag_overlap  # T3


def flatten(x) -> Column:
    """T4: list of lists -> list."""
    return F.flatten(T._c(x))


# --- per-row scores ---------------------------------------------------------

def score_answers(df: DataFrame, pred: str = "prediction", golds: str = "golds") -> DataFrame:
    """EM (F3, any gold) and F1 (F5, max over golds) per row, reference family A."""
    return df.withColumn("em", T.em_a(pred, golds)).withColumn(
        "f1", F.coalesce(T.max_over_golds(T.f1_set, pred, golds), F.lit(0.0)))


# --- G1 / G2 / G3 -----------------------------------------------------------

def qa_summary(scored: DataFrame, by=("mode",)) -> DataFrame:
    """G1: mean EM, mean F1 (0-1), R@k = hits / n per group."""
    return scored.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.avg("em").alias("em"),
        F.avg("f1").alias("f1"),
        (F.sum("hit") / F.count("*")).alias("recall"))


def checkpoint_sweep(scored: DataFrame, checkpoint: str = "checkpoint", by=("mode",)) -> DataFrame:
    """Every checkpoint evaluated in one aggregation, the checkpoint a grouping column."""
    return qa_summary(scored, by=[checkpoint, *by])


def qa_summary_pct(df: DataFrame, pred: str = "prediction", golds: str = "golds", by=()) -> DataFrame:
    """EM and F1 in percent, max over golds, normaliser B.

    An empty input gives NULL rather than the reference's division by zero.
    """
    em = T.max_over_golds(lambda p, g: T.em_b(p, g), pred, golds)
    f1 = T.max_over_golds(T.f1_bag, pred, golds)
    return df.groupBy(*by).agg((100.0 * F.avg(em)).alias("em"), (100.0 * F.avg(f1)).alias("f1"))


def precision_at_k(hyp, ref, k: int) -> Column:
    """G3 per row: |set(first k of hyp) ∩ set(ref)| / k (always divided by k)."""
    return F.size(F.array_intersect(F.array_distinct(F.slice(T._c(hyp), 1, k)),
                                    F.array_distinct(T._c(ref)))) / F.lit(float(k))


def exact_match_rate(df: DataFrame, em: str = "em") -> DataFrame:
    """Mean EM over paired rows, 0 when there are none."""
    return df.agg(F.coalesce(F.avg(em), F.lit(0.0)).alias("em"))


def batch_mean_of_means(df: DataFrame, batch: str, cols: list[str]) -> DataFrame:
    """Mean of per-batch means, every batch weighted equally."""
    per = df.groupBy(batch).agg(*[F.avg(c).alias(c) for c in cols])
    return per.agg(*[F.avg(c).alias(c) for c in cols])


def observed(df: DataFrame, name: str, **aggregates: Column) -> tuple[DataFrame, Observation]:
    """``df`` with aggregates that the next action over it computes on the way (G8, G13): no job of their own."""
    seen = Observation(name)
    return df.observe(seen, *[c.alias(k) for k, c in (aggregates or {"n": F.count(F.lit(1))}).items()]), seen


def throughput_report(df: DataFrame, mode: str, path: str | None = None) -> DataFrame:
    """Answered rows, seconds and rows/s of one action over ``df``.

    The action writes ``df`` to ``path`` (K5; without one, to nowhere) and is counted as it writes.
    """
    counted, seen = observed(df, f"throughput-{mode}")
    t0 = time.perf_counter()
    if path is None:
        counted.write.format("noop").mode("overwrite").save()
    else:
        counted.write.mode("overwrite").parquet(path)
    secs = time.perf_counter() - t0
    n = seen.get["n"]
    return df.sparkSession.createDataFrame([(mode, n, secs, n / secs if secs > 0 else None)],
                                           "mode string, answered bigint, seconds double, qps double")


def mean_output_length(df: DataFrame, ids: str) -> DataFrame:
    """Mean generated length."""
    return df.agg(F.avg(F.size(ids)).alias("gen_len"))


def mode_comparison(summary: DataFrame, metrics=("em", "f1", "recall")) -> DataFrame:
    """G10 wide form: one row per metric, one column per mode."""
    stacked = summary.select("mode", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics
    ])).alias("x")).select("mode", "x.metric", "x.v")
    return stacked.groupBy("metric").pivot("mode").agg(F.first("v")).orderBy("metric")


SEGMENT = 4096  # steps a segment of a history


def _through_segments(rows: DataFrame, by: list[str], **parts) -> DataFrame:
    """``rows`` with what all earlier segments of their history come to: of each of ``parts`` the first aggregates one
    segment, the second is a running window over those."""
    segments = rows.groupBy(*by, "_seg").agg(*[partial.alias(name) for name, (partial, _) in parts.items()])  # one row a segment
    before = Window.partitionBy(*by).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(segments.select(*by, "_seg", *[merged(name).over(before).alias(name) for name, (_, merged) in parts.items()]), [*by, "_seg"])


def best_checkpoint(history: DataFrame, metric: str, *, mode: str = "max", patience: int = 3,
                    step: str = "step", by=(), segment: int = SEGMENT) -> DataFrame:
    """Best checkpoint per metric history and the early-stop step.

    ``mode='min'`` for losses (the reference always maximises).  Patience:
    the first step that is the ``patience``-th consecutive check without a
    new best stops training.  Steps are unique in a history.

    A history is cut into segments of ``segment`` steps.  Each is summed up by itself (its best value, its
    rows, its last improvement), the summaries are merged in order, and each segment is then
    read once more with what came before it.  No window runs over more rows than a segment has, or
    than a history has segments, so one long history is many tasks.
    """
    if not by:
        out = best_checkpoint(history.withColumn("_all", F.lit(0)), metric, mode=mode,
                              patience=patience, step=step, by=["_all"], segment=segment)
        return out.drop("_all")
    by, sign = list(by), 1.0 if mode == "max" else -1.0
    h = history.select(*by, F.col(step).alias("_step"), (F.col(metric) * F.lit(sign)).alias("_v"),
                       F.floor(F.col(step) / segment).alias("_seg"))
    h = _through_segments(h, by, _best_in=(F.max("_v"), F.max), _rows_in=(F.count("*"), F.sum))
    own = Window.partitionBy(*by, "_seg").orderBy("_step")
    before = F.greatest("_best_in", F.max("_v").over(own.rowsBetween(Window.unboundedPreceding, -1)))
    h = h.withColumn("_new", before.isNull() | F.coalesce(F.col("_v") > before, F.lit(False)))
    h = h.withColumn("_at", F.coalesce("_rows_in", F.lit(0)) + F.row_number().over(own)).withColumn("_hit", F.when(F.col("_new"), F.col("_at")))
    h = _through_segments(h, by, _hit_in=(F.max("_hit"), F.max))
    last = F.greatest("_hit_in", F.max("_hit").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    stop = h.withColumn("_since", F.col("_at") - last).where(F.col("_since") >= patience).groupBy(*by).agg(F.min("_step").alias("stopped_at"))
    best = h.groupBy(*by).agg(F.max_by("_step", F.struct("_v", -F.col("_step"))).alias("best_step"), (F.max("_v") * F.lit(sign)).alias("best"))
    return best.join(stop, by, "left")


def total_steps(n_rows: Column, batch: int, accumulate: int, devices: int, epochs: int) -> Column:
    """Optimisation steps for a run."""
    return (n_rows / F.lit(batch * accumulate * max(devices, 1)) * F.lit(epochs)).cast("double")


def char_lengths(df: DataFrame, text: str, by=()) -> DataFrame:
    """Min / avg / max character length."""
    L = F.length(text)
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.min(L).alias("min_len"),
                               F.avg(L).alias("avg_len"), F.max(L).alias("max_len"))
