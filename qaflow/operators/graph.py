"""Neighbour-graph search (E8): an edge table built by neighbour-of-neighbour joins, searched by a beam.

*Build.*  The graph is a table ``node, neighbour, score`` of at most ``degree`` edges a node.  It starts
from edges between rows that lie next to each other along a few random directions.  In each round every
node meets the neighbours of its neighbours, where one of the two edges is new since the round before;
the new pairs are scored once and offered to both ends, and each node keeps its best.  A node has at
most ``degree`` outgoing edges, so a round makes at most ``rows * degree ** 2`` pairs however many
edges point at a hub.  Rounds end when few edges change.  Last, ``degree / 2`` of the edges that point
at a node are added (best first) with the edges of the starting directions, so that every part of the
graph can be reached.

*Search.*  All queries go at once.  A query's state is its ``beam`` best rows so far.  In each round the
best unopened rows of every beam are opened: one join with the adjacency table gives their
neighbours, rows already scored for the query drop out, one join with the vectors scores the rest.
A query whose beam holds no unopened row has found its rows; when most of the queries have, they leave the
tables of the rounds, so that a round costs what the queries cost that still search.
Rounds end when no beam holds an unopened row.

Data movement: pairs are made by joins on ids and scored tile by tile (:func:`scored`); nothing but counts reaches the driver.  A hub
that many queries open at once is one key on the side that AQE splits.  Every table of a round is
written to the shared folder, so a lost executor costs at most the running round.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qaflow.operators import vectors
from qaflow.operators.split import dense_ids
from qaflow.session import scratch_path

DEGREE = 18
DIRECTIONS = 6
SETTLED = 0.01  # a build ends when fewer than this share of the edges changes in a round
MAX_ROUNDS = 12
_SCORED = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("score", pa.float64())])


def _written(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _rows(df: DataFrame, key: str, vec: str) -> DataFrame:
    """``id, v`` of the rows that have an id and a vector."""
    def kept(batches):
        for b in batches:
            yield b[b["id"].notna() & b["v"].notna()]

    out = df.select(F.col(key).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("v"))
    return _written(out.mapInPandas(kept, "id long, v array<double>").dropDuplicates(["id"]), "graph-rows")


def scored(pairs: DataFrame, left: DataFrame, right: DataFrame, block: int = vectors.BLOCK_ROWS) -> DataFrame:
    """``a, b, score``: the inner products of ``pairs(a, b)`` with ``left(id, v)`` and ``right(id, v)``.

    Both sides are dealt to parts of at most about ``block`` rows.  Pairs travel as ids to the tile of their two parts,
    a vector once to every tile of its part, so vectors are not copied once a pair.
    """
    spark = pairs.sparkSession
    cores = math.isqrt(2 * spark.sparkContext.defaultParallelism) + 1
    parts = lambda n: max(-(-n // block), min(cores, -(-n // 4096)), 1)
    n_a, n_b = parts(left.count()), parts(right.count())
    ta, tb = (lambda c: F.pmod(F.xxhash64(c), F.lit(n_a)).cast("int")), (lambda c: F.pmod(F.xxhash64(c), F.lit(n_b)).cast("int"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    sent = left.select("id", "v", F.lit(True).alias("first"), ta("id").alias("ta")).withColumn("tb", every(n_b)).unionByName(
        right.select("id", "v", F.lit(False).alias("first"), tb("id").alias("tb")).withColumn("ta", every(n_a)))

    def dot(p: pa.Table, v: pa.Table) -> pa.Table:
        a, b, first = p.column("a").to_numpy(), p.column("b").to_numpy(), v.column("first").to_numpy()
        all_ids, sides = v.column("id").to_numpy(), []
        for mask, ids in ((first, a), (~first, b)):
            own = np.flatnonzero(mask)
            own = own[np.argsort(all_ids[own], kind="stable")]
            have = all_ids[own]
            at = np.minimum(np.searchsorted(have, ids), max(0, len(own) - 1))
            sides.append((vectors.arrow_matrix(v.column("v"), own), at, have[at] == ids if len(own) else np.zeros(len(ids), bool)))
        (A, at, known), (B, bt, known_b) = sides
        keep = np.flatnonzero(known & known_b)  # as a join: a pair needs both vectors
        s = np.zeros(len(keep))
        for lo in range(0, len(keep), 8192):
            some = keep[lo:lo + 8192]
            s[lo:lo + 8192] = np.einsum("nd,nd->n", A[at[some]], B[bt[some]])
        return pa.table({"a": a[keep], "b": b[keep], "score": s}, schema=_SCORED)

    keys = ["ta", "tb"]
    return (pairs.select("a", "b", ta("a").alias("ta"), tb("b").alias("tb")).repartition(n_a * n_b, *keys).groupBy(*keys)
            .cogroup(sent.repartition(n_a * n_b, *keys).groupBy(*keys)).applyInArrow(dot, "a long, b long, score double"))


def best_of(edges: DataFrame, n: int, by: str = "a", other: str = "b") -> DataFrame:
    """The ``n`` best rows a ``by`` (ties: smaller ``other``)."""
    w = Window.partitionBy(by).orderBy(F.round("score", 6).desc(), F.col(other))
    return edges.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def _along_directions(rows: DataFrame, directions: int, reach: int) -> DataFrame:
    """Pairs of rows at most ``reach`` places apart along each of some fixed directions."""
    dim = rows.agg(F.max(F.size("v"))).first()[0] or 1
    planes = vectors.hyperplanes(dim, directions, 1)
    sent = rows.sparkSession.sparkContext.broadcast(planes)

    def project(batches):
        for b in batches:
            X = vectors._matrix(b["v"], dim)
            norm = np.linalg.norm(X, axis=1, keepdims=True)
            yield pd.DataFrame({"id": b["id"], "p": list(np.divide(X, norm, out=np.zeros_like(X), where=norm > 0) @ sent.value.T)})

    along = _written(rows.mapInPandas(project, "id long, p array<double>"), "graph-along")
    pairs = None
    for d in range(directions):
        placed = dense_ids(along.select("id", F.element_at("p", d + 1).alias("x")), ["x", "id"]).select("id", "pos")
        placed = _written(placed, "graph-place")
        shifted = placed.select(F.col("id").alias("b"), F.explode(F.sequence(F.col("pos") - reach, F.col("pos") - 1)).alias("pos"))
        found = placed.select(F.col("id").alias("a"), "pos").join(shifted, "pos").select("a", "b")
        pairs = found if pairs is None else pairs.union(found)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b", "score").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "score"))


def build_graph(df: DataFrame, key: str, vec: str, *, degree: int = DEGREE, directions: int = DIRECTIONS,
                settled: float = SETTLED, max_rounds: int = MAX_ROUNDS) -> tuple[DataFrame, DataFrame, int]:
    """``(rows id, v; graph a, near array<long>; pairs scored)``.

    ``near`` holds a node's best neighbours, then links in the other direction and along the starting
    directions, at most ``2 * degree`` in all.
    """
    rows = _rows(df, key, vec)
    start = _written(scored(_along_directions(rows, directions, 2), rows, rows), "graph-start")
    done = start.count()
    edges = _written(best_of(both_ways(start), degree).withColumn("new", F.lit(True)), "graph-edges")
    for _ in range(max_rounds):
        ab = edges.select("a", F.col("b").alias("u"), F.col("new").alias("n1"))
        uc = edges.select(F.col("a").alias("u"), "b", F.col("new").alias("n2"))
        met = ab.join(uc, "u").where("a <> b and (n1 or n2)")
        met = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        had = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        fresh = _written(scored(met.join(had, ["a", "b"], "left_anti"), rows, rows), "graph-fresh")
        offered = both_ways(fresh).withColumn("new", F.lit(True)).union(edges.select("a", "b", "score", F.lit(False).alias("new")))
        edges = _written(best_of(offered, degree), "graph-edges")
        n, changed = edges.agg(F.count("*"), F.sum(F.col("new").cast("long"))).first()
        done += fresh.count()
        if not n or changed < settled * n:
            break
    back = best_of(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "score"), degree // 2)
    links = best_of(both_ways(start), degree // 2)
    ranked = edges.select("a", "b", "score", F.lit(0).alias("kind")).union(back.select("a", "b", "score", F.lit(1).alias("kind"))) \
        .union(links.select("a", "b", "score", F.lit(2).alias("kind")))
    one = ranked.groupBy("a", "b").agg(F.min("kind").alias("kind"), F.max("score").alias("score"))
    near = F.transform(F.sort_array(F.collect_list(F.struct("kind", (-F.col("score")).alias("s"), "b"))), lambda x: x["b"])
    return rows, _written(one.groupBy("a").agg(near.alias("near")), "graph-near"), done


def graph_topk(queries: DataFrame, rows: DataFrame, graph: DataFrame, k: int, *, q_id: str, q_vec: str, beam: int = 20,
               width: int = 4, entries: int = 32) -> DataFrame:
    """Approximate top-k ``q_id, rank, c_id, score`` by beam search from ``entries`` fixed rows (all scores are exact).

    The pairs scored are left in ``_qaflow_scored``.
    """
    q = _rows(queries, q_id, q_vec)
    begin = rows.orderBy(F.xxhash64("id"), "id").limit(entries)
    first = vectors.exact_topk(q, _written(begin, "graph-entries"), min(beam, entries), q_id="id", q_vec="v", c_id="id", c_vec="v")
    state = _written(first.select(F.col("q_id").alias("a"), F.col("c_id").alias("b"), "score", F.lit(False).alias("opened")), "graph-beam")
    n_q = q.count()
    n_rows = rows.count()
    done = n_q * min(entries, n_rows)
    seen, searching, found = state.select("a", "b"), n_q, None
    while True:
        closed = state.where("not opened")
        w = Window.partitionBy("a").orderBy(F.round("score", 6).desc(), "b")
        opening = _written(closed.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= width).select("a", "b"), "graph-open")
        still = opening.select("a").distinct()
        n = still.count()
        if not n:
            break
        if 8 * n <= searching:
            still, searching = _written(still, "graph-still"), n
            ended = _written(state.join(still, "a", "left_anti"), "graph-found")
            found = ended if found is None else found.union(ended)
            state = _written(state.join(still, "a", "left_semi"), "graph-beam")
            seen = _written(seen.join(still, "a", "left_semi"), "graph-seen")
            q = _written(q.join(still.select(F.col("a").alias("id")), "id", "left_semi"), "graph-queries")
        near = opening.join(graph.select(F.col("a").alias("b"), "near"), "b").select("a", F.explode("near").alias("b")).distinct()
        pairs = _written(near.join(seen, ["a", "b"], "left_anti"), "graph-pairs")
        met = rows
        if 4 * pairs.count() <= n_rows:
            met = _written(rows.join(pairs.select(F.col("b").alias("id")).distinct(), "id", "left_semi"), "graph-met")
        fresh = _written(scored(pairs, q, met), "graph-scored")
        done += fresh.count()
        seen = seen.union(fresh.select("a", "b"))
        now = state.join(opening.withColumn("now", F.lit(True)), ["a", "b"], "left") \
            .select("a", "b", "score", (F.col("opened") | F.coalesce("now", F.lit(False))).alias("opened"))
        state = _written(best_of(now.union(fresh.select("a", "b", "score", F.lit(False).alias("opened"))), beam), "graph-beam")
    state = state if found is None else state.union(found)
    hits = state.select(F.col("a").alias("q_id"), F.col("b").alias("c_id"), "score")
    out = vectors.topk_per_query(hits, k).select("q_id", "rank", "c_id", "score")
    out._qaflow_scored = done
    return out
