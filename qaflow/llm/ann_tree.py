"""Approximate nearest neighbours by a hierarchical k-means tree with best-bin-first traversal.

*Tree.* Spherical k-means with ``BRANCH`` children a node, fitted on a hashed sample of at most ``FIT_ROWS``
distinct vectors (and ``FIT_BYTES``), down to leaves of about ``LEAF`` sample vectors. Only this bounded
sample reaches the driver; the tree is smaller than the sample and is broadcast. Every row is indexed.

*Traversal.* A query holds a priority queue of nodes, nearest centre first; popping an inner node pushes its
children, popping a leaf visits it. How many leaves are visited is calibrated: up to ``CALIBRATION`` queries
are compared with all vectors in double precision, and visits widen leaf by leaf until the share of their
true neighbours that stand in a visited leaf reaches ``TARGET``. A query whose leaves hold fewer than ``k + 1``
entries goes on until they do, or no leaf is left. The recall reached in calibration is a column of the result.

*Search.* Equal vectors are one entry with its ``k + 1`` smallest ids (no more can be among ``k`` results),
so a vector that a third of all rows hold is scored once. Leaves travel in groups of ``GROUP`` that follow each
other in the tree. A query sends one row to each group in which it visits a leaf, with a bit for each leaf
that it visits. Groups and their queries are cut into blocks; a task scores one block of each at a time, leaves
out the entries of leaves that a query does not visit, and keeps the best ``k + 1`` a query.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
those of another length than the commonest (the longer of two as common), nor rows without an id. Of rows
that repeat an id the least vector stays. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from qaflow.llm.common import materialise, read

BRANCH = 8
LEAF = 24
FIT_ROWS = 32768
FIT_BYTES = 64 << 20
CALIBRATION = 256
TARGET = 0.97
BLOCK = 4096
QUERY_BLOCK = 512
GROUP = 63  # leaves that one row's bits can name


class Tree:
    """Nodes in breadth-first order; the children of an inner node are contiguous."""

    def __init__(self, centres: np.ndarray, first: np.ndarray, count: np.ndarray):
        self.centres, self.first, self.count = centres, first, count

    def leaf_of(self, units: np.ndarray) -> np.ndarray:
        """The leaf that the nearest child at every level leads to."""
        at = np.zeros(len(units), np.int64)
        todo = np.arange(len(units)) if self.count[0] else np.zeros(0, np.int64)
        while len(todo):
            order = todo[np.argsort(at[todo], kind="stable")]
            nodes, starts = np.unique(at[order], return_index=True)
            for node, rows in zip(nodes, np.split(order, starts[1:])):
                lo, n = self.first[node], self.count[node]
                at[rows] = lo + (units[rows] @ self.centres[lo:lo + n].T).argmax(1)
            todo = todo[self.count[at[todo]] > 0]
        return at

    def visits(self, unit: np.ndarray, most: int | None = None, held: np.ndarray | None = None, least: int = 0) -> list[int]:
        """Leaves in best-bin-first order: ``most`` of them, or more until they hold ``least`` entries (``held`` of each)."""
        near = self.centres @ unit
        queue, out, entries = [(0.0, 0)], [], 0
        while queue and (most is None or len(out) < most or entries < least):
            _, node = heapq.heappop(queue)
            lo, n = int(self.first[node]), int(self.count[node])
            if not n:
                out.append(node)
                entries += int(held[node]) if held is not None else 0
            for child in range(lo, lo + n):
                heapq.heappush(queue, (-float(near[child]), child))
        return out


    def groups(self, most: int = GROUP) -> tuple[np.ndarray, np.ndarray]:
        """Of every leaf its group and its place there (-1 for inner nodes): leaves in depth-first order, so that near ones
        are together, ``most`` a group."""
        group, place = np.full(len(self.count), -1), np.full(len(self.count), -1)
        stack, seen = [0], 0
        while stack:
            node = stack.pop()
            lo, n = int(self.first[node]), int(self.count[node])
            if n:
                stack += range(lo, lo + n)
            else:
                group[node], place[node] = divmod(seen, most)
                seen += 1
        return group, place


def _kmeans(units: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    centres = units[rng.choice(len(units), k, replace=False)]
    for _ in range(rounds):
        label = (units @ centres.T).argmax(1)
        total = np.zeros_like(centres)
        np.add.at(total, label, units)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        centres = np.where(norm > 0, total / np.where(norm > 0, norm, 1), centres)
    return centres, (units @ centres.T).argmax(1)


def fit_tree(units: np.ndarray, branch: int = BRANCH, leaf: int = LEAF, seed: int = 7) -> Tree:
    rng = np.random.default_rng(seed)
    centres, first, count = [np.zeros(units.shape[1])], [0], [0]
    queue = [(0, np.arange(len(units)))]
    for node, rows in queue:
        if len(rows) <= leaf:
            continue
        found, label = _kmeans(units[rows], min(branch, len(rows)), rng)
        used = np.unique(label)
        if len(used) < 2:
            continue
        first[node], count[node] = len(centres), len(used)
        for j in used:
            queue.append((len(centres), rows[label == j]))
            centres.append(found[j])
            first.append(0)
            count.append(0)
    return Tree(np.array(centres), np.array(first, np.int64), np.array(count, np.int64))


def _matrix(col: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return np.asarray(col.flatten(), np.float64).reshape(len(col), -1) if len(col) else np.zeros((0, 1))


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def best(q: np.ndarray, c: np.ndarray, least: np.ndarray, k: int, allowed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` candidates of largest cosine for every query (ties: smaller ``least``), as query index,
    candidate index, score. A product of matrices finds them; scores are summed pair by pair, so they don't
    depend on the block. ``allowed`` says which candidates a query may take."""
    near = _unit(q) @ _unit(c).T
    if allowed is not None:
        near[~allowed] = -np.inf
    k = min(k, len(c))
    bound = np.partition(near, len(c) - k, axis=1)[:, len(c) - k] - 1e-9
    i, j = np.nonzero((near >= bound[:, None]) & (near > -np.inf))
    if not len(i):
        return i, j, np.zeros(0)
    score = np.concatenate([(q[i[s:s + 65536]] * c[j[s:s + 65536]]).sum(1) for s in range(0, len(i), 65536)])
    score /= np.linalg.norm(q, axis=1)[i] * np.linalg.norm(c, axis=1)[j]
    order = np.lexsort((least[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    keep = np.arange(len(i)) - np.searchsorted(i, i) < k
    return i[keep], j[keep], score[keep]


def valid_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, v`` of the rows that take part, one an id."""
    v = F.transform(F.col(vector).cast("array<double>"), lambda x: x + F.lit(0.0))
    rows = rows.select(F.col(key).cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    rows = rows.where(~F.exists("v", bad) & F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    rows = rows.where(F.size("v") == (common["n"] if common else 0))
    return materialise(rows.groupBy("id").agg(F.min("v").alias("v")), "ann-rows")


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """``rep, ids, v``: every distinct vector with its ``k + 1`` smallest ids, of which ``rep`` is the least."""
    few = rows.withColumn("no", F.row_number().over(W.partitionBy("v").orderBy("id"))).where(F.col("no") <= k + 1)
    out = few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return out.select(F.col("ids")[0].alias("rep"), "ids", "v")


def _hashed(rows: DataFrame, n: int, most: int, seed: int) -> DataFrame:
    """About 0.9 * ``most`` of ``n`` rows by a hash of ``rep`` (all, if fewer), never more than ``most``."""
    if n > 0.9 * most:
        rows = rows.where(F.pmod(F.xxhash64("rep", F.lit(seed)), F.lit(1 << 30)) < int(0.9 * most / n * (1 << 30)))
    return rows.limit(most)


def calibrate(indexed: DataFrame, queries: DataFrame, tree: Tree, k: int, target: float = TARGET) -> tuple[int, float]:
    """``(visits, recall)``: the fewest leaves to visit for ``target``, and the recall that they give, on a bounded
    sample of ``queries(rep, v)`` compared with every row of ``indexed(rep, ids, v, leaf)``."""
    spark = indexed.sparkSession
    got = _hashed(queries, queries.count(), CALIBRATION, 11).toArrow()
    if not got.num_rows:
        return 1, 1.0
    own, vectors = np.array(got["rep"]), _matrix(got["v"])
    sent = spark.sparkContext.broadcast((own, vectors))

    def score(batches):
        own, q = sent.value
        for batch in batches:
            rep, c, leaf = np.array(batch.column(0)), _matrix(batch.column(1)), np.array(batch.column(2))
            for lo in range(0, len(rep), BLOCK):
                i, j, s = best(q, c[lo:lo + BLOCK], rep[lo:lo + BLOCK], k + 1)
                yield pa.RecordBatch.from_arrays([pa.array(own[i]), pa.array(rep[lo + j]), pa.array(leaf[lo + j]), pa.array(s)], names=["q", "rep", "leaf", "score"])

    hits = indexed.select("rep", "v", "leaf").mapInArrow(score, "q long, rep long, leaf long, score double").where("q <> rep")
    place = W.partitionBy("q").orderBy(F.desc("score"), "rep")
    true = hits.withColumn("no", F.row_number().over(place)).where(F.col("no") <= k).select("q", "leaf").toArrow()
    if not true.num_rows:
        return 1, 1.0
    n_leaves = int((tree.count == 0).sum())
    ranks = []
    of, leaf = np.array(true["q"]), np.array(true["leaf"])
    for rep, unit in zip(own, _unit(vectors)):
        order = np.full(len(tree.count), n_leaves)
        seen = tree.visits(unit)
        order[seen] = np.arange(len(seen))
        ranks.append(order[leaf[of == rep]])
    found = np.bincount(np.concatenate(ranks), minlength=n_leaves).cumsum() / len(leaf)
    visits = int(np.argmax(found >= target)) + 1
    return visits, float(found[visits - 1])


def build_index(distinct: DataFrame, tree: Tree) -> DataFrame:
    """``distinct`` with the ``leaf`` of every row, written to the shared folder."""
    sent = distinct.sparkSession.sparkContext.broadcast(tree)

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sent.value.leaf_of(_unit(_matrix(batch.column(2)))))], names=["rep", "ids", "v", "leaf"])

    return materialise(distinct.mapInArrow(assign, "rep long, ids array<long>, v array<double>, leaf long"), "ann-index")


def search(indexed: DataFrame, queries: DataFrame, tree: Tree, visits: int, k: int) -> DataFrame:
    """``q, ids, score``: the best ``k`` vectors that each of ``queries(rep, v)`` meets in its ``visits`` leaves, or in more
    until they hold ``k``."""
    spark = indexed.sparkSession
    group, place = tree.groups()
    held = np.zeros(len(tree.count), np.int64)
    for r in indexed.groupBy("leaf").count().collect():  # one row a leaf: fewer than the bounded sample has rows
        held[r["leaf"]] = r["count"]
    sent = spark.sparkContext.broadcast((tree, group, place, held))

    def walk(batches):
        tree, group, place, held = sent.value
        for batch in batches:
            rep, units = np.array(batch.column(0)), _unit(_matrix(batch.column(1)))
            for lo in range(0, len(rep), 256):
                of, where, bits = [], [], []
                for i, unit in enumerate(units[lo:lo + 256], lo):
                    went = np.array(tree.visits(unit, visits, held, k), np.int64)
                    went = went[held[went] > 0]
                    own = group[went]
                    found = np.unique(own)
                    of.append(np.full(len(found), i))
                    where.append(found)
                    bits.append([int(np.bitwise_or.reduce(np.int64(1) << place[went[own == g]])) for g in found])
                of = np.concatenate(of)
                yield pa.RecordBatch.from_arrays([pa.array(rep[of]), batch.column(1).take(pa.array(of)), pa.array(np.concatenate(where).astype(np.int64)), pa.array(np.concatenate(bits).astype(np.int64))],
                                                 names=["q", "v", "grp", "bits"])

    asked = materialise(queries.select("rep", "v").mapInArrow(walk, "q long, v array<double>, grp long, bits long"), "ann-visits")
    leaves = np.flatnonzero(tree.count == 0)
    places = F.broadcast(spark.createDataFrame([(int(x), int(group[x]), int(place[x])) for x in leaves], "leaf long, grp long, place int"))
    entries = indexed.join(places, "leaf").select("rep", "ids", "v", "grp", "place")
    cut = lambda n, size: F.greatest(F.ceil(n / size), F.lit(1)).cast("int")
    # one row a group, and the tree has fewer nodes than its bounded sample has rows
    sizes = entries.groupBy("grp").agg(cut(F.count("*"), BLOCK).alias("cs")).join(asked.groupBy("grp").agg(cut(F.count("*"), QUERY_BLOCK).alias("qs")), "grp")
    sizes = F.broadcast(materialise(sizes, "ann-groups"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    block = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    left = asked.join(sizes, "grp").select("q", "v", "bits", "grp", block("q", "qs").alias("qb"), every("cs").alias("cb"))
    right = entries.join(sizes, "grp").select("rep", "ids", "v", "place", "grp", every("qs").alias("qb"), block("rep", "cs").alias("cb"))

    def tile(a: pa.Table, b: pa.Table) -> pa.Table:
        if not (a.num_rows and b.num_rows):
            return pa.table({"q": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int64())), "score": pa.array([], pa.float64())})
        allowed = (np.array(a["bits"])[:, None] >> np.array(b["place"])[None, :].astype(np.int64) & 1).astype(bool)
        i, j, s = best(_matrix(a["v"]), _matrix(b["v"]), np.array(b["rep"]), k, allowed)
        return pa.table({"q": np.array(a["q"])[i], "ids": b["ids"].combine_chunks().take(pa.array(j)), "score": s})

    key = ["grp", "qb", "cb"]
    hits = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(tile, "q long, ids array<long>, score double")
    nearest_first = W.partitionBy("q").orderBy(F.desc("score"), F.col("ids")[0])
    return hits.withColumn("no", F.row_number().over(nearest_first)).where(F.col("no") <= k).drop("no")


def nearest(rows: DataFrame, asks: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", target: float = TARGET) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row whose id (column ``id``) fulfils ``asks``, the ``k`` nearest found; and
    ``calibrated_recall``, the share of true neighbours found in calibration."""
    rows = valid_vectors(rows, key, vector)
    distinct = materialise(distinct_vectors(rows, k), "ann-distinct")
    n = distinct.count()
    head = distinct.select(F.size("v")).first()
    most = min(FIT_ROWS, FIT_BYTES // (8 * head[0])) if head else 1
    # in order of rep, so that the tree doesn't depend on the order in which tasks end
    sample = _matrix(_hashed(distinct, n, most, 3).select("rep", "v").toArrow().sort_by("rep")["v"]) if n else np.ones((1, 1))
    tree = fit_tree(_unit(sample))
    indexed = build_index(distinct, tree)
    asked = materialise(rows.where(asks).join(distinct.select("rep", "v"), "v").select(F.col("id").alias("query_id"), "rep"), "ann-queries")
    queries = distinct.join(asked.select("rep").distinct(), "rep", "left_semi").select("rep", "v")
    visits, recall = calibrate(indexed, queries, tree, k, target)
    hits = search(indexed, queries, tree, visits, k + 1)
    pairs = asked.join(hits, asked["rep"] == hits["q"]).select("query_id", F.explode("ids").alias("vec_id"), "score").where("query_id <> vec_id")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", F.lit(recall).alias("calibrated_recall"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("id") % 50 == 0)
