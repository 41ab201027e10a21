"""Conversation prefix trie by truncation peeling.

Every distinct sequence of the first ``d`` turns of some conversation is a node. From the deepest level
upwards, the conversations that newly end at a level are merged with the nodes that survive from below, the
last turn is stripped, and what is left is regrouped; counts, children, leaves and saved text are added up
while the nodes are discovered, so no prefix is ever expanded for more than its own row.

How the work is spread:

* A turn travels as a 128-bit digest of (role, text) and the length of its text; texts stay in the scan. A
  sequence is the chain of the digests of its prefixes, 16 bytes a turn, so stripping a turn cuts 16 bytes.
* Conversations of equal sequence are merged first. Their ids are written as text in pieces of one block of
  ``BLOCK`` ids each, and the pieces are hashed in order, one at a time.
* A sequence is peeled in one task down to its *anchor*: the shallowest prefix, at a depth of 1, 2, 4, ...,
  that at most ``RECORDS`` distinct sequences with ``TURNS`` turns below share. A hot first turn therefore is
  split by what follows it, and no task holds more than an anchor's group.
* Above the anchors every level is one aggregate of Spark, combined before the shuffle. There are as many
  levels as the deepest prefix that more than ``RECORDS`` distinct sequences share.

Defined cases: rows without ``conv_id`` take no part. Turns are ordered by ``turn`` (null first), equal turns by
the digest of role and text; repeated rows count as further turns. Null role or text is empty. A conversation
without turns is a member of the root only. No conversations: no nodes, not even the root. Other columns are
ignored, whatever their names. One conversation's digests (20 bytes a turn) must fit in a task.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qaflow.llm.common import materialise, read

BLOCK = 1024
RECORDS = 512
TURNS = 1 << 17
WIDTH = 16  # bytes of a digest
EMPTY = hashlib.sha256(b"").hexdigest()

_SEQUENCE = "depth int, path binary, lens binary, n long, conv long, sha string"
_NODE = "conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: every conversation's turns in order, as (digest, code points of the text)."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, WIDTH)
    rows = conversations.where(F.col("conv_id").isNotNull())
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn"), digest.alias("d"), F.length(text).alias("n")).alias("t"))
    turns = F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["d"].alias("d"), t["n"].alias("n")))
    return rows.groupBy("conv_id").agg(turns.alias("turns"))


def splice(seqs: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Rebuilds every conversation ``c``: the first ``h = crc32(c) % most`` turns of conversation ``c - c % group``
    (all, if fewer; none, if absent), then its own turns after its first ``h``."""
    heads = seqs.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("head"))
    rows = seqs.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % most).cast("int"))
    rows = rows.join(heads, "base", "left")
    head = F.coalesce(F.expr("slice(head, 1, h)"), F.expr("slice(turns, 1, 0)"))
    return rows.select("conv_id", F.concat(head, F.expr("slice(turns, h + 1, greatest(size(turns) - h, 0))")).alias("turns"))


# --- conversations of equal sequence -------------------------------------------------------------

def _chain(batches):
    """Turns to the digests of all prefixes, each made of the one before and a turn."""
    for batch in batches:
        turns = batch.column(1)
        digests = turns.flatten().field("d").to_pylist()
        sizes = np.asarray(turns.flatten().field("n"), np.int32)
        ends = np.concatenate([[0], np.cumsum(np.asarray(turns.value_lengths(), np.int64))])
        end, path, lens = [], [], []
        for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist()):
            last, chain = b"", []
            for d in digests[lo:hi]:
                last = hashlib.blake2b(last + d, digest_size=WIDTH).digest()
                chain.append(last)
            end.append(last)
            path.append(b"".join(chain))
            lens.append(sizes[lo:hi].tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends), pa.int32()), pa.array(end, pa.binary()), pa.array(path, pa.binary()), pa.array(lens, pa.binary())],
                                         names=["conv_id", "depth", "end", "path", "lens"])


def _pieces(batches):
    """Rows in order of (end, block, conv_id): one row an (end, block), with its ids as text."""
    key, ids, kept = None, [], None

    def piece():
        return (*kept, ids[0], len(ids), ",".join(map(str, ids)))

    for batch in batches:
        out = []
        for conv, block, depth, end, path, lens in zip(*(c.to_pylist() for c in batch.columns)):
            if key != (end, block):
                if ids:
                    out.append(piece())
                key, ids, kept = (end, block), [], (depth, end, path, lens)
            ids.append(conv)
        if out:
            yield _batch(out, _PIECE)
    if ids:
        yield _batch([piece()], _PIECE)


def _digest(batches):
    """Rows in order of (end, first): hashes the pieces of every sequence one after the other."""
    key = state = row = None

    def record():
        depth, path, lens, n, conv = row
        return depth, path, lens, n, conv, state.hexdigest()

    for batch in batches:
        out = []
        for depth, end, path, lens, first, n, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if key != end or row is None:
                if row is not None:
                    out.append(record())
                key, state, row = end, hashlib.sha256(ids.encode()), [depth, path, lens, n, first]
            else:
                state.update(b"," + ids.encode())
                row[3] += n
        if out:
            yield _batch(out, _RECORD)
    if row is not None:
        yield _batch([record()], _RECORD)


_PIECE = pa.schema([("depth", pa.int32()), ("end", pa.binary()), ("path", pa.binary()), ("lens", pa.binary()), ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.string())])
_RECORD = pa.schema([("depth", pa.int32()), ("path", pa.binary()), ("lens", pa.binary()), ("n", pa.int64()), ("conv", pa.int64()), ("sha", pa.string())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(col, field.type) for col, field in zip(zip(*rows), schema)], schema=schema)


def distinct_sequences(seqs: DataFrame) -> DataFrame:
    """One row a distinct sequence: depth, path, lens, its conversations ``n``, the smallest, and their ids' hash."""
    rows = seqs.mapInArrow(_chain, "conv_id long, depth int, end binary, path binary, lens binary")
    rows = rows.withColumn("block", F.floor(F.col("conv_id") / BLOCK))
    rows = rows.select("conv_id", "block", "depth", "end", "path", "lens").repartition("end", "block").sortWithinPartitions("end", "block", "conv_id")
    pieces = rows.mapInArrow(_pieces, "depth int, end binary, path binary, lens binary, first long, n long, ids string")
    return pieces.repartition("end").sortWithinPartitions("end", "first").mapInArrow(_digest, _SEQUENCE)


# --- peeling -------------------------------------------------------------------------------------

def prefix(depth: int) -> Column:
    return F.substring("path", WIDTH * (depth - 1) + 1, WIDTH)


def anchored(records: DataFrame, records_most: int, turns_most: int) -> tuple[DataFrame, DataFrame]:
    """``(lower, upper)``: records with the depth ``at`` and digest ``anchor`` of their anchor, and those that end
    above any anchor."""
    upper, lower, rest, at = records.where("depth = 0"), None, records.where("depth > 0"), 1
    while True:
        rest = rest.withColumn("at", F.lit(at)).withColumn("anchor", prefix(at))
        hot = rest.groupBy("anchor").agg(F.count("*").alias("c"), F.sum(F.col("depth") - F.col("at") + 1).alias("t"))
        hot = materialise(hot.where((F.col("c") > records_most) | (F.col("t") > turns_most) & (F.col("c") > 1)).select("anchor"), "trie-hot")
        if hot.isEmpty():
            return (rest if lower is None else lower.union(rest)), upper
        cold = rest.join(hot, "anchor", "left_anti").select(*rest.columns)
        lower = cold if lower is None else lower.union(cold)
        rest = materialise(rest.join(hot, "anchor", "left_semi").select(*records.columns), "trie-rest")
        at *= 2
        upper, rest = upper.union(rest.where(F.col("depth") < at)), rest.where(F.col("depth") >= at)


class Node:
    __slots__ = ("conv", "n", "children", "leaves", "saved", "sha", "path", "lens")

    def __init__(self, path, lens):
        self.conv, self.n, self.children, self.leaves, self.saved, self.sha, self.path, self.lens = None, 0, 0, 0, 0, EMPTY, path, lens

    def merge(self, n, conv):
        self.n += n
        self.conv = conv if self.conv is None else min(self.conv, conv)


def peel(records, at: int):
    """Rows of the nodes of one anchor's group, deepest first: (depth, parent's conv, node); the anchor comes last,
    with None for its parent. ``records``: (depth, path, lens, n, conv, sha)."""
    ended = defaultdict(list)
    for r in records:
        ended[r[0]].append(r)
    below: list[Node] = []
    for depth in range(max(ended), at - 1, -1):
        lo, level = WIDTH * (depth - 1), {}

        def node(path, lens):
            key = path[lo:lo + WIDTH]
            if key not in level:
                level[key] = Node(path, lens)
            return level[key]

        for child in below:
            up = node(child.path, child.lens)
            up.merge(child.n, child.conv)
            up.children += 1
            up.leaves += child.leaves
            up.saved += child.saved
        for _, path, lens, n, conv, sha in ended.get(depth, ()):
            up = node(path, lens)
            up.merge(n, conv)
            up.sha = sha
        for child in below:
            yield depth + 1, node(child.path, child.lens).conv, child
        for up in level.values():
            up.leaves = up.leaves or 1
            up.saved += (up.n - 1) * int.from_bytes(up.lens[4 * (depth - 1):4 * depth], "little")
        below = list(level.values())
    for anchor in below:
        yield at, None, anchor


_PEELED = pa.schema([("conv_id", pa.int64()), ("depth", pa.int32()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
                     ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("path", pa.binary()), ("lens", pa.binary())])


def _peel_groups(batches):
    """Rows in order of anchor: peels one group after the other. Only anchors keep a path, cut to their depth."""
    key, group, out = None, [], []

    def rows():
        at = key[0]
        for depth, parent, x in peel(group, at):
            top = parent is None
            yield x.conv, depth, parent, x.n, x.children, x.leaves, x.saved, x.sha, x.path[:WIDTH * at] if top else None, x.lens[:4 * at] if top else None

    for batch in batches:
        for at, anchor, *record in zip(*(c.to_pylist() for c in batch.columns)):
            if key != (at, anchor):
                if group:
                    out += rows()
                key, group = (at, anchor), []
                if len(out) > 8192:
                    yield _batch(out, _PEELED)
                    out = []
            group.append(record)
    if group:
        out += rows()
    if out:
        yield _batch(out, _PEELED)


def _levels(upper: DataFrame, anchors: DataFrame) -> DataFrame:
    """Peels what lies above the anchors level by level, down to the root: rows like ``anchors``, anchors included."""
    kinds = ["conv", "n", "children", "leaves", "saved", "sha", "path", "lens"]
    ended = upper.select("depth", "conv", "n", F.lit(0).cast("long").alias("children"), F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"), "sha", "path", "lens")

    def stripped(nodes: DataFrame, depth: int) -> DataFrame:
        """What nodes of ``depth`` give to their parents."""
        return nodes.select(F.col("conv_id").alias("conv"), F.col("n_convs").alias("n"), F.lit(1).cast("long").alias("children"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"),
                            F.lit(None).cast("string").alias("sha"), F.substring("path", 1, WIDTH * (depth - 1)).alias("path"), F.substring("lens", 1, 4 * (depth - 1)).alias("lens"))

    deepest = ended.select("depth").union(anchors.select("depth")).agg(F.max("depth")).first()[0]
    done, below = [anchors], None
    for depth in range(-1 if deepest is None else deepest, -1, -1):
        rows = ended.where(F.col("depth") == depth).select(*kinds)
        rows = rows if below is None else rows.union(below)
        total = rows.groupBy("path").agg(F.min("conv").alias("conv_id"), F.sum("n").alias("n_convs"), F.sum("children").alias("n_children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
                                         F.coalesce(F.max("sha"), F.lit(EMPTY)).alias("ends_sha256"), F.first("lens").alias("lens"))
        level = total.select("conv_id", F.lit(depth).alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children", F.greatest("leaves", F.lit(1)).alias("n_leaves"),
                             (F.col("saved") + (F.col("n_convs") - 1) * _last_length(depth)).alias("saved_tokens"), "ends_sha256", "path", "lens")
        level = materialise(level, "trie-level")
        done.append(level)
        below = stripped(level.union(anchors.where(F.col("depth") == depth)), depth) if depth else None
    out = done[0]
    for level in done[1:]:
        out = out.union(level)
    return out


def _last_length(depth: int) -> Column:
    """The last of the lengths in ``lens`` (four bytes each, the lowest first)."""
    if not depth:
        return F.lit(0).cast("long")
    byte = lambda i: F.conv(F.hex(F.substring("lens", 4 * (depth - 1) + 1 + i, 1)), 16, 10).cast("long")
    return byte(0) + byte(1) * 256 + byte(2) * 65536 + byte(3) * 16777216


def prefix_trie(seqs: DataFrame, records_most: int = RECORDS, turns_most: int = TURNS) -> DataFrame:
    """Every node of the trie of ``seqs(conv_id, turns)``: its smallest member, depth, parent's smallest member (root:
    null), members, children, leaves below, ``saved_tokens`` (over its subtree, members but one times the last
    text's length) and the hash of the ids of the conversations that end there."""
    records = materialise(distinct_sequences(seqs), "trie-sequences")
    lower, upper = anchored(records, records_most, turns_most)
    lower = lower.select("at", "anchor", "depth", "path", "lens", "n", "conv", "sha").repartition("anchor").sortWithinPartitions("at", "anchor")
    peeled = materialise(lower.mapInArrow(_peel_groups, f"{_NODE}, path binary, lens binary"), "trie-peeled")
    top = materialise(_levels(upper, peeled.where("path is not null")), "trie-top")

    columns = [c.split()[0] for c in _NODE.split(", ")]
    own = top.select(*(c for c in columns if c != "parent_conv_id"), F.when(F.col("depth") > 0, F.expr(f"substring(path, 1, {WIDTH} * (depth - 1))")).alias("up"))
    parents = top.select(F.col("path").alias("up"), F.col("conv_id").alias("parent_conv_id"), "depth")
    root = F.broadcast(parents.where("depth = 0").drop("depth"))  # one row
    first = own.where("depth = 1").join(root, "up", "left")
    rest = own.where("depth <> 1").join(parents.where("depth > 0").drop("depth"), "up", "left")
    return peeled.where("path is null").select(*columns).union(first.select(*columns)).union(rest.select(*columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    seqs = materialise(sequences(read(spark, sf_dir, "conversations")), "trie-turns")
    nodes = prefix_trie(splice(seqs))
    return nodes.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS turns
  FROM t GROUP BY conv_id
), digits AS (  -- every byte, then eight times -1: shift
  SELECT conv_id, flatten(list_transform(range(1, length(conv_id::VARCHAR) + 1),
           lambda i: [ascii(substring(conv_id::VARCHAR, i::BIGINT, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])) AS steps
  FROM own
), crc AS (
  SELECT conv_id, (4294967295 - list_reduce(steps, lambda s, e:
           CASE WHEN e >= 0 THEN xor(s, e) ELSE xor(s >> 1, 3988292384 * (s & 1)) END, 4294967295::BIGINT)) % 6 AS h
  FROM digits
), rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns[1:c.h], []), coalesce(o.turns[c.h + 1:], [])) AS turns
  FROM own o JOIN crc c USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100
), prefixes AS (
  SELECT conv_id, len(turns) AS whole, d, turns[1:d] AS p FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT d, p, min(conv_id) AS conv_id, count(*) AS n,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE whole = d), '')) AS ends
  FROM prefixes GROUP BY d, p
), linked AS (
  SELECT c.*, u.conv_id AS parent, (c.n - 1) * CASE WHEN c.d = 0 THEN 0 ELSE length(c.p[c.d].t) END AS own_saved
  FROM nodes c LEFT JOIN nodes u ON u.d = c.d - 1 AND u.p = c.p[1:c.d - 1]
), kids AS (
  SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2
), full_nodes AS (
  SELECT l.*, coalesce(k.n, 0) AS children FROM linked l LEFT JOIN kids k ON k.d = l.d AND k.p = l.p
), above AS (
  SELECT k AS d, p[1:k] AS p, sum(own_saved) AS saved, count(*) FILTER (WHERE children = 0) AS leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM full_nodes) GROUP BY 1, 2
)
SELECT f.conv_id, f.d AS depth, f.parent AS parent_conv_id, f.n AS n_convs, f.children AS n_children,
       a.leaves AS n_leaves, a.saved::BIGINT AS saved_tokens, f.ends AS ends_sha256
FROM full_nodes f JOIN above a ON a.d = f.d AND a.p = f.p
"""
