"""Parts shared by the similarity operators: candidate runs, and exact verification in tiles.

Candidates: every task sends ``(key, vertex, size)`` entries; two vertices that share a key and whose
sizes allow the similarity are candidates. Entries of a key are chained, by size, into runs already in
the task that makes them, and only one entry a run (its smallest vertex, its size range) is shuffled, as
arrays in binary rows. So a key that a third of all rows hold costs a task at most one entry a run, and
no large group is ever expanded into pairs: a run gives a star of edges to its smallest vertex.

Where the entries are the first keys of sets in a common order, keys that at most ``SHORT`` vertices hold
give pairs instead, and a pair is a candidate only with as many such keys in common as its sizes ask for
(``shared``). So documents that share a few rare keys by chance never join up to components. A pair that
has a key in common which more vertices hold is joined by that key's star.

Verification: the stars' components hold every true link. Where bitmaps of the sets are asked for, they are made
of the components' sets, and the same tiles as below first split the components by the bitmaps' bound alone. A component's vertices are dealt into tiles in
two rounds: blocks of about ``block`` vertices with a few leaders in each, which joins up a group of
copies while every set moves once; then, only for what is still apart in a large component, pairs of
blocks of size bands. In a tile, hashed parity bitmaps bound the overlap of two sets from above, and what
passes is intersected exactly as sorted arrays; vertices that are already joined are not compared again,
so a tile returns a spanning forest of its links and loses none.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaflow.llm.common import connected_components, materialise, may_match, mix, partitions

FLUSH = 500_000
SENT_BYTES = 4 << 20
BITMAP_WORDS = 128
BLOCK = 128
SKETCH_BLOCK = 1024
PAIR_SIZE = 1 << 19
LEAST_SIZE = 128
LEADERS = 6
SHORT = 8
ENTRY = np.dtype([("key", "<u8"), ("vertex", "<i8"), ("lo", "<i4"), ("hi", "<i4")])
EDGE = np.dtype([("a", "<i8"), ("b", "<i8")])
_ROW = "part int, edges boolean, data binary"


def runs(e: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Chain entries of a key whose size ranges may hold similar sets (``den * small >= num * large``):
    the runs, and an edge from every vertex to its run's smallest."""
    if not len(e):
        return e, np.zeros(0, EDGE)
    e = e[np.lexsort((e["lo"], e["key"]))]
    new_key = np.ones(len(e), bool)
    new_key[1:] = e["key"][1:] != e["key"][:-1]
    group = np.cumsum(new_key).astype(np.int64) << 32
    top = np.maximum.accumulate(group | e["hi"]) & 0xFFFFFFFF
    first = new_key.copy()
    first[1:] |= den * top[:-1] < num * e["lo"][1:].astype(np.int64)
    at = np.flatnonzero(first)
    out = np.zeros(len(at), ENTRY)
    out["key"], out["lo"] = e["key"][at], e["lo"][at]
    out["vertex"], out["hi"] = np.minimum.reduceat(e["vertex"], at), np.maximum.reduceat(e["hi"], at)
    leader = np.repeat(out["vertex"], np.diff(np.append(at, len(e))))
    other = e["vertex"] != leader
    edges = np.zeros(int(other.sum()), EDGE)
    edges["a"], edges["b"] = e["vertex"][other], leader[other]
    return out, np.unique(edges)


def single_keys(e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries without repeats, in order of key, and which of them have a key that at most SHORT vertices
    hold, each by one entry (``hi`` < 0: as many keys of its set come from this one on)."""
    e = e[np.lexsort((e["vertex"], e["key"]))]
    e = e[np.append(True, (e["key"][1:] != e["key"][:-1]) | (e["vertex"][1:] != e["vertex"][:-1]) | (e["hi"][1:] != e["hi"][:-1]) | (e["lo"][1:] != e["lo"][:-1]))[:len(e)]]
    if not len(e):
        return e, np.zeros(0, bool)
    at = np.flatnonzero(np.append(True, e["key"][1:] != e["key"][:-1]))
    size = np.diff(np.append(at, len(e)))
    return e, np.repeat((size <= SHORT) & (np.maximum.reduceat(e["hi"], at) < 0), size)


def as_runs(e: np.ndarray) -> np.ndarray:
    """Single entries as runs of one size."""
    e = e.copy()
    e["hi"] = np.where(e["hi"] < 0, e["lo"], e["hi"])
    return e


def single_pairs(e: np.ndarray, num: int, den: int, shared: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of entries with one key that may be among the first ``shared(smaller size)`` common keys of
    sets with ``den * overlap >= num * union``, and how many such keys each pair needs."""
    pairs, needs = [np.zeros(0, EDGE)], [np.zeros(0, np.int32)]
    size, rest = e["lo"].astype(np.int64), -e["hi"].astype(np.int64)
    for d in range(1, SHORT):
        i = np.flatnonzero(e["key"][d:] == e["key"][:-d])
        small, large = np.minimum(size[i], size[i + d]), np.maximum(size[i], size[i + d])
        need = shared(small)
        overlap = -(-num * (small + large) // (num + den))
        ok = (den * small >= num * large) & (np.minimum(rest[i], rest[i + d]) >= overlap - need + 1) & (e["vertex"][i] != e["vertex"][i + d])
        out = np.zeros(int(ok.sum()), EDGE)
        u, v = e["vertex"][i[ok]], e["vertex"][i[ok] + d]
        out["a"], out["b"] = np.maximum(u, v), np.minimum(u, v)
        pairs.append(out)
        needs.append(need[ok].astype(np.int32))
    return np.concatenate(pairs), np.concatenate(needs)


def _blobs(parts: np.ndarray, rows: np.ndarray, n_parts: int) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(parts, kind="stable")
    rows, cut = rows[order], np.searchsorted(parts[order], np.arange(n_parts + 1))
    for p in range(n_parts):
        if cut[p] < cut[p + 1]:
            yield p, rows[cut[p]:cut[p + 1]].tobytes()


def _pack(rows: list[tuple[int, bool, bytes]]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.bool_()), pa.array(cols[2], pa.binary())], names=["part", "edges", "data"])


def _packed(rows: Iterable[tuple[int, bool, bytes]]) -> Iterator[pa.RecordBatch]:
    """Record batches of about SENT_BYTES."""
    held, n = [], 0
    for r in rows:
        held.append(r)
        n += len(r[2])
        if n >= SENT_BYTES:
            yield _pack(held)
            held, n = [], 0
    if held:
        yield _pack(held)


def candidate_edges(df: DataFrame, entries: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], num: int, den: int, name: str, shared: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """``edges(a, b)`` whose components hold every pair of vertices that shares a key of ``entries`` and
    has sizes within ``num / den``. ``entries`` maps the batches of ``df`` to ENTRY arrays.

    With ``shared``, entries are single (``hi`` = -(size - place in the common order)), similar sets have at
    least ``shared(smaller size)`` of them in common, and the pairs that have are held."""
    n_parts = 2 * partitions(df.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held):
            e, single = single_keys(np.concatenate(held)) if shared else (np.concatenate(held), np.zeros(1, bool))
            got, edges = runs(as_runs(e[~single]) if shared else e, num, den)
            if shared:
                got = np.concatenate([got, e[single]])
            part = (mix(got["key"]) % np.uint64(n_parts)).astype(np.int64)
            rows = ((p, False, b) for p, b in _blobs(part, got, n_parts))
            more = ((int((int(got["key"][0]) + k) % n_parts), True, edges[a:a + (1 << 14)].tobytes()) for k, a in enumerate(range(0, len(edges), 1 << 14)))
            yield from _packed(chain(rows, more))

        held, n = [], 0
        for e in entries(batches):
            held.append(e)
            n += len(e)
            if n >= FLUSH:
                yield from flush(held)
                held, n = [], 0
        if n:
            yield from flush(held)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = lambda e, need=None: pa.RecordBatch.from_arrays([pa.array(e["a"]), pa.array(e["b"]), pa.array(np.zeros(len(e), np.int32) if need is None else need)], names=["a", "b", "need"])
        held = [np.zeros(0, ENTRY)]
        for batch in batches:
            for edges, data in zip(batch.column("edges").to_pylist(), batch.column("data")):
                if edges:
                    yield out(np.frombuffer(data.as_buffer(), EDGE))
                else:
                    held.append(np.frombuffer(data.as_buffer(), ENTRY))
        e = np.concatenate(held)
        if shared:
            e, single = single_keys(e)
            yield out(*single_pairs(e[single], num, den, shared))
            e = as_runs(e[~single])
        yield out(runs(e, num, den)[1])

    sent = df.mapInArrow(send, _ROW).repartition(n_parts, "part")
    found = materialise(sent.mapInArrow(meet, "a long, b long, need int"), name)
    if shared:
        found = found.groupBy("a", "b").agg(F.count("*").alias("n"), F.min("need").alias("need")).where("n >= need")
    return found.select("a", "b")


# --- tiles ---------------------------------------------------------------------------------------

def bitmap(s: np.ndarray) -> np.ndarray:
    """Parities of a set's hashes over 64 * BITMAP_WORDS buckets."""
    odd = np.bincount((s >> np.uint64(20)).astype(np.int64) % (64 * BITMAP_WORDS), minlength=64 * BITMAP_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def tile_links(sets: list[np.ndarray], side: np.ndarray, num: int, den: int, part: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links between a tile's sets (of both sides, if there are two), on top of
    the ``part`` that each is already known to be in.

    A link: ``den * overlap >= num * union``. Differing bits of two parity bitmaps never outnumber the
    symmetric difference, so (sizes - differing bits) / 2 bounds the overlap from above.
    """
    size = np.array([len(s) for s in sets], np.int64)
    order = np.argsort(size, kind="stable")
    size, side = size[order], side[order]
    maps = np.stack([bitmap(sets[i]) for i in order])
    group = np.unique(part[order], return_inverse=True)[1] if part is not None else np.arange(len(order))
    links, two = [], len(set(side.tolist())) > 1
    for i in range(len(order) - 1):
        if not size[i]:
            continue
        end = int(np.searchsorted(size, den * size[i] // num, "right"))
        if end <= i + 1:
            continue
        j = np.arange(i + 1, end)
        j = j[(group[j] != group[i]) & ((side[j] != side[i]) if two else True)]
        if not len(j):
            continue
        most = (size[j] + size[i] - np.bitwise_count(maps[j] ^ maps[i]).sum(1).astype(np.int64)) // 2
        for x in j[den * most >= num * (size[j] + size[i] - most)].tolist():
            if group[x] == group[i]:
                continue
            both = len(np.intersect1d(sets[order[i]], sets[order[x]], assume_unique=True))
            if den * both >= num * (size[i] + size[x] - both):
                links.append((int(order[i]), int(order[x])))
                group[group == group[x]] = group[i]
    return links


def _block_tiles(members: DataFrame, block: int) -> DataFrame:
    """First round: a component's vertices in blocks by hash, each block with the component's leaders (the
    least vertices under LEADERS hashes). A component of up to two blocks' size is one tile, and done."""
    whole = members.groupBy("component").agg(F.count("*").alias("n"), F.array(*[F.min_by("vertex", F.xxhash64("vertex", F.lit(i))) for i in range(LEADERS)]).alias("leaders"))
    m = members.join(whole, "component").withColumn("blocks", F.when(F.col("n") <= 2 * block, 1).otherwise(F.ceil(F.col("n") / block)).cast("int"))
    own = F.array(F.pmod(F.xxhash64("vertex"), F.col("blocks")).cast("int"))
    blocks = F.when(F.array_contains("leaders", F.col("vertex")), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(own)
    return m.withColumn("b", F.explode(blocks)).select(*members.columns, F.xxhash64("component", "b").alias("tile"), F.lit(0).alias("side"), F.col("vertex").alias("part"))


def _pair_tiles(members: DataFrame, parts: DataFrame, num: int, den: int, block: int, weight: Column, most: int) -> DataFrame:
    """Second round, for components of more than one block that the first left in several ``parts(v, part)``:
    size bands (a band is one similarity step wide, so links stay within a band or its neighbour) are cut
    into blocks of about ``most`` in ``weight``, and tiles are the pairs of blocks with one at least outside the
    component's largest part."""
    large = members.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") > 2 * block).select("component")
    m = members.join(large, "component").join(parts, F.col("vertex") == F.col("v"), "left").withColumn("part", F.coalesce("part", "vertex")).drop("v")
    sizes = m.groupBy("component", "part").agg(F.count("*").alias("n")).groupBy("component").agg(F.max(F.struct("n", "part"))["part"].alias("main"), F.count("*").alias("parts"))
    band = F.floor(F.log(F.greatest(F.col("size"), F.lit(1)).cast("double")) / F.lit(math.log(den / num))).cast("int")
    m = m.join(sizes.where("parts > 1").drop("parts"), "component").withColumn("band", band).withColumn("rest", (F.col("part") != F.col("main")).cast("int"))
    key = lambda b, rest: b * 2 + rest
    count = m.groupBy("component", key(F.col("band"), F.col("rest")).alias("key")).agg(F.ceil(F.sum(weight) / most).cast("int").alias("blocks"))
    per = count.groupBy("component").agg(F.map_from_entries(F.collect_list(F.struct("key", "blocks"))).alias("bands"))
    m = m.join(per, "component")
    blocks = lambda b, rest: F.coalesce(F.element_at("bands", key(b, F.lit(rest))), F.lit(0))
    up_to = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    tile = lambda side, *by: F.struct(F.xxhash64("component", *by).alias("tile"), side.alias("side"))
    band, zero, one = F.col("band"), F.lit(0), F.lit(1)
    m = m.withColumn("no", F.pmod(F.xxhash64("vertex"), F.element_at("bands", key(band, F.col("rest")))).cast("int"))
    no = F.col("no")
    inner = [F.transform(up_to(blocks(band, 1)), lambda t: tile(F.when(no <= t, 0).otherwise(1), F.lit("same"), band, F.least(no, t), F.greatest(no, t))),
             F.transform(up_to(blocks(band + 1, 1)), lambda t: tile(zero, F.lit("next"), band, no, t)),
             F.transform(up_to(blocks(band - 1, 1)), lambda t: tile(one, F.lit("next"), band - 1, t, no))]
    to_main = lambda d: F.transform(up_to(blocks(band + d, 0)), lambda t: tile(zero, F.lit("main"), band, no, band + d, t))
    to_rest = lambda d: F.transform(up_to(blocks(band + d, 1)), lambda t: tile(one, F.lit("main"), band + d, t, band, no))
    outer, main = [to_main(d) for d in (-1, 0, 1)], [to_rest(d) for d in (-1, 0, 1)]
    t = F.when(F.col("rest") == 1, F.concat(*inner, *outer)).otherwise(F.concat(*main))
    return m.withColumn("t", F.explode(t)).select(*members.columns, "t.tile", "t.side", "part")


def verified_links(dealt: DataFrame, docs: DataFrame, extract: Callable, num: int, den: int, name: str) -> DataFrame:
    """Links ``(a, b)`` that span the links within the tiles of ``dealt(vertex, doc_id, spot, tile, side, part)``
    between vertices of different parts.

    ``docs(doc_id, text)`` gives the texts; ``extract(texts, spots)`` maps a batch of texts and, for each,
    the spots asked for, to sorted hash arrays. Only documents with candidates leave their task."""
    asked = materialise(dealt.groupBy("doc_id").agg(F.collect_list(F.struct("tile", "side", "vertex", "part", "spot")).alias("asked")), f"{name}-asked")
    rows = may_match(docs.where("doc_id is not null").select("doc_id", "text"), "doc_id", asked, "doc_id").join(asked, "doc_id").select("text", "asked")

    names = ["tile", "side", "vertex", "part", "data"]

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                asked = part.column(1).to_pylist()
                out = []
                for want, got in zip(asked, extract(part.column(0), [sorted({w["spot"] for w in a}) for a in asked])):
                    out += [(w["tile"], w["side"], w["vertex"], w["part"], got[w["spot"]].tobytes()) for w in want if w["spot"] in got]
                cols = list(zip(*out)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))], names=names)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close():
            got: dict[int, tuple] = {}
            for v, *rest in held:
                got.setdefault(v, rest)
            ids = list(got)
            if len(ids) < 2:
                return []
            side, part = (np.array([got[v][k] for v in ids], np.int64) for k in (0, 1))
            links = tile_links([got[v][2] for v in ids], side, num, den, part)
            return [(ids[a], ids[b]) for a, b in links]

        held, at, out = [], None, []
        for batch in batches:
            for tile, side, vertex, part, data in zip(*(batch.column(c).to_pylist() for c in names)):
                if tile != at:
                    out += close()
                    held, at = [], tile
                held.append((vertex, side, part, np.frombuffer(data, "<u8")))
            if len(out) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])
                out = []
        out += close()
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    made = rows.mapInArrow(sets, "tile long, side int, vertex long, part long, data binary")
    made = made.repartition("tile").sortWithinPartitions("tile", "side", "vertex")
    return materialise(made.mapInArrow(verify, "a long, b long"), name)


def sketch_links(dealt: DataFrame, num: int, den: int, name: str) -> DataFrame:
    """Pairs ``(a, b)`` that span, within the tiles of ``dealt(vertex, size, sketch, tile, side, part)``, the
    pairs whose bitmaps leave the similarity possible; no set is read for it."""
    names = ["tile", "side", "vertex", "part", "size", "sketch"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close():
            if len(held) < 2:
                return []
            held.sort(key=lambda r: r[3])
            side, vertex, part, size = (np.array([r[k] for r in held], np.int64) for k in range(4))
            maps = np.frombuffer(b"".join(r[4] for r in held), np.uint64).reshape(len(held), -1)
            group, two, links = np.unique(part, return_inverse=True)[1], len(set(side.tolist())) > 1, []
            for i in range(len(held) - 1):
                j = np.arange(i + 1, int(np.searchsorted(size, den * size[i] // num, "right")))
                j = j[(group[j] != group[i]) & ((side[j] != side[i]) if two else True)]
                most = (size[j] + size[i] - np.bitwise_count(maps[j] ^ maps[i]).sum(1).astype(np.int64)) // 2
                for x in j[den * most >= num * (size[j] + size[i] - most)].tolist():
                    if group[x] != group[i]:
                        links.append((int(vertex[i]), int(vertex[x])))
                        group[group == group[x]] = group[i]
            return links

        held, at, out = [], None, []
        for batch in batches:
            for tile, side, vertex, part, size, sketch in zip(*(batch.column(c).to_pylist() for c in names)):
                if tile != at:
                    out += close()
                    held, at = [], tile
                held.append((side, vertex, part, size, sketch))
            if len(out) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])
                out = []
        out += close()
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    sent = dealt.select(*names).repartition("tile").sortWithinPartitions("tile", "side", "vertex")
    return materialise(sent.mapInArrow(compare, "a long, b long"), name)


def _two_rounds(members: DataFrame, links: Callable[[DataFrame, str], DataFrame], num: int, den: int, name: str, block: int, weight: Column, most: int) -> DataFrame:
    """``(v, component)`` of what ``links`` finds in the tiles of both rounds."""
    first = materialise(connected_components(links(_block_tiles(members, block), f"{name}-links"), f"{name}-parts"), f"{name}-first")
    dealt = materialise(_pair_tiles(members, first.select("v", F.col("component").alias("part")), num, den, block, weight, most), f"{name}-tiles")
    if dealt.isEmpty():
        return first
    return connected_components(first.where("v <> component").select(F.col("v").alias("a"), F.col("component").alias("b")).union(links(dealt, f"{name}-links-2")), f"{name}-fine")


def _sketches(members: DataFrame, docs: DataFrame, extract: Callable, name: str) -> DataFrame:
    """``vertex, sketch`` (:func:`bitmap` as bytes) of ``members(vertex, doc_id, spot)``."""
    asked = materialise(members.groupBy("doc_id").agg(F.collect_list(F.struct("vertex", "spot")).alias("asked")), f"{name}-sketched")
    rows = may_match(docs.where("doc_id is not null").select("doc_id", "text"), "doc_id", asked, "doc_id").join(asked, "doc_id").select("text", "asked")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                wanted, out = part.column(1).to_pylist(), []
                for want, got in zip(wanted, extract(part.column(0), [sorted({w["spot"] for w in a}) for a in wanted])):
                    out += [(w["vertex"], bitmap(got[w["spot"]]).tobytes()) for w in want if w["spot"] in got]
                cols = list(zip(*out)) or [(), ()]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary())], names=["vertex", "sketch"])

    return rows.mapInArrow(made, "vertex long, sketch binary").groupBy("vertex").agg(F.first("sketch").alias("sketch"))


def linked_components(edges: DataFrame, vertices: DataFrame, docs: DataFrame, extract: Callable, num: int, den: int, name: str, block: int = BLOCK, *, sketches: bool = False) -> DataFrame:
    """``(v, component)`` of the true links; ``vertices(vertex, size, doc_id, spot)`` says where each set is
    read. With ``sketches`` the candidates' components are first split by the bound of their bitmaps, so that only
    sets which pass it are moved."""
    found = connected_components(edges, f"{name}-coarse")
    if sketches:
        coarse = materialise(vertices.join(found, F.col("vertex") == F.col("v")).drop("v"), f"{name}-coarse-members")
        coarse = materialise(coarse.select("vertex", "size", "component").join(_sketches(coarse, docs, extract, name), "vertex"), f"{name}-coarse-sketches")
        found = _two_rounds(coarse, lambda dealt, at: sketch_links(dealt, num, den, at), num, den, f"{name}-sketch", SKETCH_BLOCK, F.lit(1), SKETCH_BLOCK)
    members = materialise(vertices.join(found, F.col("vertex") == F.col("v")).drop("v"), f"{name}-members")
    return _two_rounds(members, lambda dealt, at: verified_links(dealt, docs, extract, num, den, at), num, den, name, block, F.greatest("size", F.lit(LEAST_SIZE)), PAIR_SIZE)
