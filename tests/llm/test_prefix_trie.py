import hashlib
import zlib
from collections import defaultdict

import duckdb
from pyspark.sql import functions as F

from qaflow.llm import prefix_trie as p
from tests.conftest import SF_SMALL
from tests.llm.oracle import same

SCHEMA = "conv_id long, turn long, role string, text string, depth string, path int, n int, base int"


def key(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def ordered(rows):
    """conv_id -> its turns, by turn (null first), equal ones by digest."""
    found = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            found[c].append((turn is not None, turn or 0, key(role, text), role, text))
    return {c: [x[3:] for x in sorted(v)] for c, v in found.items()}


def spliced(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def brute(convs):
    """Every node by expanding all prefixes."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, who in members.items():
        below = [x for x in members if x[:len(node)] == node]
        inner = {x[:-1] for x in members if x}
        ends = ",".join(map(str, sorted(c for c in who if len(convs[c]) == len(node))))
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), sum(x[:-1] == node for x in members if x), sum(x not in inner for x in below),
                    sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def got(df):
    return sorted((tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=lambda r: r[:2])


def test_whole_table_equals_sql(spark):
    assert same(spark, p.query, p.SQL, SF_SMALL, ["conversations"]) > 30


def test_whole_table_equals_brute_force(spark):
    rows = duckdb.sql(f"select conv_id, turn, role, text from '{SF_SMALL}/conversations.parquet'").fetchall()
    assert got(p.query(spark, SF_SMALL)) == brute(spliced(ordered(rows)))


def made():
    rows = []
    for c in range(60):  # a hot first turn, then copies, and a deep trunk that a few of them share
        rows += [(c, 0, "user", "hello"), (c, 1, "bot", f"say {c % 3}")]
        if c % 3 == 0:
            rows += [(c, 2 + d, "user", f"deep {d}") for d in range(9)] + [(c, 20, "bot", "🙂" * (c % 7))]
    rows += [(100, None, "user", "first"), (100, 0, None, None), (100, 0, None, None), (100, 1, "user", "")]  # null turn, repeated rows, empty text
    rows += [(101, 0, "user", "x"), (None, 0, "user", "nobody"), (102, 5, "us", "er"), (103, 5, "use", "r")]
    return [(*r, "a", 1, 2, 3) for r in rows]


def test_hot_prefixes_peeled_above_anchors(spark):
    df = spark.createDataFrame(made(), SCHEMA)
    own = ordered(r[:4] for r in made())
    assert got(p.prefix_trie(p.sequences(df), records_most=3)) == brute(own)
    assert got(p.prefix_trie(p.splice(p.sequences(df)), records_most=1)) == brute(spliced(own))


def test_few_turns_in_a_group(spark):
    df = spark.createDataFrame(made(), SCHEMA)
    assert got(p.prefix_trie(p.sequences(df), turns_most=4)) == brute(ordered(r[:4] for r in made()))


def test_turnless_and_empty(spark):
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 == 5)
    df = spark.createDataFrame([(c, 0, "user", "gone", "", 0, 0, 0)], SCHEMA)
    assert got(p.prefix_trie(p.splice(p.sequences(df)))) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    assert got(p.prefix_trie(p.sequences(df.where(F.lit(False))))) == []


def test_many_copies_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(p, "BLOCK", 7)
    rows = [(c, 0, "user", "same", "", 0, 0, 0) for c in range(-20, 40)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(p.prefix_trie(p.sequences(df))) == brute(ordered(r[:4] for r in rows))
