"""Shuffling by a keyed permutation of positions (D6), without a sort.

``permuted(pos, n, seed)`` is a bijection on 0..n-1.  A position is written as two digits ``(left, right)`` of a
mixed radix ``a * b >= n`` with ``a`` about the square root of ``n``; each Feistel round adds a keyed hash of one digit to the
other, modulo its radix, which can be undone and so loses nothing.  At most ``a - 1`` of the ``a * b`` values lie
beyond ``n - 1``; a position that lands on one is permuted again until it doesn't (cycle walking), which
stays a bijection.

Every row finds its place from its own position: no range exchange, no sampling, no order kept anywhere.
Rows of one shuffled batch are then brought together by one hash exchange on the batch number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaflow.functions.text import _c

ROUNDS = 4
WALK = 12  # beyond that many values outside: the chance to need more steps is below (1 / sqrt(n)) ** WALK


def radix(n: int) -> tuple[int, int]:
    """The two radices for ``n`` positions."""
    a = max(1, math.isqrt(n - 1) + 1) if n > 0 else 1
    return a, max(1, -(-n // a))


def _hash(seed: int, round_no: Column, digit: Column, size: int) -> Column:
    """32 hash bits of (seed, round, digit), modulo ``size``."""
    text = F.concat(F.lit(f"{seed}|"), round_no.cast("string"), F.lit("|"), digit.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % size


def _once(x: Column, n: int, seed: int) -> Column:
    a, b = radix(n)
    pair = F.struct(F.floor(x / b).cast("long").alias("l"), (x % b).cast("long").alias("r"))

    def step(p, i):
        left = F.when(i % 2 == 0, (p["l"] + _hash(seed, i, p["r"], a)) % a).otherwise(p["l"])
        right = F.when(i % 2 == 1, (p["r"] + _hash(seed, i, p["l"], b)) % b).otherwise(p["r"])
        return F.struct(left.alias("l"), right.alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), pair, step, lambda p: p["l"] * b + p["r"])


def permuted(pos, n: int, seed: int, epoch: int = 0) -> Column:
    """The place of position ``pos`` (0..n-1) in the shuffle of ``(seed, epoch)``; null outside 0..n-1."""
    a, b = radix(n)
    key = seed * 1_000_003 + epoch
    steps = min(a * b - n, WALK) + 1
    x = _c(pos).cast("long")
    place = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.lit(-1).cast("long"),
                        lambda y, i: F.when((i > 1) & (y < n), y).otherwise(_once(F.when(i == 1, x).otherwise(y), n, key)))
    inside = F.when((x >= 0) & (x < n), place)
    return F.when(F.assert_true(F.coalesce(inside < n, F.lit(True)), "cycle walk too short: choose another seed").isNull(), inside)


def shuffle_batches(df: DataFrame, pos: str, n: int, size: int, seed: int, epoch: int = 0) -> DataFrame:
    """Every row with its ``batch`` and ``slot`` in the epoch's shuffle into batches of ``size``."""
    place = permuted(pos, n, seed, epoch)
    return df.withColumn("_place", place).withColumn("batch", F.floor(F.col("_place") / size).cast("long")) \
        .withColumn("slot", (F.col("_place") % size).cast("long")).drop("_place")
