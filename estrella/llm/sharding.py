"""Sharding by a permutation of global row numbers that anyone can compute.

A Feistel network on pairs (left, right), with left below ``a`` and right below ``b``, permutes the
numbers below a * b >= n. Numbers that land at n or above walk on through the permutation until
they come back below n, which makes it a permutation of 0..n-1. Shard and slot follow by division,
so the place of a row is known from its number, n, the seed and the number of shards alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrella.llm.ordering import row_numbers

ROUNDS = 4


def _scramble(right: Column, seed: int, step: int) -> Column:
    """Round function: a number below 2**62 from one half."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(step), right), 2)


def permute(number: Column, n: int, seed: int = 0) -> Column:
    """Where row ``number`` (0..n-1) goes among 0..n-1; one to one for every n and seed.

    The network covers a * b numbers with a = ceil(sqrt(n)) and a * b - n < a, so a number lies
    outside with a chance below 1 / sqrt(n) and a walk meets at most a - 1 outside numbers. The
    expression has room for min(a, 64) steps: all that can occur up to n = 4096, and beyond that a
    longer walk has a chance below 64 ** -64. It would raise an error, not misplace a row.
    """
    if n <= 1:
        return F.lit(0).cast("long")
    a = isqrt(n - 1) + 1
    b = -(-n // a)

    def once(value: Column) -> Column:
        # the sizes of the halves swap in every round, after an even number they are back
        right = F.pmod(value, F.lit(b))
        left = ((value - right) / b).cast("long")
        sizes = (a, b)
        for step in range(ROUNDS):
            mixed = F.pmod(left + F.pmod(_scramble(right, seed, step), F.lit(sizes[0])), F.lit(sizes[0]))
            left, right, sizes = right, mixed, sizes[::-1]
        return (left * b + right).cast("long")

    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(min(a, 64))),
        once(number.cast("long")),
        lambda value, _: F.when(value >= n, once(value)).otherwise(value),
    )
    return F.when(walked < n, walked).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("long"))


def shard_rows(
    df: DataFrame, order: Sequence[str], shards: int, seed: int = 0, shard: str = "shard", slot: str = "slot"
) -> DataFrame:
    """Add ``shard`` and ``slot`` (0-based, without gaps) to every row; shard sizes differ by at most one.

    Row numbers follow the columns ``order``; rows that tie in all of them are dealt to some of
    their numbers, so name columns that tell different rows apart. NULLs come first. Repeated rows
    are rows of their own. An empty input gives an empty result. Other columns pass through, but for
    those named as the added ones.
    """
    inner = df.select(*[F.col(f"`{c}`").alias(f"in_{c}") for c in df.columns])
    numbered = row_numbers(inner, [F.col(f"`in_{c}`") for c in order], "_number")
    n = numbered.count()
    placed = numbered.withColumn("_place", permute(F.col("_number"), n, seed))
    own = [F.col(f"`in_{c}`").alias(c) for c in df.columns if c not in (shard, slot)]
    return placed.select(
        *own,
        F.pmod("_place", F.lit(shards)).cast("int").alias(shard),
        ((F.col("_place") - F.pmod("_place", F.lit(shards))) / shards).cast("long").alias(slot),
    )
