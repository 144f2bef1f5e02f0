"""A stored filter of the keys that a long-lived table holds, so that new keys need not meet the table.

The filter is a blocked Bloom filter as a frame: one row (bloque, p0 … p7) per block of 512 bits. A key belongs to one block and
sets one bit in each of its eight words. Filters of batches merge by OR, block by block. It never misses a
key that is there; of the others about one in two hundred passes at twelve bits a key, and those meet the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrella.operators.ranking import first_per_key
from estrella.session import materialize

WORDS = 8
BLOCK_BITS = 512
BITS_PER_KEY = 12


def blocks_for(keys: int) -> int:
    """Number of blocks for as many keys as the table will hold; it is fixed once, as merging needs equal filters."""
    return max(1, keys * BITS_PER_KEY // BLOCK_BITS)


def _block(key: Sequence[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(blocks)).alias("bloque")


def _bit(key: Sequence[str], word: int) -> Column:
    """The bit of a key in a word, from a hash of its own."""
    place = F.xxhash64(F.lit(word), *key).bitwiseAND(63).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def build(rows: DataFrame, key: Sequence[str], blocks: int) -> DataFrame:
    """The filter of the keys of some rows; keys with a NULL in them are left out, as they equal no other."""
    whole = rows.select(*key).dropna()
    bits = [F.bit_or(_bit(key, w)).alias(f"p{w}") for w in range(WORDS)]
    return whole.groupBy(_block(key, blocks)).agg(*bits)


def merge(*filters: DataFrame) -> DataFrame:
    """The filter of all keys of filters with the same number of blocks."""
    rows = filters[0]
    for more in filters[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("bloque").agg(*[F.bit_or(f"p{w}").alias(f"p{w}") for w in range(WORDS)])


def possible(rows: DataFrame, known: DataFrame, key: Sequence[str], blocks: int) -> DataFrame:
    """The rows with ``_posible``: whether their key may be known. NULL keys are not."""
    asked = rows.withColumn("_bloque", _block(key, blocks))
    met = asked.join(known.withColumnRenamed("bloque", "_bloque"), "_bloque", "left")
    hit = F.lit(True)
    for w in range(WORDS):
        hit = hit & (F.col(f"p{w}").bitwiseAND(_bit(key, w)) != 0)
    for k in key:
        hit = hit & F.col(k).isNotNull()
    return met.withColumn("_posible", F.coalesce(hit, F.lit(False))).drop("_bloque", *[f"p{w}" for w in range(WORDS)])


def insert_new(
    target: DataFrame, source: DataFrame, key: Sequence[str], known: DataFrame, blocks: int, order: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The source rows whose key ``target`` does not hold, and the filter with their keys added.

    Of several source rows with one key the first by ``order``, or else by all columns, is taken. ``known`` is the filter of the target's keys;
    only rows that it lets pass meet the target, so the result is exact. What comes back is to be
    appended to the target.
    """
    whole = source.dropna(subset=list(key))
    one = first_per_key(whole, key, order or source.columns)
    asked = materialize(possible(one, known, key, blocks))
    doubtful = asked.filter("_posible").drop("_posible")
    present = target.select(*key).join(doubtful.select(*key), list(key), "left_semi")
    # as for a unique index, a key with a NULL in it conflicts with no other
    has_null = F.lit(False)
    for k in key:
        has_null = has_null | F.col(k).isNull()
    fresh = asked.filter("NOT _posible").drop("_posible").unionByName(doubtful.join(present, list(key), "left_anti"))
    fresh = materialize(fresh.unionByName(source.filter(has_null)))
    return fresh, merge(known, build(fresh, key, blocks))


def passing_share(rows: DataFrame, known: DataFrame, key: Sequence[str], blocks: int) -> DataFrame:
    """(filas, dudosas): how many rows there are, and how many of them have to meet the table."""
    return possible(rows, known, key, blocks).agg(F.count(F.lit(1)).alias("filas"), F.count_if("_posible").alias("dudosas"))
