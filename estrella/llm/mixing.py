"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, epoch after epoch. A document's
virtual finish time is the running total of its source's tokens divided by the source's target.
Taking documents by virtual time, over all sources together, until the budget is spent serves each
source in proportion to its target at any moment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estrella.llm.ordering import add_totals, ranged_sums

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: int = 2
) -> DataFrame:
    """(source, source_size, target) for a frame (source, size).

    Sources in code point order, NULL last, weigh ``weights`` in turn and share ``share`` times all
    sizes. No target exceeds ``most`` times its source's size; what is cut off goes to the others
    by weight until none is above. That is one level for all: a source gets weight * level or its
    limit, whichever is less. Sources reach their limits in the order of limit / weight, so the
    level follows from running sums over the sources: it is the first one, in that order, that
    leaves its own source below the limit.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(ranked) - 1, F.lit(len(weights)))
    weighed = sums.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    limit = F.col("source_size") * F.lit(float(most))
    by_limit = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    earlier = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (
        weighed.withColumn("_limit", limit)
        .withColumn("_ratio", F.col("_limit") / F.col("_w"))
        .withColumn("_spent", F.coalesce(F.sum("_limit").over(earlier), F.lit(0.0)))
        .withColumn("_gone", F.coalesce(F.sum("_w").over(earlier), F.lit(0.0)))
        .withColumn("_all_w", F.sum("_w").over(all_rows))
        .withColumn("_budget", F.sum("source_size").over(all_rows) * F.lit(float(share)))
        # the level if all earlier sources are at their limits and this and later ones are not
        .withColumn("_level", (F.col("_budget") - F.col("_spent")) / (F.col("_all_w") - F.col("_gone")))
        .withColumn("_first", F.struct(F.row_number().over(by_limit).alias("at"), "_level"))
        .withColumn("_found", F.min(F.when(F.col("_level") <= F.col("_ratio"), F.col("_first"))).over(all_rows))
    )
    # without such a source the budget exceeds all limits
    target = F.least("_limit", F.col("_w") * F.col("_found._level"))
    return levels.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    size: str = "size",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    seed: int = 0,
) -> DataFrame:
    """All rows with source_size, target, taken and parts: what the mix takes of each document.

    ``parts`` lists (epoch, start, finish, take): virtual start and finish in units of the source's
    target, and the tokens taken in that epoch. The budget is the sum of the targets, which is
    spent exactly at virtual time 1: documents that finish by then are whole, the one that the end
    falls into is cut, later ones take nothing. So a source takes its target, rounded down.

    The shuffle is a hash of seed and key; rows with the same key are ordered by size and are
    otherwise alike. A NULL source is a source, a NULL key is a key, a NULL size is 0; a source of
    size 0 takes nothing. Rows are never dropped here; columns named as the added ones are replaced.
    """
    added = ["source_size", "target", "taken", "parts"]
    kept = [c for c in docs.columns if c not in added]
    rows = docs.select(
        *[F.col(f"`{c}`").alias(f"in_{c}") for c in kept],
        F.col(f"`{source}`").alias("_source"),
        F.coalesce(F.col(f"`{size}`").cast("long"), F.lit(0)).alias("_size_in"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")))).alias("_turn"),
    )
    stored, pieces = ranged_sums(rows, "_source", ["_turn", "_size_in"], "_size_in")
    sizes = pieces.select(F.col("_source").alias("source"), F.col("_size").alias("size"))
    targets = source_targets(sizes, weights, share, most).select(
        F.col("source").alias("_source"), F.col("source_size").alias("_t_size"), F.col("target").alias("_target")
    )
    joined = add_totals(stored, pieces, "_source", "_earlier", targets)
    quota = F.floor("_target").cast("long")
    parts = []
    for epoch in range(most):
        begin = F.col("_earlier") + F.col("_t_size") * epoch
        take = F.greatest(F.lit(0), F.least(F.col("_size_in"), quota - begin)).cast("long")
        parts.append(
            F.struct(
                F.lit(epoch).alias("epoch"),
                F.try_divide(begin, F.col("_target")).alias("start"),
                F.try_divide(begin + F.col("_size_in"), F.col("_target")).alias("finish"),
                take.alias("take"),
            )
        )
    return joined.select(
        *[F.col(f"in_{c}").alias(c) for c in kept],
        F.col("_t_size").alias("source_size"),
        F.col("_target").alias("target"),
        sum((p["take"] for p in parts), F.lit(0).cast("long")).alias("taken"),
        F.array(*parts).alias("parts"),
    )


def mixed_sequence(mixed: DataFrame) -> DataFrame:
    """One row per document and epoch that takes words, sorted over all ranges by virtual finish time."""
    parts = mixed.withColumn("part", F.explode("parts")).filter(F.col("part.take") > 0)
    return parts.repartitionByRange("part.finish", "part.epoch").sortWithinPartitions("part.finish", "part.epoch")
