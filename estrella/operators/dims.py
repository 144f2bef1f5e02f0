"""Dimension loads: plain, denormalised, hierarchical, incremental."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField

from estrella.functions import numbers as num
from estrella.operators.upsert import assign_keys, ensure_columns, fill_missing, insert_new, upsert


_SCORE_FIELDS = [StructField("customer_score", IntegerType()), StructField("customer_score_segmento", StringType())]


@dataclass(frozen=True)
class Reference:
    """A table looked up by ``on`` (base column, lookup column), giving ``columns`` new names."""

    table: DataFrame
    on: tuple[str, str]
    columns: dict[str, str]


def denormalize(base: DataFrame, references: Sequence[Reference]) -> DataFrame:
    """Attach attributes of small tables; base rows without a match keep NULLs.

    No join is forced to broadcast: Spark does so when the table is below its threshold.
    """
    for ref in references:
        names = [F.col(source).alias(target) for source, target in ref.columns.items()]
        base = base.join(ref.table.select(F.col(ref.on[1]).alias(ref.on[0]), *names), ref.on[0], "left")
    return base


def load_dim(
    source: DataFrame, key: str, surrogate: str, target: DataFrame | None = None
) -> DataFrame:
    """Initial load, or insert of the keys a target does not hold."""
    if target is None:
        return assign_keys(None, source, key, surrogate)
    keyed = assign_keys(target, source, key, surrogate)
    return insert_new(target, keyed, [key])


def upsert_dim(
    target: DataFrame,
    source: DataFrame,
    key: str,
    surrogate: str,
    columns: Sequence[str],
) -> DataFrame:
    """Update known keys in place, keep their surrogate, add new keys with the next surrogates."""
    keyed = assign_keys(target, source.filter(F.col(key).isNotNull()), key, surrogate)
    missing = [f for f in keyed.schema.fields if f.name not in target.columns]
    return upsert(ensure_columns(target, missing), keyed, [key], columns)


def resolve_parent(dim: DataFrame, source: DataFrame, key: str, source_key: str, parent: str, surrogate: str, name: str) -> DataFrame:
    """Turn the parent's natural key into its surrogate key (NULL for the root or an unknown parent)."""
    up = source.select(F.col(source_key).alias(key), F.col(parent).alias("_parent"))
    supervisors = dim.select(F.col(key).alias("_parent"), F.col(surrogate).alias(name))
    linked = up.join(supervisors, "_parent").select(key, name)
    return dim.drop(name).join(linked, key, "left")


def attach_score(dim: DataFrame, scores: DataFrame, key: tuple[str, str], score: str = "score") -> DataFrame:
    """Set score and segment of matched keys; others keep what they had."""
    dim = ensure_columns(dim, _SCORE_FIELDS)
    fresh = scores.select(F.col(key[1]).alias(key[0]), F.col(score).cast("int").alias("_score"))
    joined = dim.join(fresh, key[0], "left")
    hit = F.col("_score").isNotNull()
    return joined.withColumns(
        {
            "customer_score": F.coalesce("_score", "customer_score"),
            "customer_score_segmento": F.when(hit, num.score_segment(F.col("_score"))).otherwise(F.col("customer_score_segmento")),
        }
    ).drop("_score")


def backfill_country(dim: DataFrame, countries: DataFrame, column: str, foreign_key: str) -> DataFrame:
    return fill_missing(dim, countries, (column, "country_name"), foreign_key, "sk_pais")
