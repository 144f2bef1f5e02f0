"""Column profiles: rows, nulls, exact distinct values, smallest and largest text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK_TRIMMED = "trimmed"


def _is_null(value: Column, tokens: Sequence[str] | str) -> Column:
    if tokens == BLANK_TRIMMED:
        return value.isNull() | (F.trim(value) == "")
    return value.isNull() | value.isin(list(tokens)) if tokens else value.isNull()


def profile(table: str, df: DataFrame, null_tokens: Mapping[str, Sequence[str] | str]) -> DataFrame:
    """Profile the columns named in ``null_tokens``; each maps to the texts counted as null.

    Rows, nulls and the smallest and largest text of all columns are one aggregation over one pass.
    Only the distinct values need a shuffle: (column, value) pairs, deduplicated before it, of which
    just the number goes on. An empty table has a row of zeros per column.
    """
    columns = list(null_tokens)
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    cells = []
    for i, (name, tokens) in enumerate(null_tokens.items()):
        cells += [
            F.count_if(_is_null(F.col(name), tokens)).alias(f"null{i}"),
            F.min(name).alias(f"min{i}"),
            F.max(name).alias(f"max{i}"),
        ]
    wide = texts.agg(F.count(F.lit(1)).alias("total"), *cells)
    rows = [
        F.struct(
            F.lit(name).alias("campo"),
            F.col("total").alias("total_registros"),
            F.col(f"null{i}").alias("cant_nulos"),
            F.col(f"min{i}").alias("valor_min"),
            F.col(f"max{i}").alias("valor_max"),
        )
        for i, name in enumerate(columns)
    ]
    counted = wide.select(F.inline(F.array(*rows)))
    pairs = texts.unpivot([], columns, "campo", "valor").filter("valor IS NOT NULL").distinct()
    distinct = pairs.groupBy("campo").agg(F.count(F.lit(1)).alias("cant_distintos"))
    return counted.join(F.broadcast(distinct), "campo", "left").select(
        F.lit(table).alias("tabla"),
        "campo",
        "total_registros",
        "cant_nulos",
        F.coalesce("cant_distintos", F.lit(0)).alias("cant_distintos"),
        "valor_min",
        "valor_max",
    )


def profile_all(tables: Sequence[tuple[str, DataFrame, Mapping[str, Sequence[str] | str]]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [profile(*entry) for entry in tables])


def listing(profiles: DataFrame) -> DataFrame:
    return profiles.orderBy("tabla", "campo")


def rows_of_run(profiles: DataFrame, run_id: int) -> DataFrame:
    return profiles.filter(F.col("log_id") == run_id).agg(F.count(F.lit(1)).alias("registros_proc"))
