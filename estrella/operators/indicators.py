"""Percentage indicators with thresholds, run states and the load gate."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estrella.functions import numbers as num
from estrella.operators.integrity import ForeignKey
from estrella.operators.ranking import quantiles

COLUMNS = ["tabla", "campo", "indicador", "valor_calculado", "umbral_warning", "umbral_error", "resultado"]


@dataclass(frozen=True)
class Share:
    """Percentage of rows for which ``when`` holds."""

    field: str
    name: str
    when: Callable[[], Column]
    warn: float = 0.0
    error: float = 0.0
    scale: int = 2


def null_share(field: str, *columns: str, warn: float = 0.0, error: float = 0.0) -> Share:
    """Rows in which any of the columns is NULL."""
    names = columns or (field,)
    return Share(field, "PCT_NULOS", lambda: reduce(lambda a, b: a | b, [F.col(c).isNull() for c in names]), warn, error)


def _rows(values: DataFrame, table: str) -> DataFrame:
    value = F.col("valor_calculado")
    state = num.evaluate(value, F.col("umbral_warning"), F.col("umbral_error"), F.col("peor"))
    return values.select(
        F.lit(table).alias("tabla"),
        "campo",
        "indicador",
        value.cast("decimal(18,4)").alias("valor_calculado"),
        "umbral_warning",
        "umbral_error",
        state.alias("resultado"),
    )


def _cell(field: str | None, name: str, value: Column, warn: float, error: float, worst: str = num.ERROR) -> Column:
    if warn > error:
        raise ValueError(f"{name}: warning threshold {warn} is above the error threshold {error}")
    return F.struct(
        F.lit(field).cast("string").alias("campo"),
        F.lit(name).alias("indicador"),
        value.cast("decimal(18,4)").alias("valor_calculado"),
        F.lit(warn).cast("double").alias("umbral_warning"),
        F.lit(error).cast("double").alias("umbral_error"),
        F.lit(worst).alias("peor"),
    )


def shares(table: str, df: DataFrame, wanted: Sequence[Share]) -> DataFrame:
    """All share indicators of a table in one pass over it."""
    counts = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(s.when()).alias(f"c{i}") for i, s in enumerate(wanted)])
    cells = [
        _cell(s.field, s.name, num.percentage(F.col(f"c{i}"), F.col("total"), s.scale), s.warn, s.error)
        for i, s in enumerate(wanted)
    ]
    return _rows(counts.select(F.inline(F.array(*cells))), table)


def foreign_key_share(
    fk: ForeignKey,
    name: str,
    warn: float = 0.0,
    error: float = 0.0,
    scale: int = 2,
    null_is_orphan: bool = False,
    only_present: bool = False,
) -> DataFrame:
    """Percentage of child rows whose key has no parent.

    ``null_is_orphan`` counts NULL keys as missing; ``only_present`` leaves them out altogether.
    """
    values = fk.value_counts().join(fk.known().distinct().withColumn("_known", F.lit(True)), fk.column, "left")
    present = F.col(fk.column).isNotNull()
    missing = F.col("_known").isNull() if null_is_orphan else F.col("_known").isNull() & present
    if only_present:
        values = values.filter(present)
    sums = values.agg(F.sum("n").alias("total"), F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("bad"))
    pct = num.percentage(F.col("bad"), F.col("total"), scale)
    return _rows(sums.select(F.inline(F.array(_cell(fk.column, name, pct, warn, error)))), fk.table)


@dataclass(frozen=True)
class Outliers:
    """Share of a column's values beyond its quartile fences.

    Quartiles and the denominator come from the ``base`` rows; outliers are counted among the
    ``counted`` rows. ``lower`` adds the lower fence, not below zero.
    """

    field: str
    base: Callable[[], Column] = lambda: F.lit(True)
    counted: Callable[[], Column] = lambda: F.lit(True)
    width: float = 3.0
    lower: bool = False
    warn: float = 5.0
    error: float = 15.0
    name: str = "PCT_OUTLIERS"


def outlier_shares(table: str, df: DataFrame, wanted: Sequence[Outliers]) -> DataFrame:
    """All outlier shares of a table: one pass for the quartiles of all columns, one for the counts."""
    based = [F.when(o.base(), F.col(o.field).cast("double")).alias(f"v{i}") for i, o in enumerate(wanted)]
    fences = quantiles(df.select(*based), [f"v{i}" for i in range(len(wanted))], (0.25, 0.75))
    # one row with the quartiles of every column, NULL where a column has no values
    wide = fences.agg(*[F.max(F.when(F.col("campo") == f"v{i}", F.col("q"))).alias(f"q{i}") for i in range(len(wanted))])
    known = df.withColumn("_q", wide.select(F.struct("*")).scalar())
    cells = []
    for i, o in enumerate(wanted):
        number, q1, q3 = F.col(o.field).cast("double"), F.col(f"_q.q{i}")[0], F.col(f"_q.q{i}")[1]
        beyond = number > q3 + o.width * (q3 - q1)
        if o.lower:
            beyond = beyond | (number < F.greatest(F.lit(0.0), q1 - o.width * (q3 - q1)))
        cells.append(F.count_if(beyond & o.counted()).alias(f"bad{i}"))
        cells.append(F.count_if(o.base()).alias(f"total{i}"))
    counts = known.agg(*cells)
    rows = [
        _cell(o.field, o.name, num.percentage(F.col(f"bad{i}"), F.col(f"total{i}"), 2), o.warn, o.error)
        for i, o in enumerate(wanted)
    ]
    return _rows(counts.select(F.inline(F.array(*rows))), table)


def count_difference(table: str, left: DataFrame, right: DataFrame, name: str = "DIFF_COUNT_TXT_VS_TMP") -> DataFrame:
    """Absolute difference of two row counts; any difference is a warning, never an error."""
    both = left.agg(F.count(F.lit(1)).alias("n")).unionByName(right.agg((-F.count(F.lit(1))).alias("n")))
    gap = both.agg(F.abs(F.sum("n")).alias("gap"))
    return _rows(gap.select(F.inline(F.array(_cell(None, name, F.col("gap"), 0.0, 0.0, num.WARNING)))), table)


def all_of(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def report(indicators: DataFrame) -> DataFrame:
    """Worst first, then by table, field and indicator, with the place in that order as a column."""
    order = Window.orderBy(num.severity_order(F.col("resultado")), "tabla", "campo", "indicador")
    return indicators.withColumn("orden", F.row_number().over(order)).orderBy("orden")


def gate(indicators: DataFrame, runs: DataFrame, scripts: DataFrame, names: Sequence[str], strict: bool = False) -> DataFrame:
    """Errors of the latest run of each named script; these block the load.

    ``strict`` raises instead of only listing them.
    """
    latest = (
        runs.join(scripts.filter(F.col("script_nombre").isin(list(names))), "script_id")
        .groupBy("script_nombre")
        .agg(F.max("log_id").alias("log_id"))
    )
    blockers = (
        indicators.filter(F.col("resultado") == num.ERROR)
        .join(latest, "log_id")
        .select("tabla", "indicador", "valor_calculado", "resultado", F.col("script_nombre").alias("detectado_en"))
        .orderBy("detectado_en", "tabla", "indicador")
    )
    if strict and not blockers.isEmpty():
        raise RuntimeError("the load is blocked by indicators in state ERROR")
    return blockers
