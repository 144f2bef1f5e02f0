"""Calendar dimension: a dense range or only the dates that occur."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrella.operators.upsert import insert_new

# Names shown in the calendar, January and Monday first.
MONTH_NAMES = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)
DAY_NAMES = ("Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo")


def date_key(day: Column) -> Column:
    """yyyymmdd as an integer."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def _name(names: Sequence[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), number)


def describe_days(days: DataFrame) -> DataFrame:
    """Calendar attributes of a frame with one date column ``fecha``."""
    day = F.col("fecha")
    weekday = F.weekday(day) + 1
    return days.select(
        date_key(day).alias("sk_tiempo"),
        day,
        F.year(day).alias("anio"),
        F.quarter(day).alias("trimestre"),
        F.month(day).alias("mes"),
        _name(MONTH_NAMES, F.month(day)).alias("nombre_mes"),
        F.weekofyear(day).alias("semana_anio"),
        F.dayofmonth(day).alias("dia"),
        weekday.alias("dia_semana"),
        _name(DAY_NAMES, weekday).alias("nombre_dia"),
        (weekday >= 6).alias("es_fin_de_semana"),
    )


def date_bounds(df: DataFrame, base: str, others: Sequence[str] = ()) -> DataFrame:
    """First and last date over ``base`` and ``others``, for rows that have a ``base`` date."""
    dates = [F.col(base), *[F.coalesce(F.col(c), F.col(base)) for c in others]]
    low = F.least(*dates) if others else dates[0]
    high = F.greatest(*dates) if others else dates[0]
    return df.filter(F.col(base).isNotNull()).agg(F.min(low).alias("desde"), F.max(high).alias("hasta"))


def date_series(bounds: DataFrame) -> DataFrame:
    """One row per day from ``desde`` to ``hasta``."""
    return bounds.filter(F.col("desde").isNotNull()).select(F.explode(F.sequence("desde", "hasta")).alias("fecha"))


def calendar_range(df: DataFrame, base: str, others: Sequence[str] = ()) -> DataFrame:
    """Every day between the first and the last date in use."""
    return describe_days(date_series(date_bounds(df, base, others)))


def calendar_of_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the dates that occur in ``columns``."""
    days = df.select(F.explode(F.array(*columns)).alias("fecha")).filter("fecha IS NOT NULL").distinct()
    return describe_days(days)


def add_missing_days(calendar: DataFrame, fresh: DataFrame) -> DataFrame:
    return insert_new(calendar, fresh, ["sk_tiempo"])


def union_dates(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).distinct()
