"""Reporting queries over the marts and, for a single year, over the star.

The year is a plain parameter. Restricting the fact to a year selects its partition, or compares
date keys in the scan; no calendar join is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrella.operators import marts
from estrella.operators.ranking import top_k


def _year(period: DataFrame, year: int | None) -> DataFrame:
    return period if year is None else period.filter(F.col("anio") == year)


def fact_of_year(fact: DataFrame, year: int) -> DataFrame:
    """Sales of a year; a fact partitioned by year is read only there."""
    if "anio" in fact.columns:
        return fact.filter(F.col("anio") == year)
    return fact.filter(F.col("sk_tiempo").between(year * 10000 + 101, year * 10000 + 1231))


def years(period: DataFrame) -> DataFrame:
    return period.select("anio").distinct().orderBy("anio")


def sales_kpis(period: DataFrame, year: int | None = None) -> DataFrame:
    """Totals over months; customers are added up per month and the ticket is a plain average."""
    return _year(period, year).agg(
        F.sum("total_pedidos").alias("pedidos"),
        F.sum("total_lineas").alias("lineas"),
        F.sum("total_clientes").alias("clientes"),
        F.round(F.sum("monto_neto"), 2).alias("revenue"),
        F.round(F.avg("ticket_promedio"), 2).alias("ticket_prom"),
    )


def monthly_series(period: DataFrame, year: int | None = None) -> DataFrame:
    label = F.concat(F.col("anio").cast("string"), F.lit("-"), F.lpad(F.col("mes").cast("string"), 2, "0"))
    return (
        _year(period, year)
        .select("anio", "trimestre", "mes", "nombre_mes", "monto_neto", "total_pedidos", label.alias("periodo_label"))
        .orderBy("anio", "mes")
    )


def active_in_year(mart: DataFrame, fact: DataFrame, key: str, year: int | None = None) -> DataFrame:
    """Mart rows whose key sold something in the year; their metrics stay all-time."""
    if year is None:
        return mart
    return mart.join(fact_of_year(fact, year).select(key).distinct(), key, "left_semi")


def top_customers(mart: DataFrame, fact: DataFrame, year: int | None = None, k: int = 15) -> DataFrame:
    active = active_in_year(mart, fact, "sk_cliente", year)
    return top_k(active, "monto_neto", k, "sk_cliente").select("company_name", "monto_neto", "segmento", "country")


def top_products(mart: DataFrame, fact: DataFrame, year: int | None = None, k: int = 15) -> DataFrame:
    active = active_in_year(mart, fact, "sk_producto", year)
    return top_k(active, "revenue_total", k, "sk_producto").select(
        "product_name", "revenue_total", "performance", "category_name"
    )


def distribution(mart: DataFrame, column: str, count_as: str = "cantidad") -> DataFrame:
    return mart.groupBy(column).agg(F.count(F.lit(1)).alias(count_as)).orderBy(column)


def employee_ranking(mart: DataFrame, employees: DataFrame, fact: DataFrame, year: int | None = None) -> DataFrame:
    ranked = mart if year is None else marts.sales_by_employee(employees, fact_of_year(fact, year))
    return ranked.select(
        "nombre_completo", "monto_neto", "total_pedidos", "total_clientes", "title", "rank_empleado"
    ).orderBy("rank_empleado", "nombre_completo")


def geography(
    mart: DataFrame, countries: DataFrame, customers: DataFrame, fact: DataFrame, year: int | None = None
) -> DataFrame:
    """Countries that can be drawn: all-time with sales, or recomputed for a year."""
    if year is None:
        rows = mart.filter(F.col("monto_neto") > 0)
    else:
        rows = marts.sales_by_country(countries, customers, fact_of_year(fact, year), only_active=True)
    return rows.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(
        "country_name", "monto_neto", "total_clientes", "total_pedidos", "pct_monto_global", "latitude", "longitude"
    )
