"""Flat data products computed from the star."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrella.functions import numbers as num
from estrella.operators.deltas import ROWS, Figures
from estrella.operators.ranking import rank_and_tile
from estrella.session import materialize

# What the marts need per month and seller, kept up to date by the changes of a batch.
PERIOD_FIGURES = Figures(
    "cifras_periodo",
    ("_month",),
    sums={"monto_bruto": "monto_bruto", "monto_descuento": "monto_descuento", "monto_neto": "monto_neto", "flete_total": "flete_prorrateado"},
    distinct={"total_pedidos": "nk_order_id", "total_clientes": "sk_cliente", "total_productos": "sk_producto"},
)
SELLER_FIGURES = Figures(
    "cifras_empleado",
    ("sk_empleado",),
    sums={"monto_neto": "monto_neto"},
    distinct={"total_pedidos": "nk_order_id", "total_clientes": "sk_cliente"},
)


def _distinct_per(fact: DataFrame, group: str, column: str, name: str) -> DataFrame:
    """Distinct non-null values of one column per group, reading just these two columns."""
    pairs = fact.select(group, column).filter(F.col(column).isNotNull()).distinct()
    return pairs.groupBy(group).agg(F.count(F.lit(1)).alias(name))


def _sums_per_order(fact: DataFrame, group: str, amounts: dict[str, str]) -> DataFrame:
    """Orders, lines and amounts per group, summed per (group, order) first."""
    per_order = fact.groupBy(group, "nk_order_id").agg(
        F.count(F.lit(1)).alias("lineas"), *[F.sum(source).alias(name) for name, source in amounts.items()]
    )
    return per_order.groupBy(group).agg(
        F.count("nk_order_id").alias("total_pedidos"),
        F.sum("lineas").alias("total_lineas"),
        *[F.coalesce(F.sum(name), F.lit(0)).cast("decimal(28,4)").alias(name) for name in amounts],
    )


def sales_by_period(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """One row per month.

    Before aggregation the month is the date key without its day; the calendar only says which days
    count, and supplies names afterwards. Each distinct count is its own narrow
    aggregation over (month, value): together they shuffle less than one aggregation that repeats
    every row once per distinct column, and a month with most of the rows stays balanced.
    """
    month = F.expr("sk_tiempo div 100")
    # lines of a day that the calendar does not have belong to no month
    monthly = fact.join(calendar.select("sk_tiempo"), "sk_tiempo", "left_semi").withColumn("_month", month)
    sums = _sums_per_order(monthly, "_month", dict(PERIOD_FIGURES.sums))
    customers = _distinct_per(monthly, "_month", "sk_cliente", "total_clientes")
    products = _distinct_per(monthly, "_month", "sk_producto", "total_productos")
    joined = sums.join(customers, "_month", "left").join(products, "_month", "left")
    return _months(joined, calendar)


def _months(sums: DataFrame, calendar: DataFrame) -> DataFrame:
    month = F.expr("sk_tiempo div 100")
    months = calendar.select(month.alias("_month"), "anio", "trimestre", "mes", "nombre_mes").distinct()
    return months.join(sums, "_month").select(
        "anio",
        "trimestre",
        "mes",
        "nombre_mes",
        "total_pedidos",
        "total_lineas",
        F.coalesce("total_clientes", F.lit(0)).alias("total_clientes"),
        F.coalesce("total_productos", F.lit(0)).alias("total_productos"),
        *PERIOD_FIGURES.sums,
        num.ratio(F.col("monto_neto"), F.col("total_pedidos")).alias("ticket_promedio"),
    )


def with_month(fact: DataFrame) -> DataFrame:
    """The fact with the month that ``PERIOD_FIGURES`` groups by."""
    return fact.withColumn("_month", F.expr("sk_tiempo div 100"))


def sales_by_period_of(figures: DataFrame, calendar: DataFrame) -> DataFrame:
    """``sales_by_period`` from kept figures, for facts all of whose days are in the calendar."""
    sums = figures.withColumnRenamed(ROWS, "total_lineas")
    return _months(sums.withColumns({c: F.col(c).cast("decimal(28,4)") for c in PERIOD_FIGURES.sums}), calendar)


def sales_by_employee_of(employees: DataFrame, figures: DataFrame) -> DataFrame:
    """``sales_by_employee`` from kept figures."""
    net = F.col("monto_neto").cast("decimal(28,4)").alias("monto_neto")
    sold = figures.filter(F.col("sk_empleado").isNotNull()).select("sk_empleado", "total_pedidos", net, "total_clientes")
    return _employees(employees.join(sold, "sk_empleado", "left"))


def sales_by_customer(
    customers: DataFrame, countries: DataFrame, metrics: DataFrame
) -> DataFrame:
    """All customers with their metrics and rank; a rank that the metrics of all customers bring is taken as it is."""
    place = countries.select("sk_pais", F.col("country_name").alias("country_name_pais"), "capital_major_city")
    flat = customers.join(place, "sk_pais", "left").join(metrics, "sk_cliente", "left")
    zero = F.lit(0)
    table = flat.select(
        "sk_cliente", "nk_customer_id", "company_name", "city", "country", "country_name_pais", "capital_major_city",
        "customer_score", "customer_score_segmento", "segmento",
        F.coalesce("total_pedidos", zero).alias("total_pedidos"),
        F.coalesce("total_lineas", zero).alias("total_lineas"),
        F.coalesce("monto_total_neto", zero).alias("monto_neto"),
        "monto_promedio_pedido", "primer_pedido", "ultimo_pedido", "dias_como_cliente",
        *[c for c in metrics.columns if c == "rank_cliente"],
    )
    if "rank_cliente" in metrics.columns:
        return table
    return rank_and_tile(table, "monto_neto", "sk_cliente", rank_as="rank_cliente")


def sales_by_product(products: DataFrame, metrics: DataFrame) -> DataFrame:
    zero = F.lit(0)
    return products.join(metrics, "sk_producto", "left").select(
        "sk_producto", "nk_product_id", "product_name", "category_name", "supplier_name", "supplier_country",
        "precio_lista", "discontinued", "performance", "rank_revenue",
        F.coalesce("total_pedidos", zero).alias("total_pedidos"),
        F.coalesce("total_unidades", zero).alias("total_unidades"),
        F.coalesce("revenue_total", zero).alias("revenue_total"),
        "revenue_promedio_pedido",
    )


def sales_by_employee(employees: DataFrame, fact: DataFrame) -> DataFrame:
    sold = fact.filter(F.col("sk_empleado").isNotNull())
    sums = _sums_per_order(sold, "sk_empleado", {"monto_neto": "monto_neto"})
    customers = _distinct_per(sold, "sk_empleado", "sk_cliente", "total_clientes")
    return _employees(employees.join(sums, "sk_empleado", "left").join(customers, "sk_empleado", "left"))


def _employees(joined: DataFrame) -> DataFrame:
    zero = F.lit(0)
    table = joined.select(
        "sk_empleado", "nk_employee_id", "nombre_completo", "title",
        F.coalesce("total_pedidos", zero).alias("total_pedidos"),
        F.coalesce("total_clientes", zero).alias("total_clientes"),
        F.coalesce("monto_neto", zero).cast("decimal(28,4)").alias("monto_neto"),
        num.ratio(F.col("monto_neto"), F.col("total_pedidos")).alias("monto_promedio"),
    )
    return rank_and_tile(table, "monto_neto", "sk_empleado", rank_as="rank_empleado")


def country_sums(customers: DataFrame, fact: DataFrame, only_active: bool = False) -> DataFrame:
    """Customers, orders and net amount per country.

    The fact is summed per customer and order first. An order whose lines name two customers counts
    once in each of their countries.
    """
    sold = fact.filter(F.col("sk_cliente").isNotNull())
    per_order = sold.groupBy("sk_cliente", "nk_order_id").agg(F.sum("monto_neto").alias("neto"))
    located = customers.filter(F.col("sk_pais").isNotNull()).select("sk_cliente", "sk_pais")
    joined = located.join(per_order, "sk_cliente", "inner" if only_active else "left")
    by_order = joined.groupBy("sk_pais", "nk_order_id").agg(F.sum("neto").alias("neto"))
    sums = by_order.groupBy("sk_pais").agg(
        F.count("nk_order_id").alias("total_pedidos"),
        F.coalesce(F.sum("neto"), F.lit(0)).cast("decimal(28,4)").alias("monto_neto"),
    )
    if only_active:
        located = located.join(sold.select("sk_cliente").distinct(), "sk_cliente", "left_semi")
    counts = located.groupBy("sk_pais").agg(F.count(F.lit(1)).alias("total_clientes"))
    return counts.join(sums, "sk_pais")


def share_of(amount: Column, total: Column) -> Column:
    return F.when(total > 0, F.round(amount * 100 / total, 4)).otherwise(F.lit(0))


def sales_by_country(countries: DataFrame, customers: DataFrame, fact: DataFrame, only_active: bool = False) -> DataFrame:
    """All countries with their sales and their share of the sales of located customers.

    The sums per country, a small table, are written: both the rows and the total come from them
    and the fact is read once.
    """
    sums = materialize(country_sums(customers, fact, only_active))
    total = sums.agg(F.coalesce(F.sum("monto_neto"), F.lit(0)).cast("decimal(28,4)")).scalar()
    zero = F.lit(0)
    joined = countries.join(sums, "sk_pais", "inner" if only_active else "left").withColumns(
        {
            "total_clientes": F.coalesce("total_clientes", zero),
            "total_pedidos": F.coalesce("total_pedidos", zero),
            "monto_neto": F.coalesce("monto_neto", zero).cast("decimal(28,4)"),
        }
    )
    return joined.withColumn("pct_monto_global", share_of(F.col("monto_neto"), total))


def coverage(period: DataFrame) -> DataFrame:
    """First and last month, years, months and total net amount of the monthly mart, as text."""
    label = F.concat(F.col("anio").cast("string"), F.lit("-"), F.lpad(F.col("mes").cast("string"), 2, "0"))
    facts = period.agg(
        F.min(label).alias("desde"),
        F.max(label).alias("hasta"),
        F.count_distinct("anio").cast("string").alias("anios"),
        F.count(F.lit(1)).cast("string").alias("meses"),
        F.format_number(F.sum("monto_neto").cast("decimal(28,2)"), 2).alias("neto"),
    )
    # fixed values: the labels of the report
    names = (
        ("Período desde", "desde"),
        ("Período hasta", "hasta"),
        ("Años cubiertos", "anios"),
        ("Meses cubiertos", "meses"),
        ("Revenue neto total (USD)", "neto"),
    )
    return facts.select(
        F.inline(F.array(*[F.struct(F.lit(text).alias("parametro"), F.col(c).alias("valor")) for text, c in names]))
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    parts = [df.agg(F.lit(name).alias("tabla"), F.count(F.lit(1)).alias("registros")) for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
