"""Customer and product metrics with quintile segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrella.functions import numbers as num
from estrella.operators.deltas import ROWS, Figures
from estrella.operators.ranking import rank_and_tile

# What the metrics need per customer and product, kept up to date by the changes of a batch.
CUSTOMER_FIGURES = Figures(
    "cifras_cliente",
    ("sk_cliente",),
    sums={"monto_total_neto": "monto_neto"},
    distinct={"total_pedidos": "nk_order_id"},
    ends={"sk_tiempo": ("primer_sk", "ultimo_sk")},
)
PRODUCT_FIGURES = Figures(
    "cifras_producto",
    ("sk_producto",),
    sums={"total_unidades": "cantidad", "revenue_total": "monto_neto"},
    distinct={"total_pedidos": "nk_order_id"},
)


def customer_sums(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Orders, lines, net amount and first/last sale per customer, over the days the calendar has.

    Lines of a day that is not in the calendar do not count. The fact is summed per customer and day
    first, so the calendar meets one row per customer and day.
    """
    sold = fact.filter(F.col("sk_cliente").isNotNull())
    daily = sold.groupBy("sk_cliente", "sk_tiempo").agg(
        F.count(F.lit(1)).alias("lineas"), F.sum("monto_neto").alias("neto")
    )
    days = calendar.select("sk_tiempo", "fecha")
    sums = (
        daily.join(days, "sk_tiempo")
        .groupBy("sk_cliente")
        .agg(
            F.sum("lineas").alias("total_lineas"),
            F.sum("neto").alias("monto_total_neto"),
            F.min("fecha").alias("primer_pedido"),
            F.max("fecha").alias("ultimo_pedido"),
        )
    )
    pairs = sold.select("sk_cliente", "nk_order_id", "sk_tiempo").join(days.select("sk_tiempo"), "sk_tiempo", "left_semi")
    orders = pairs.select("sk_cliente", "nk_order_id").distinct().groupBy("sk_cliente").agg(F.count("nk_order_id").alias("total_pedidos"))
    return sums.join(orders, "sk_cliente")


def customer_sums_of(figures: DataFrame) -> DataFrame:
    """``customer_sums`` from kept figures, for facts all of whose days are in the calendar."""

    def day(column: str):
        return F.to_date(F.col(column).cast("string"), "yyyyMMdd")

    return figures.filter(F.col("sk_cliente").isNotNull()).select(
        "sk_cliente",
        F.col(ROWS).alias("total_lineas"),
        "monto_total_neto",
        day("primer_sk").alias("primer_pedido"),
        day("ultimo_sk").alias("ultimo_pedido"),
        "total_pedidos",
    )


def customer_metrics(
    fact: DataFrame,
    calendar: DataFrame,
    customers: DataFrame | None = None,
    rank_as: str | None = None,
) -> DataFrame:
    """Metrics and segment per customer; with ``customers`` also those without sales, with ``rank_as`` also the rank by amount."""
    return customer_segments(customer_sums(fact, calendar), customers, rank_as)


def customer_segments(sums: DataFrame, customers: DataFrame | None = None, rank_as: str | None = None) -> DataFrame:
    """Metrics and segment from the sums per customer; rank and tile come from one sorted copy."""
    if customers is not None:
        sums = customers.select("sk_cliente").join(sums, "sk_cliente", "left")
    zero = F.lit(0)
    table = sums.select(
        "sk_cliente",
        F.coalesce("total_pedidos", zero).alias("total_pedidos"),
        F.coalesce("total_lineas", zero).alias("total_lineas"),
        F.coalesce("monto_total_neto", zero).cast("decimal(28,4)").alias("monto_total_neto"),
        num.ratio(F.col("monto_total_neto"), F.col("total_pedidos")).alias("monto_promedio_pedido"),
        "primer_pedido",
        "ultimo_pedido",
        F.datediff("ultimo_pedido", "primer_pedido").alias("dias_como_cliente"),
    )
    tiled = rank_and_tile(table, "monto_total_neto", "sk_cliente", rank_as=rank_as, tile_as="_tile")
    return tiled.withColumn("segmento", num.quintile_segment(F.col("_tile"), num.CUSTOMER_SEGMENTS)).drop("_tile")


def product_sums(fact: DataFrame) -> DataFrame:
    """Orders, units and net amount per product.

    Orders are counted from narrow pairs, so the sums do not go through one row per product and order.
    """
    sums = fact.groupBy("sk_producto").agg(F.sum("cantidad").alias("total_unidades"), F.sum("monto_neto").alias("revenue_total"))
    pairs = fact.select(F.col("sk_producto").alias("_sk"), "nk_order_id").filter("nk_order_id IS NOT NULL").distinct()
    orders = pairs.groupBy("_sk").agg(F.count(F.lit(1)).alias("total_pedidos"))
    return sums.join(orders, F.col("sk_producto").eqNullSafe(F.col("_sk")), "left").select(
        "sk_producto", F.coalesce("total_pedidos", F.lit(0)).alias("total_pedidos"), "total_unidades", "revenue_total"
    )


def product_metrics(
    fact: DataFrame, products: DataFrame | None = None
) -> DataFrame:
    """Metrics, revenue rank and segment per product; with ``products`` also those without sales."""
    return product_segments(product_sums(fact), products)


def product_segments(sums: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Metrics, revenue rank and segment from the sums per product."""
    if products is not None:
        sums = products.select("sk_producto").join(sums, "sk_producto", "left")
    zero = F.lit(0)
    table = sums.select(
        "sk_producto",
        F.coalesce("total_pedidos", zero).alias("total_pedidos"),
        F.coalesce("total_unidades", zero).alias("total_unidades"),
        F.coalesce("revenue_total", zero).cast("decimal(28,4)").alias("revenue_total"),
        num.ratio(F.col("revenue_total"), F.col("total_pedidos")).alias("revenue_promedio_pedido"),
    )
    ranked = rank_and_tile(
        table, "revenue_total", "sk_producto", rank_as="rank_revenue", tile_as="_tile"
    )
    return ranked.withColumn("performance", num.quintile_segment(F.col("_tile"), num.PRODUCT_SEGMENTS)).drop("_tile")
