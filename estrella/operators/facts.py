"""Order-line fact: key lookups, allocated freight, derived measures, load footprints."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrella.functions import numbers as num
from estrella.operators.calendar import date_key
from estrella.session import materialize

MEASURES = [
    "cantidad", "precio_unitario", "descuento", "flete_prorrateado",
    "monto_bruto", "monto_descuento", "monto_neto",
]
FACT_COLUMNS = ["sk_tiempo", "sk_cliente", "sk_empleado", "sk_producto", "sk_shipper", "nk_order_id", *MEASURES]
GRAIN = ["nk_order_id", "sk_producto"]


@dataclass(frozen=True)
class DimKey:
    """Look up ``surrogate`` of ``dim`` where its ``natural`` key equals the base column ``column``."""

    dim: DataFrame
    natural: str
    surrogate: str
    column: str
    required: bool = False


def prorate(amount: Column, parts: Column) -> Column:
    """Equal share of an order amount per line, four decimals; a missing amount counts as zero."""
    return num.ratio(F.coalesce(amount, F.lit(0)).cast(num.MONEY), parts).cast(num.MONEY)


def measures(quantity: Column, price: Column, discount: Column) -> dict[str, Column]:
    """Gross, discount and net; each is rounded on its own."""
    gross = quantity * price
    return {
        "monto_bruto": F.round(gross, 4).cast(num.MONEY),
        "monto_descuento": F.round(gross * discount, 4).cast(num.MONEY),
        "monto_neto": F.round(gross * (F.lit(1) - discount), 4).cast(num.MONEY),
    }


def load_fact(
    lines: DataFrame,
    orders: DataFrame,
    keys: Sequence[DimKey],
    calendar: DataFrame | None = None,
    order_key: str = "order_id",
) -> DataFrame:
    """Fact rows from order lines and order headers.

    Every key is looked up where it lives: header keys on the (much smaller) headers, line keys on
    the narrow lines, and the two meet once by order. Lines of a required dimension without a match
    are left out; optional ones keep a NULL key. With a ``calendar`` the date must be in it.
    Dimensions are broadcast when Spark finds them small and otherwise joined with its skew handling.

    The freight share needs the lines of an order; they are counted before any join. The headers are
    written with all that the fact takes of them, so both sides of the last join come straight from a shuffle and
    Spark splits the lines of a heavy order. ``lines`` is read twice, so it should be a stored table.
    """
    counts = lines.groupBy(order_key).agg(F.count(F.lit(1)).alias("n_lineas"))
    headers = orders.filter(F.col("order_date").isNotNull())
    if calendar is not None:
        headers = headers.join(calendar.select(F.col("fecha").alias("order_date"), "sk_tiempo"), "order_date")
    else:
        headers = headers.withColumn("sk_tiempo", date_key(F.col("order_date")))
    for key in keys:
        lookup = key.dim.select(F.col(key.natural).alias(key.column), key.surrogate)
        how = "inner" if key.required else "left"
        if key.column in lines.columns:
            lines = _looked_up(lines, lookup, key.column, how)
        else:
            headers = _looked_up(headers, lookup, key.column, how)
    present = [k.surrogate for k in keys]
    of_order = [k.surrogate for k in keys if k.column not in lines.columns]
    share = prorate(F.col("freight"), F.col("n_lineas")).alias("flete_prorrateado")
    headers = headers.join(counts, order_key).select(order_key, "sk_tiempo", *of_order, share)
    rows = lines.join(materialize(headers), order_key)
    absent = {k: F.lit(None).cast("bigint") for k in FACT_COLUMNS[1:5] if k not in present}
    rows = rows.withColumns(absent) if absent else rows
    quantity, price, discount = F.col("quantity"), F.col("unit_price"), F.col("discount")
    return rows.select(
        *FACT_COLUMNS[:5],
        F.col(order_key).alias("nk_order_id"),
        quantity.alias("cantidad"),
        price.alias("precio_unitario"),
        discount.alias("descuento"),
        "flete_prorrateado",
        *[value.alias(name) for name, value in measures(quantity, price, discount).items()],
    )


def _looked_up(rows: DataFrame, lookup: DataFrame, key: str, how: str) -> DataFrame:
    """``rows.join(lookup, key, how)``; NULL keys go around the join, so they do not meet in one task."""
    found = rows.filter(F.col(key).isNotNull()).join(lookup, key, how)
    if how == "inner":
        return found
    new = [c for c in lookup.columns if c != key]
    absent = {f.name: F.lit(None).cast(f.dataType) for f in lookup.schema if f.name in new}
    return found.unionByName(rows.filter(F.col(key).isNull()).withColumns(absent))


def rejected_lines(
    table: str, lines: DataFrame, orders: DataFrame, keys: Sequence[DimKey], order_key: str = "order_id", line_key: str = "product_id"
) -> DataFrame:
    """One reject row per line that ``load_fact`` leaves out: unknown order, no order date, or a required key without a match."""
    reason = F.lit(None).cast("string")
    headers = orders.select(order_key, "order_date", *[k.column for k in keys if k.required and k.column not in lines.columns])
    joined = lines.join(headers.withColumn("_known", F.lit(True)), order_key, "left")
    for i, key in enumerate(k for k in keys if k.required):
        lookup = key.dim.select(F.col(key.natural).alias(key.column)).distinct().withColumn(f"_has{i}", F.lit(True))
        joined = joined.join(lookup, key.column, "left")
        bad = F.col("_known") & F.col(f"_has{i}").isNull()
        named = F.concat(F.lit(f"Sin {key.natural}: "), F.coalesce(F.col(key.column).cast("string"), F.lit("NULL")))
        reason = F.coalesce(reason, F.when(bad, named))
    reason = F.coalesce(
        F.when(F.col("_known").isNull(), F.lit("Pedido inexistente")),
        F.when(F.col("order_date").isNull(), F.lit("Pedido sin fecha")),
        reason,
    )
    return joined.withColumn("motivo_rechazo", reason).filter("motivo_rechazo IS NOT NULL").select(
        F.lit(table).alias("tabla_origen"),
        F.concat_ws("/", F.col(order_key).cast("string"), F.col(line_key).cast("string")).alias("clave_registro"),
        "motivo_rechazo",
        F.lit(num.REJECTED_PARTIAL).alias("decision"),
    )


def footprint(target: str, read: DataFrame, loaded: DataFrame, reason: str, decision: str | None = None) -> DataFrame:
    """One row: rows read, inserted, rejected and the resulting decision."""
    counts = (
        read.agg(F.count(F.lit(1)).alias("leidos"), F.lit(0).cast("bigint").alias("insertados"))
        .unionByName(loaded.agg(F.lit(0).cast("bigint").alias("leidos"), F.count(F.lit(1)).alias("insertados")))
        .agg(F.sum("leidos").alias("registros_leidos"), F.sum("insertados").alias("registros_insertados"))
    )
    gone = F.col("registros_leidos") - F.col("registros_insertados")
    verdict = (
        F.lit(decision)
        if decision
        else F.when(gone == 0, num.LOADED).when(F.col("registros_insertados") > 0, num.PARTIAL).otherwise(num.REJECTED)
    )
    return counts.select(
        F.lit(target).alias("tabla_destino"),
        "registros_leidos",
        "registros_insertados",
        gone.alias("registros_rechazados"),
        verdict.alias("decision"),
        F.when(gone > 0, F.lit(reason)).alias("motivo_rechazo"),
    )


def load_status(footprints: DataFrame) -> DataFrame:
    """State of a run from its load decisions, with the rows inserted."""
    seen = footprints.agg(
        F.count_if(F.col("decision") == num.REJECTED).alias("no"),
        F.count_if(F.col("decision") == num.PARTIAL).alias("part"),
        F.sum("registros_insertados").alias("registros_proc"),
    )
    state = F.when(F.col("no") > 0, num.ERROR).when(F.col("part") > 0, num.WARNING).otherwise(num.OK)
    return seen.select(state.alias("resultado"), "registros_proc")
