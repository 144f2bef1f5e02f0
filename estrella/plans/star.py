"""Build a star from staged frames, written as Parquet tables and read back."""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estrella.functions.numbers import score_segment
from estrella.functions.text import full_name
from estrella.operators import dims
from estrella.operators.calendar import calendar_range
from estrella.operators.facts import DimKey, load_fact
from estrella.operators.upsert import assign_keys
from estrella.session import CODEC, work_path
from estrella.sources.files import overwrite

LINE_COLUMNS = ["order_id", "product_id", "employee_id", "unit_price", "quantity", "discount"]


class StagedSource(Protocol):
    def countries(self) -> DataFrame: ...
    def customers(self) -> DataFrame: ...
    def sellers(self) -> DataFrame: ...
    def shippers(self) -> DataFrame: ...
    def categories(self) -> DataFrame: ...
    def brands(self) -> DataFrame: ...
    def products(self) -> DataFrame: ...
    def orders(self) -> DataFrame: ...
    def lines(self) -> DataFrame: ...


@dataclass(frozen=True)
class Star:
    calendar: DataFrame
    countries: DataFrame
    customers: DataFrame
    employees: DataFrame
    products: DataFrame
    shippers: DataFrame
    fact: DataFrame
    lines: DataFrame

    def keys(self, required: tuple[str, ...] = ("product",)) -> list[DimKey]:
        """Key lookups of the fact; those named in ``required`` drop lines without a match."""
        wanted = [
            ("product", DimKey(self.products, "nk_product_id", "sk_producto", "product_id")),
            ("customer", DimKey(self.customers, "nk_customer_id", "sk_cliente", "customer_id")),
            ("employee", DimKey(self.employees, "nk_employee_id", "sk_empleado", "employee_id")),
            ("shipper", DimKey(self.shippers, "nk_shipper_id", "sk_shipper", "ship_via")),
        ]
        return [DimKey(k.dim, k.natural, k.surrogate, k.column, name in required) for name, k in wanted]


def country_dim(source: StagedSource) -> DataFrame:
    return assign_keys(None, source.countries().filter("country_name IS NOT NULL"), "country_name", "sk_pais")


def customer_dim(source: StagedSource, countries: DataFrame) -> DataFrame:
    place = countries.select(F.col("country_name").alias("country"), "sk_pais")
    located = source.customers().join(place, "country", "left")
    scored = located.withColumn("customer_score", F.ceil(F.col("balance") / 2000).cast("int"))
    scored = scored.withColumn("customer_score", F.when(F.col("customer_score").between(1, 5), F.col("customer_score")))
    scored = scored.withColumn("customer_score_segmento", score_segment(F.col("customer_score")))
    return assign_keys(None, scored, "nk_customer_id", "sk_cliente")


def employee_dim(source: StagedSource) -> DataFrame:
    staged = source.sellers()
    base = staged.select(
        F.col("employee_id").alias("nk_employee_id"),
        full_name(F.col("first_name"), F.col("last_name")).alias("nombre_completo"),
        "title",
        "country",
    )
    keyed = assign_keys(None, base, "nk_employee_id", "sk_empleado")
    return dims.resolve_parent(
        keyed, staged, "nk_employee_id", "employee_id", "reports_to", "sk_empleado", "reports_to_sk"
    )


def product_dim(source: StagedSource, countries: DataFrame) -> DataFrame:
    flat = dims.denormalize(
        source.products(),
        [
            dims.Reference(
                source.categories(),
                ("category_id", "category_id"),
                {"category_name": "category_name", "description": "category_description"},
            ),
            dims.Reference(
                source.brands(),
                ("supplier_id", "supplier_id"),
                {"company_name": "supplier_name", "country": "supplier_country"},
            ),
            dims.Reference(countries, ("supplier_country", "country_name"), {"sk_pais": "sk_pais_supplier"}),
        ],
    )
    base = flat.select(
        F.col("product_id").alias("nk_product_id"),
        "product_name",
        F.col("unit_price").alias("precio_lista"),
        (F.col("discontinued") == 1).alias("discontinued"),
        "category_name",
        "category_description",
        "supplier_name",
        "supplier_country",
        "sk_pais_supplier",
    )
    return assign_keys(None, base, "nk_product_id", "sk_producto")


def build_star(source: StagedSource, root: str) -> Star:
    """Write dimensions, staged lines, then the fact partitioned by year, under ``root``."""
    spark = SparkSession.active()

    def stored(name: str, df: DataFrame) -> DataFrame:
        return overwrite(df, f"{root}/{name}")

    calendar = stored("dim_tiempo", calendar_range(source.orders(), "order_date", ["required_date", "shipped_date"]))
    countries = stored("dim_pais", country_dim(source))
    customers = stored("dim_cliente", customer_dim(source, countries))
    employees = stored("dim_empleado", employee_dim(source))
    products = stored("dim_producto", product_dim(source, countries))
    shippers = stored("dim_shipper", assign_keys(None, source.shippers(), "nk_shipper_id", "sk_shipper"))
    lines = stored("stg_order_details", source.lines().select(*LINE_COLUMNS))
    star = Star(calendar, countries, customers, employees, products, shippers, calendar, lines)
    write_fact(load_fact(lines, source.orders(), star.keys(), calendar), f"{root}/fact_ventas")
    return replace(star, fact=spark.read.parquet(f"{root}/fact_ventas"))


def write_fact(fact: DataFrame, path: str) -> None:
    """Partition by year. No shuffle is added: each task writes the years it holds."""
    yearly = fact.withColumn("anio", F.expr("int(sk_tiempo div 10000)"))
    yearly.write.mode("overwrite").option("compression", CODEC).partitionBy("anio").parquet(path)


_built: dict[tuple[str, str], Star] = {}


def star_of(spark: SparkSession, source: StagedSource, name: str) -> Star:
    """The star of a source, built once per application like the stored tables of a warehouse."""
    key = (spark.sparkContext.applicationId, name)
    if key not in _built:
        _built[key] = build_star(source, work_path(spark))
    return _built[key]
