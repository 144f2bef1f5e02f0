"""The given sample tables seen as an order-entry source: raw text and typed staging frames.

Roles: customer and nation/region give customers and countries, part gives products (type =
category, brand = supplier), supplier gives the sellers, orders and lineitem the documents. Some
attributes are derived from row values so that every control has something to find: orders in
status P have no shipping date, the priority "not specified" is a missing shipper, negative
balances are amounts that are not plain numbers, and so on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from estrella.functions import text as txt
from estrella.operators.ranking import drop_repeats
from estrella.session import fit_partitions

MONEY2 = "decimal(12,2)"
PRICE = "decimal(10,4)"

LINE_ORDER = ["employee_id", "unit_price", "quantity", "discount", "line_number", "return_flag", "line_status", "ship_date"]


_schemas: dict[tuple[str, str], StructType] = {}


@dataclass(frozen=True)
class Source:
    spark: SparkSession
    directory: str

    def table(self, name: str) -> DataFrame:
        """A given table; its schema is read from the file once per application."""
        path = f"{self.directory}/{name}.parquet"
        key = (self.spark.sparkContext.applicationId, path)
        if key not in _schemas:
            _schemas[key] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[key]).parquet(path)

    # ---- raw text layer -------------------------------------------------------------------

    def raw_customers(self) -> DataFrame:
        segment = F.col("c_mktsegment")
        return self.table("customer").select(
            F.col("c_custkey").cast("string").alias("customer_id"),
            F.concat(F.lit(" "), "c_name", F.lit("  ")).alias("company_name"),
            F.when(segment == "HOUSEHOLD", txt.NULL_WORD).when(segment == "FURNITURE", "").otherwise(segment).alias("contact_title"),
            F.col("c_nationkey").cast("string").alias("country"),
            F.col("c_acctbal").cast(MONEY2).cast("string").alias("balance"),
            F.floor(F.abs("c_acctbal").cast(MONEY2) / 1600).cast("string").alias("score"),
        )

    def raw_products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_brand").alias("supplier_id"),
            F.col("p_type").alias("category_id"),
            F.col("p_retailprice").cast(MONEY2).cast("string").alias("unit_price"),
            F.when(F.col("p_size") <= 40, "0").when(F.col("p_size") <= 47, "1").otherwise("2").alias("discontinued"),
        )

    def raw_orders(self) -> DataFrame:
        day = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSS")
        status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
        return self.table("orders").select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            day.alias("order_date"),
            F.when(status == "F", "pending").otherwise(day).alias("required_date"),
            F.when(status == "P", txt.NULL_WORD).otherwise(day).alias("shipped_date"),
            F.when(priority == "4-NOT SPECIFIED", "").otherwise(F.substring(priority, 1, 1)).alias("ship_via"),
            F.concat(F.lit("$"), F.format_number(F.col("o_totalprice").cast(MONEY2), 2)).alias("freight"),
        )

    def raw_lines(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_extendedprice").cast(MONEY2).cast("string").alias("unit_price"),
            F.col("l_quantity").cast("int").cast("string").alias("quantity"),
            F.col("l_discount").cast("decimal(4,2)").cast("string").alias("discount"),
            F.col("l_returnflag").alias("return_flag"),
        )

    # ---- typed staging layer --------------------------------------------------------------

    def countries(self) -> DataFrame:
        region = self.table("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
        key = F.col("n_nationkey")
        return self.table("nation").join(region, "n_regionkey", "left").select(
            F.col("n_name").alias("country_name"),
            F.concat(F.lit("N"), key.cast("string")).alias("abbreviation"),
            F.concat(F.lit("Capital of "), "n_name").alias("capital_major_city"),
            F.col("r_name").alias("region"),
            (key * 3 - 36).cast("decimal(12,8)").alias("latitude"),
            F.when(F.col("r_name") != "MIDDLE EAST", key * 7 - 84).cast("decimal(12,8)").alias("longitude"),
        )

    def customers(self) -> DataFrame:
        nation = self.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
        region = self.table("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
        joined = self.table("customer").join(nation, "c_nationkey", "left").join(region, "n_regionkey", "left")
        return joined.select(
            F.col("c_custkey").alias("nk_customer_id"),
            F.col("c_name").alias("company_name"),
            F.col("c_mktsegment").alias("contact_title"),
            F.concat(F.lit("City "), F.col("c_nationkey").cast("string")).alias("city"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("country"),
            F.col("c_acctbal").cast(MONEY2).alias("balance"),
        )

    def sellers(self) -> DataFrame:
        nation = self.table("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
        key = F.col("s_suppkey")
        boss = F.floor(key / 10)
        return self.table("supplier").join(nation, "s_nationkey", "left").select(
            key.alias("employee_id"),
            F.split("s_name", "#")[0].alias("first_name"),
            F.split("s_name", "#")[1].alias("last_name"),
            F.lit("Seller").alias("title"),
            F.col("n_name").alias("country"),
            F.when(boss > 0, boss).alias("reports_to"),
        )

    def shippers(self) -> DataFrame:
        priority = self.table("orders").select("o_orderpriority").distinct()
        return priority.filter(F.col("o_orderpriority") != "4-NOT SPECIFIED").select(
            F.substring("o_orderpriority", 1, 1).cast("int").alias("nk_shipper_id"),
            F.substring("o_orderpriority", 3, 50).alias("company_name"),
        )

    def categories(self) -> DataFrame:
        kinds = self.table("part").select("p_type").distinct()
        return kinds.select(
            F.col("p_type").alias("category_id"),
            F.col("p_type").alias("category_name"),
            F.lower("p_type").alias("description"),
        )

    def brands(self) -> DataFrame:
        """Product suppliers; the brand number names a country, and one brand has none."""
        brand = self.table("part").select("p_brand").distinct()
        return brand.select(
            F.col("p_brand").alias("supplier_id"),
            F.upper("p_brand").alias("company_name"),
            F.concat(F.lit("NATION_"), F.split("p_brand", "#")[1]).alias("country"),
        )

    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_retailprice").cast(PRICE).alias("unit_price"),
            F.col("p_type").alias("category_id"),
            F.col("p_brand").alias("supplier_id"),
            F.when(F.col("p_size") > 45, 1).otherwise(0).alias("discontinued"),
        )

    def orders(self) -> DataFrame:
        day = F.col("o_orderdate").cast("date")
        priority = F.col("o_orderpriority")
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            day.alias("order_date"),
            F.date_add(day, 28).alias("required_date"),
            F.when(F.col("o_orderstatus") != "P", F.date_add(day, 7)).alias("shipped_date"),
            F.when(priority != "4-NOT SPECIFIED", F.substring(priority, 1, 1).cast("int")).alias("ship_via"),
            F.col("o_totalprice").cast(MONEY2).alias("freight"),
        )

    def all_lines(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("employee_id"),
            F.col("l_extendedprice").cast(PRICE).alias("unit_price"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_discount").cast("decimal(5,4)").alias("discount"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_returnflag").alias("return_flag"),
            F.col("l_linestatus").alias("line_status"),
            F.col("l_shipdate").cast("date").alias("ship_date"),
        )

    def lines(self) -> DataFrame:
        """One line per order and product; the first by all remaining columns wins."""
        lines = self.all_lines()
        fit_partitions(self.spark, lines.count())
        return drop_repeats(lines, ["order_id", "product_id"], LINE_ORDER)
