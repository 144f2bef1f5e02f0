"""Reading raw CSV files and writing warehouse tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from estrella.operators.marts import row_counts
from estrella.session import CODEC, materialize


def read_raw_csv(
    spark: SparkSession, path: str, names: Sequence[str], sep: str = ",", quote: str = '"', multiline: bool = False
) -> DataFrame:
    """Headed CSV as text columns, named by position. Nothing is inferred or dropped.

    ``multiline`` allows line breaks inside quotes, at the price of unsplittable files.
    """
    schema = StructType([StructField(n, StringType()) for n in names])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("sep", sep)
        .option("quote", quote)
        .option("escape", quote)
        .option("encoding", "UTF-8")
        .option("mode", "FAILFAST")
        .option("multiLine", multiline)
        # a bare empty field is NULL, a quoted one is an empty text
        .option("nullValue", "\u0000")
        .option("emptyValue", "")
        .csv(path)
    )


def import_csv(
    spark: SparkSession, path: str, names: Sequence[str], sep: str = ",", quote: str = '"', longest: int = 1 << 20
) -> tuple[DataFrame, DataFrame]:
    """Good lines of headed CSV files as text columns, and the other lines with file, line number and reason.

    A line is bad if it has more or fewer fields than ``names``, a quote that is not closed, or more than ``longest``
    characters; a bad line costs no other line. The first line of each file is its header, blank lines are
    skipped. Fields are read as by ``read_raw_csv``; fields with line breaks need that. The lines are
    parsed in one scan and written once; numbers are found for bad lines only, from the line counts of file blocks.
    """
    fields = len(names)
    mark, cut = re.escape(quote), F.lit(sep)
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )
    bare = F.regexp_replace("value", f"{mark}[^{mark}]*{mark}", "")
    found = ((F.length("_bare") - F.length(F.replace("_bare", cut, F.lit("")))) / len(sep) + 1).cast("int")
    # fixed values: the wording of the reject reasons
    reason = (
        F.when(F.length("value") > longest, F.concat(F.lit("Linea demasiado larga: "), F.length("value"), F.lit(" caracteres")))
        .when(F.contains("_bare", F.lit(quote)), F.lit("Comillas sin cerrar"))
        .when(found < fields, F.concat(F.lit("Faltan campos: "), found, F.lit(f" de {fields}")))
        .when(found > fields, F.concat(F.lit("Sobran campos: "), found, F.lit(f" de {fields}")))
    )
    options = {"sep": sep, "quote": quote, "escape": quote, "nullValue": "\u0000", "emptyValue": "", "maxCharsPerColumn": str(longest + 1)}
    schema = StructType([StructField(n, StringType()) for n in names])
    judged = lines.withColumn("_bare", bare).withColumn("_reason", F.when(F.trim("value") != "", reason)).drop("_bare")
    good = F.col("_reason").isNull() & (F.trim("value") != "")
    parsed = judged.withColumn("_row", F.when(good, F.from_csv("value", schema.simpleString(), options)))
    # the text of a good line is not kept
    stored = materialize(parsed.withColumn("value", F.when(~good, F.col("value"))))
    blocks = stored.groupBy("_file", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = materialize(blocks.withColumn("_before", F.coalesce(F.sum("_lines").over(earlier), F.lit(0))))
    headers = blocks.filter("_before = 0").select(F.col("_first").alias("_id"))
    body = stored.join(headers, "_id", "left_anti")
    rejects = body.filter("_reason IS NOT NULL").join(blocks, ["_file", "_block"]).select(
        F.col("_file").alias("archivo"),
        (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("linea"),
        F.col("value").alias("texto"),
        F.col("_reason").alias("motivo_rechazo"),
    )
    return body.filter("_row IS NOT NULL").select("_row.*"), rejects


def write_raw_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"').csv(path)


def append(df: DataFrame, path: str, partition: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition).parquet(path)


def overwrite(df: DataFrame, path: str, partition: Sequence[str] = ()) -> DataFrame:
    """Replace a table that ``df`` does not read."""
    df.write.mode("overwrite").option("compression", CODEC).partitionBy(*partition).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish(df: DataFrame, root: str, partition: Sequence[str] = ()) -> str:
    """Write a new version next to the older ones and return its path.

    Safe when ``df`` reads an older version of the same table.
    """
    path = f"{root}/v={uuid.uuid4().hex}"
    df.write.partitionBy(*partition).parquet(path)
    return path


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true (unknown keeps the row)."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def control_total(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per imported table plus the batch total as table ``TOTAL``."""
    counts = row_counts(dict(tables))
    return counts.unionByName(counts.agg(F.lit("TOTAL").alias("tabla"), F.sum("registros").alias("registros")))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a completely written table is at ``path``."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)
