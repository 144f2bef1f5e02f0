"""Column catalog derived from schemas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Warehouse layers in report order, and the decisions a load may take.
LAYERS = ("dqm", "txt", "tmp", "dim", "fact", "memoria", "enriquecimiento", "dp")
DECISIONS = ("CARGADO", "CARGADO_PARCIAL", "RECHAZADO", "CORREGIDO")

SCHEMA = (
    "nombre_tabla string, nombre_columna string, tipo_dato string, descripcion string, capa_dwh string, "
    "es_pk boolean, es_fk boolean, tabla_referencia string, columna_referencia string, nullable boolean"
)


@dataclass(frozen=True)
class TableInfo:
    """What a schema does not say: layer, keys, references and descriptions."""

    layer: str
    primary_key: tuple[str, ...] = ()
    foreign_keys: Mapping[str, tuple[str, str]] | None = None
    descriptions: Mapping[str, str] | None = None


def catalog(spark: SparkSession, tables: Mapping[str, tuple[DataFrame, TableInfo]]) -> DataFrame:
    """One row per column of the given tables."""
    rows = []
    for name, (df, info) in tables.items():
        if info.layer not in LAYERS:
            raise ValueError(f"{name}: unknown layer {info.layer}")
        references = info.foreign_keys or {}
        texts = info.descriptions or {}
        for column in df.schema.fields:
            target = references.get(column.name, (None, None))
            is_key = column.name in info.primary_key
            about = texts.get(column.name) or column.metadata.get("comment") or column.name.replace("_", " ")
            rows.append(
                (name, column.name, column.dataType.simpleString(), about, info.layer, is_key,
                 column.name in references, target[0], target[1], column.nullable and not is_key)
            )
    return spark.createDataFrame(rows, SCHEMA)


def catalog_summary(entries: DataFrame) -> DataFrame:
    """Columns and keys per table, layers in their own order."""
    place = F.array_position(F.array(*[F.lit(layer) for layer in LAYERS]), F.col("capa_dwh"))
    return (
        entries.groupBy("capa_dwh", "nombre_tabla")
        .agg(
            F.count(F.lit(1)).alias("columnas"),
            F.count_if(F.col("es_pk")).alias("pks"),
            F.count_if(F.col("es_fk")).alias("fks"),
        )
        .orderBy(F.when(place > 0, place).otherwise(len(LAYERS) + 1), "nombre_tabla")
    )


def describe(entries: DataFrame, profiles: DataFrame) -> DataFrame:
    """Catalog rows with the measured profile of their column."""
    measured = profiles.withColumnsRenamed({"tabla": "nombre_tabla", "campo": "nombre_columna"})
    return entries.join(measured, ["nombre_tabla", "nombre_columna"], "left")


def outside_domain(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Rows whose value is not in the allowed set (NULL passes)."""
    return df.filter(~F.col(column).isin(list(allowed)))
