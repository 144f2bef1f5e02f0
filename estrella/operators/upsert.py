"""Insert-if-absent, upsert and backfill by key, on frames and on partitioned Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from estrella.operators.ranking import first_per_key, global_row_number
from estrella.session import materialize


_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def insert_new(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Target plus the source rows whose key it does not hold; the first row per key wins, by ``order`` or else by all columns.

    The source is written, and the target's keys are reduced to those the source has before they
    meet it; Spark broadcasts the source's keys if their size allows.
    """
    source = materialize(source)
    present = target.select(*key).join(source.select(*key), list(key), "left_semi")
    fresh = source.join(present, list(key), "left_anti")
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    # as for a unique index, a key with a NULL in it conflicts with no other
    fresh = first_per_key(fresh.filter(whole), key, order or source.columns).unionByName(fresh.filter(~whole))
    return target.unionByName(fresh, allowMissingColumns=True)


def insert_new_by_prefix(
    target: DataFrame, source: DataFrame, key: Sequence[str], text: str, prefix: str
) -> DataFrame:
    """Insert-if-absent where only target rows whose ``text`` starts with ``prefix`` count."""
    present = target.filter(F.col(text).startswith(prefix)).select(*key)
    return target.unionByName(source.join(present, list(key), "left_anti"), allowMissingColumns=True)


def duplicate_keys(source: DataFrame, key: Sequence[str]) -> DataFrame:
    return source.groupBy(*key).agg(F.count(F.lit(1)).alias("veces")).filter("veces > 1")


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    columns: Sequence[str],
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Source rows overwrite ``columns`` of target rows with the same key, NULLs included.

    Unmatched source rows are added with every column they carry; other target columns of matched
    rows keep their value. ``order`` picks the first source row when a key repeats. The source is
    written; if its keys are small enough for Spark to broadcast, target rows that it does not touch
    pass without a shuffle.
    """
    if order is not None:
        source = first_per_key(source, key, order)
    source = materialize(source)
    keys = source.select(*key)
    untouched = target.join(keys, list(key), "left_anti")
    if all(c in source.columns and (c in columns or c in key) for c in target.columns):
        # nothing of a matched row survives
        return untouched.unionByName(source.select(*target.columns))
    return untouched.unionByName(_merge(target.join(keys, list(key), "left_semi"), source, key, columns))


def _merge(target: DataFrame, source: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    renamed = source.select(*key, *[F.col(c).alias(f"_s_{c}") for c in source.columns if c not in key])
    left = target.withColumn("_old", F.lit(True))
    merged = left.join(renamed.withColumn("_new", F.lit(True)), list(key), "full_outer")
    out = []
    for name in target.columns:
        if name in key or name not in source.columns:
            out.append(F.col(name))
        elif name in columns:
            out.append(F.when(F.col("_new"), F.col(f"_s_{name}")).otherwise(F.col(name)).alias(name))
        else:
            out.append(F.when(F.col("_old"), F.col(name)).otherwise(F.col(f"_s_{name}")).alias(name))
    return merged.select(*out)


def assign_keys(target: DataFrame | None, source: DataFrame, key: str, surrogate: str) -> DataFrame:
    """Source rows with a surrogate key: the target's where the key is known, else the next free.

    New keys are numbered in key order, so the result does not depend on partitioning.
    """
    if target is None:
        return global_row_number(source, [key], surrogate)
    source = materialize(source)
    known = target.select(key, surrogate).join(source.select(key), key, "left_semi")
    fresh = global_row_number(source.select(key).join(known, key, "left_anti"), [key], "_n")
    last = target.agg(F.coalesce(F.max(surrogate), F.lit(0)).cast("bigint")).scalar()
    numbered = fresh.select(key, (F.col("_n") + last).alias(surrogate))
    return source.join(known.unionByName(numbered), key)


def fill_missing(
    df: DataFrame, lookup: DataFrame, on: tuple[str, str], column: str, source: str
) -> DataFrame:
    """Set ``column`` from ``lookup.source`` where it is NULL; ``on`` is (df column, lookup column)."""
    found = lookup.select(F.col(on[1]).alias(on[0]), F.col(source).alias("_found"))
    joined = df.join(found, on[0], "left")
    return joined.select(*[F.coalesce(column, "_found").alias(column) if c == column else F.col(c) for c in df.columns])


def ensure_columns(df: DataFrame, fields: Sequence[StructField]) -> DataFrame:
    """Add the columns that are missing, as NULL."""
    absent = {f.name: F.lit(None).cast(f.dataType) for f in fields if f.name not in df.columns}
    return df.withColumns(absent) if absent else df


def upsert_partitions(
    path: str,
    source: DataFrame,
    key: Sequence[str],
    columns: Sequence[str],
    partition: Sequence[str],
    order: Sequence[str] | None = None,
) -> list[tuple]:
    """Upsert into a Parquet table partitioned by ``partition``, rewriting only what changes.

    Touched partitions are those of the source rows and those where their keys live today, the NULL
    partition included. The merged rows are written aside first, so no partition is read while it is
    overwritten. The partitions left without rows are dropped after that; run again after a failure in
    between, the call gives the same table, as it finds the moved rows in both places and replaces both.
    Returns the partitions rewritten.
    """
    spark = source.sparkSession
    target = spark.read.parquet(path)
    source = materialize(source)
    homes = target.select(*key, *partition).join(source.select(*key), list(key), "left_semi").select(*partition)
    # the values of a folder as one text: a flat list of any length that folders are pruned by
    folder = F.concat_ws("/", *[F.coalesce(F.concat(F.lit("="), F.col(p).cast("string")), F.lit("")) for p in partition])
    # one row per folder of the table at most
    touched = homes.unionByName(source.select(*partition)).distinct().withColumn("_folder", folder).orderBy(*partition).collect()
    if not touched:
        return []
    affected = target.filter(folder.isin([r["_folder"] for r in touched]))
    touched = [r[:-1] for r in touched]
    merged = materialize(upsert(affected, source, key, [*columns, *partition], order))
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)
    left = {tuple(r) for r in merged.select(*partition).distinct().collect()}
    _drop_partitions(path, partition, [r for r in touched if tuple(r) not in left], spark)
    return [tuple(r) for r in touched]


def _drop_partitions(path: str, partition: Sequence[str], values: Sequence, spark) -> None:
    """A partition all of whose rows moved away gets no new files; remove the old ones."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for row in values:
        names = [f"{p}={_NULL_PARTITION if v is None else v}" for p, v in zip(partition, row, strict=True)]
        fs.delete(hadoop.Path("/".join([path, *names])), True)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
