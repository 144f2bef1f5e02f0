"""Positions in a global order, found without moving all rows through one task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from estrella.llm.shipping import ship
from estrella.session import materialize

_PLACE_BITS = 33


def row_numbers(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Number all rows from 0 in ``order``.

    Rows are dealt into sorted ranges and written once, so that counts and places come from the
    same dealing even when tasks are run again. One row per range then gives the offsets. Rows that
    tie in ``order`` get consecutive numbers in any order.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # the generated id is (partition << 33) + place in the partition
    stored = materialize(ranged.withColumn("_id", F.monotonically_increasing_id()))
    placed = stored.withColumns(
        {
            "_part": F.shiftright("_id", _PLACE_BITS),
            "_at": F.col("_id").bitwiseAND((1 << _PLACE_BITS) - 1),
        }
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_at"))
        .drop("_id", "_part", "_at", "_before")
    )


def ranged_sums(
    df: DataFrame, group: str, order: Sequence[str], weight: str
) -> tuple[DataFrame, DataFrame]:
    """The rows dealt into sorted ranges with the sum of ``weight`` so far, and one row per range and group.

    A group may spread over any number of ranges: each task sums the groups it holds (``_local`` is
    the sum over earlier rows of the same group in the same range ``_part``), and the second frame
    (_part, group, _size) carries the sums onwards. A NULL group is a group; NULL weights must be
    replaced by the caller.
    """
    ship(df.sparkSession)
    keys = [F.col(group).asc_nulls_last(), *[F.col(c) for c in order]]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = StructType(
        [*df.schema.fields, StructField("_part", IntegerType()), StructField("_local", LongType())]
    )

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, carried = object(), 0
        for batch in batches:
            names, weights = batch.column(group).to_pylist(), batch.column(weight).to_pylist()
            local = []
            for name, w in zip(names, weights, strict=True):
                if name != last:
                    last, carried = name, 0
                local.append(carried)
                carried += w
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), pa.array(local, pa.int64())],
                names=[*batch.schema.names, "_part", "_local"],
            )

    stored = materialize(ranged.mapInArrow(sums, schema))
    return stored, stored.groupBy("_part", group).agg(F.sum(weight).alias("_size"))


def add_totals(
    stored: DataFrame, pieces: DataFrame, group: str, before: str, per_group: DataFrame | None = None
) -> DataFrame:
    """Add ``before``, the sum over all earlier rows of the group, and the columns of ``per_group``.

    ``per_group`` has one row per group in its column ``group``. It is joined to the few pieces
    first, so rows of a large group meet it range by range.
    """
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        F.col("_part").alias("_o_part"),
        F.col(group).alias("_o_group"),
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
    )
    extra = []
    if per_group is not None:
        extra = [c for c in per_group.columns if c != group]
        renamed = per_group.withColumnRenamed(group, "_g_group")
        offsets = offsets.join(renamed, F.col("_o_group").eqNullSafe(F.col("_g_group")))
    same = (F.col("_part") == F.col("_o_part")) & F.col(group).eqNullSafe(F.col("_o_group"))
    rows = [c for c in stored.columns if c not in ("_part", "_local")]
    return stored.join(offsets, same).select(
        *rows, (F.col("_before") + F.col("_local")).alias(before), *extra
    )
