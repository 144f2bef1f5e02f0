"""Type-2 history: first snapshot, merge of a batch, lookup of the version valid at a date.

A history holds key, surrogate key, tracked columns, ``fecha_desde``, ``fecha_hasta`` (NULL while
open) and ``es_vigente``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from estrella.session import materialize

VALIDITY = ["fecha_desde", "fecha_hasta", "es_vigente"]


def first_sale(fact: DataFrame, calendar: DataFrame, surrogate: str) -> DataFrame:
    """First sale date per key, of the sales on days the calendar has; one row per key and day meets the calendar."""
    days = fact.filter(F.col(surrogate).isNotNull()).select(surrogate, "sk_tiempo").distinct()
    return days.join(calendar.select("sk_tiempo", "fecha"), "sk_tiempo").groupBy(surrogate).agg(F.min("fecha").alias("fecha"))


def start_history(
    dim: DataFrame, first: DataFrame, key: str, surrogate: str, tracked: Sequence[str], default: Column
) -> DataFrame:
    """Open version per key, valid from its first sale or, without sales, from ``default``."""
    return dim.join(first, surrogate, "left").select(
        key,
        surrogate,
        *tracked,
        F.coalesce("fecha", default.cast("date")).alias("fecha_desde"),
        F.lit(None).cast("date").alias("fecha_hasta"),
        F.lit(True).alias("es_vigente"),
    )


def effective_date(orders: DataFrame, column: str, default: Column) -> Column:
    """Earliest date of a batch as a one-value subquery; ``default`` for an empty batch."""
    return orders.agg(F.coalesce(F.min(column), default.cast("date"))).scalar()


def merge_history(
    history: DataFrame, dim: DataFrame, key: str, surrogate: str, tracked: Sequence[str], effective: Column
) -> DataFrame:
    """History after a batch: changed versions are closed and reopened, new keys are added.

    A version that starts on or after the effective date cannot be closed the day before it; such
    keys are left as they are and reported by ``merge_conflicts``. Running the same batch again
    changes nothing.
    """
    columns = [key, surrogate, *tracked]
    versions = _paired(history, dim, key, columns, tracked, effective, True)
    return history.filter(~F.col("es_vigente")).select(*columns, *VALIDITY).unionByName(versions)


def version_changes(
    history: DataFrame, dim: DataFrame, key: str, surrogate: str, tracked: Sequence[str], effective: Column
) -> DataFrame:
    """What ``merge_history`` changes, as rows to upsert by key and ``fecha_desde``: the versions that close, and those that open."""
    return _paired(history, dim, key, [key, surrogate, *tracked], tracked, effective, False)


def _paired(
    history: DataFrame, dim: DataFrame, key: str, columns: Sequence[str], tracked: Sequence[str], effective: Column, every: bool
) -> DataFrame:
    """The open versions after a batch with those that it closes; with ``every`` also the open ones that stay as they are."""
    current = history.filter("es_vigente").select(key, F.struct(*columns, "fecha_desde").alias("old"))
    fresh = dim.select(key, F.struct(*columns).alias("new"))
    paired = current.join(fresh, key, "full_outer").withColumn("_eff", effective)
    same = reduce(lambda a, b: a & b, [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in tracked])
    changed = F.col("old").isNotNull() & F.col("new").isNotNull() & ~same & (F.col("old.fecha_desde") < F.col("_eff"))

    nothing = F.lit(None).cast("date")
    kept = _version("old", columns, F.col("old.fecha_desde"), nothing, True)
    closed = _version("old", columns, F.col("old.fecha_desde"), F.date_sub("_eff", 1), False)
    opened = _version("new", columns, F.col("_eff"), nothing, True)
    versions = F.when(F.col("old").isNull(), F.array(opened)).when(changed, F.array(closed, opened))
    if every:
        versions = versions.otherwise(F.array(kept))
    return paired.select(F.inline(versions))


def _version(side: str, columns: Sequence[str], start: Column, end: Column, is_open: bool) -> Column:
    return F.struct(
        *[F.col(f"{side}.{c}").alias(c) for c in columns],
        start.alias("fecha_desde"),
        end.alias("fecha_hasta"),
        F.lit(is_open).alias("es_vigente"),
    )


def merge_conflicts(
    history: DataFrame, dim: DataFrame, key: str, tracked: Sequence[str], effective: Column, table: str
) -> DataFrame:
    """Reject rows for changed keys whose open version starts on or after the effective date."""
    old = history.filter("es_vigente").select(key, "fecha_desde", *[F.col(c).alias(f"_o_{c}") for c in tracked])
    both = old.join(dim.select(key, *tracked), key).withColumn("_eff", effective)
    same = reduce(lambda a, b: a & b, [F.col(f"_o_{c}").eqNullSafe(F.col(c)) for c in tracked])
    late = both.filter(~same & (F.col("fecha_desde") >= F.col("_eff")))
    return late.select(
        F.lit(table).alias("tabla_origen"),
        F.col(key).cast("string").alias("clave_registro"),
        F.concat(F.lit("Version vigente posterior a la fecha efectiva: "), F.col("fecha_desde").cast("string")).alias("motivo_rechazo"),
        F.lit("RECHAZADO").alias("decision"),
    )


def observed(rows: DataFrame, key: str, surrogate: str, tracked: Sequence[str], effective: Column, batch: int) -> DataFrame:
    """What a batch saw: its rows as observations (key, surrogate, tracked columns, ``fecha``, ``lote``) of its effective date."""
    return rows.filter(F.col(key).isNotNull()).select(
        key, surrogate, *tracked, effective.cast("date").alias("fecha"), F.lit(batch).cast("long").alias("lote")
    )


def observations_of(history: DataFrame, key: str, surrogate: str, tracked: Sequence[str]) -> DataFrame:
    """A history that was not built from observations, as observations of batch 0 at the start of each version."""
    return history.select(key, surrogate, *tracked, F.col("fecha_desde").alias("fecha"), F.lit(0).cast("long").alias("lote"))


def chains(log: DataFrame, key: str, surrogate: str, tracked: Sequence[str]) -> DataFrame:
    """The history that a set of observations tells, whatever order they came in.

    An observation holds until the next one of its key. Those that repeat the state before them start no version; of
    several of one day the one of the latest batch counts (of one batch: the greatest by its columns). The last
    version of a key is open. A key has at most one observation a batch, which bounds what a window gathers.
    """
    one = log.groupBy(key, "fecha").agg(F.max(F.struct("lote", *tracked, surrogate)).alias("o"))
    by_key = Window.partitionBy(key).orderBy("fecha")
    state = F.struct(*[F.col(f"o.{c}") for c in tracked])
    turned = one.withColumns({"_first": F.row_number().over(by_key) == 1, "_same": F.lag(state).over(by_key).eqNullSafe(state)})
    turns = turned.filter("_first OR NOT _same")
    following = F.lead("fecha").over(by_key)
    return turns.select(
        key,
        F.col(f"o.{surrogate}").alias(surrogate),
        *[F.col(f"o.{c}").alias(c) for c in tracked],
        F.col("fecha").alias("fecha_desde"),
        F.date_sub(following, 1).alias("fecha_hasta"),
        following.isNull().alias("es_vigente"),
    )


def splice_history(
    history: DataFrame, log: DataFrame, batch: DataFrame, key: str, surrogate: str, tracked: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """History and log of observations after a batch of any date.

    ``log`` holds all earlier observations and ``batch`` the new ones (``observed``). A batch that is older than what is known
    is spliced into the versions of its keys: it splits the one it falls into, moves the start of an equal one that follows, or
    changes nothing. So batches that arrive in any order, or twice, give one history. Only chains of keys in the
    batch are built anew; the versions of other keys pass as they are.
    """
    batch = materialize(batch)
    keys = batch.select(key).distinct()
    rebuilt = chains(log.join(keys, key, "left_semi").unionByName(batch), key, surrogate, tracked)
    passed = history.join(keys, key, "left_anti").select(key, surrogate, *tracked, *VALIDITY)
    return passed.unionByName(rebuilt), log.unionByName(batch)


def broken_versions(history: DataFrame, key: str) -> DataFrame:
    """Versions ending before they start and keys with more than one open version."""
    reversed_ = history.filter(F.col("fecha_hasta") < F.col("fecha_desde")).select(
        F.col(key).cast("string").alias("clave"), F.lit("FECHAS_INVERTIDAS").alias("control")
    )
    several = (
        history.filter("es_vigente").groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    ).select(F.col(key).cast("string").alias("clave"), F.lit("VARIAS_VIGENTES").alias("control"))
    return reversed_.unionByName(several)


def version_at(rows: DataFrame, history: DataFrame, key: str, date: str, columns: Sequence[str]) -> DataFrame:
    """Attach the version of ``key`` valid on ``date``; rows before the first version get NULLs.

    Rows and versions are dealt together into sorted ranges over (key, date), so a frequent key spreads over as many
    ranges as its rows fill, also those of one day. Each task carries the last version along its range; the last one of
    every range, one row a task, goes on into the ranges behind it. That is one shuffle, and work linear in rows plus
    versions. Of versions that start on one day the one that ends last counts. Rows without a key or a date have
    no version.
    """
    values = F.struct(
        F.col("fecha_desde").alias("_from"),
        F.col("fecha_hasta").alias("_to"),
        *[F.col(c).alias(f"_v_{c}") for c in columns],
    )
    starts = history.filter(F.col(key).isNotNull() & F.col("fecha_desde").isNotNull()).select(
        F.col(key).alias("_key"),
        F.col("fecha_desde").cast("date").alias("_at"),
        F.lit(0).alias("_kind"),
        # days to the end; an open version comes last of its day
        F.coalesce(F.datediff("fecha_hasta", "fecha_desde").cast("long"), F.lit((1 << 63) - 1)).alias("_tie"),
        values.alias("_version"),
    )
    own = F.struct(*[F.col(c).alias(f"_r_{c}") for c in rows.columns]).alias("_row")
    datable = F.col(key).isNotNull() & F.col(date).isNotNull()
    asked = rows.filter(datable).select(
        F.col(key).alias("_key"), F.col(date).cast("date").alias("_at"), F.lit(1).alias("_kind"), F.xxhash64(*rows.columns).alias("_tie"), own
    )
    events = starts.withColumn("_row", F.lit(None).cast(asked.schema["_row"].dataType)).unionByName(
        asked.withColumn("_version", F.lit(None).cast(starts.schema["_version"].dataType))
    )
    order = ["_key", "_at", "_kind", "_tie"]
    met = _carried(events.repartitionByRange(*order).sortWithinPartitions(*order))
    lasts = met.filter("_kind = 0").select("_part", F.struct("_key", "_version").alias("_last"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = lasts.select("_part", F.last(F.when(F.col("_last._version").isNotNull(), F.col("_last")), ignorenulls=True).over(earlier).alias("_last"))
    # one row per range
    joined = met.filter("_kind = 1").join(F.broadcast(before), "_part", "left")
    carried = F.when(F.col("_last._key") == F.col("_key"), F.col("_last._version"))
    found = joined.select("_row", "_at", F.coalesce("_version", carried).alias("_version"))
    without = rows.filter(~datable).select(own, F.lit(None).cast("date").alias("_at")).withColumn(
        "_version", F.lit(None).cast(found.schema["_version"].dataType)
    )
    valid = F.col("_version._to").isNull() | (F.col("_at") <= F.col("_version._to"))
    return found.unionByName(without).select(
        *[F.col(f"_row._r_{c}").alias(c) for c in rows.columns],
        *[F.when(valid, F.col(f"_version._v_{c}")).alias(f"{c}_vigente") for c in columns],
    )


def _carried(events: DataFrame) -> DataFrame:
    """The rows of sorted ranges, each with the last version of its key in its range, and the range's number ``_part``.

    Every range also gives one row of kind 0, its last version with its key (NULLs without any). A window cannot
    do this without dealing the ranges anew, so Arrow batches are filled forward in Python.
    """
    names = ["_key", "_at", "_kind", "_row", "_version"]
    events = events.select(*names)
    schema = StructType([*events.schema.fields, StructField("_part", IntegerType())])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last = None  # the key and version that a batch takes over from the one before
        for batch in batches:
            keys, versions, kinds = batch.column("_key"), batch.column("_version"), batch.column("_kind").to_numpy()
            if last is None:
                last = keys.slice(0, 1).take(pa.array([None], pa.int64())), versions.slice(0, 1).take(pa.array([None], pa.int64()))
            # place 0 is what was carried over
            keys, versions = pa.concat_arrays([last[0], keys]), pa.concat_arrays([last[1], versions])
            at = np.maximum.accumulate(np.concatenate([[0], np.where(kinds == 0, np.arange(1, len(kinds) + 1), 0)]))
            last = keys.take(pa.array(at[-1:])), versions.take(pa.array(at[-1:]))
            rows = np.flatnonzero(kinds == 1) + 1
            same = pc.fill_null(pc.equal(keys.take(pa.array(at[rows])), keys.take(pa.array(rows))), False)
            chosen = pc.if_else(same, pa.array(at[rows]), pa.scalar(None, pa.int64()))
            asked = batch.take(pa.array(rows - 1))
            columns = [asked.column(n) for n in names[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, versions.take(chosen), pa.array([part] * len(rows), pa.int32())], names=[*names, "_part"])
        if last is not None:
            none = [pa.nulls(1, f.type) for f in batch.schema if f.name in ("_at", "_row")]
            made = [last[0], none[0], pa.array([0], pa.int32()), none[1], last[1], pa.array([part], pa.int32())]
            yield pa.RecordBatch.from_arrays(made, names=[*names, "_part"])

    return materialize(events.mapInArrow(fill, schema))
