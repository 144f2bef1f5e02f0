"""Row numbers, ranks, tiles and quantiles over a whole table without a one-task window.

A window without partition keys moves every row into one task. Here the rows are range
partitioned on the order columns, sorted inside each partition and written once; each row keeps
its partition and its place in it. Row counts per partition (one row per partition) then give the
offset that turns a local place into a global one. Inputs of any size take this one path.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estrella.session import materialize, materialize_counted

_PLACE_BITS = 33


def _place(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The frame range partitioned and sorted by ``order``, with the partition ``_part`` and zero-based place ``_at``.

    It is written once: counts and rows must come from the same partitioning, also when tasks are
    run again.
    """
    # without a fixed number, adaptive execution merges neighbouring small ranges
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # the generated id is (partition << 33) + position in the partition
    stored = materialize(ranged.withColumn("_id", F.monotonically_increasing_id()))
    return stored.withColumns(
        {
            "_part": F.shiftright("_id", _PLACE_BITS),
            "_at": F.col("_id").bitwiseAND((1 << _PLACE_BITS) - 1),
        }
    ).drop("_id")


def _offsets(ranged: DataFrame, weight: Column) -> DataFrame:
    """Per partition: weight before it, its own weight and the total. One row per partition."""
    sizes = ranged.groupBy("_part").agg(F.sum(weight).alias("_size"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        "_part",
        "_size",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_size").over(everything).alias("_total"),
    )


def global_row_number(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number all rows from 1 in the order of the (together unique) columns ``order``."""
    ranged = _place(df, [F.col(c) for c in order])
    offsets = F.broadcast(_offsets(ranged, F.lit(1)).select("_part", "_before"))
    return (
        ranged.join(offsets, "_part")
        .withColumn(name, F.col("_before") + F.col("_at") + 1)
        .drop("_part", "_at", "_before")
    )


def rank_and_tile(
    df: DataFrame,
    value: str,
    key: str,
    rank_as: str | None = None,
    tile_as: str | None = None,
    tiles: int = 5,
) -> DataFrame:
    """Rank by ``value`` descending (gaps on ties) and deal into tiles by (value, key) ascending.

    ``value`` must not be NULL and ``key`` must be unique. Rows sharing one value may spread over
    many partitions, so a value held by a large share of the rows stays balanced.
    """
    ranged = _place(df, [F.col(value), F.col(key)])
    offsets = _offsets(ranged, F.lit(1))
    placed = ranged.join(F.broadcast(offsets), "_part")
    if tile_as:
        position = F.col("_before") + F.col("_at") + 1
        placed = placed.withColumn(tile_as, _exact_tile(position, tiles).cast("int"))
    if rank_as:
        local = F.rank().over(Window.partitionBy("_part").orderBy(F.desc(value)))
        greater = local - 1 + F.col("_total") - F.col("_before") - F.col("_size")
        placed = placed.withColumn("_greater", greater.cast("long"))
        # A value on a partition border continues next door, where fewer rows are greater. The
        # border values (two per partition) carry their smallest count to all their rows.
        borders = (
            placed.groupBy("_part")
            .agg(
                F.min_by(F.struct(value, "_greater"), "_at").alias("head"),
                F.max_by(F.struct(value, "_greater"), "_at").alias("tail"),
            )
            .select(F.explode(F.array("head", "tail")).alias("edge"))
            .groupBy(F.col(f"edge.{value}").alias(value))
            .agg(F.min("edge._greater").alias("_carried"))
        )
        placed = placed.join(F.broadcast(borders), value, "left").withColumn(
            rank_as, F.coalesce("_carried", "_greater") + 1
        )
        placed = placed.drop("_carried", "_greater")
    extra = [c for c in (rank_as, tile_as) if c]
    return placed.select(*df.columns, *extra)


def _exact_tile(position: Column, tiles: int) -> Column:
    size = F.expr(f"_total div {tiles}")
    extra = F.col("_total") % tiles
    wide_rows = extra * (size + 1)
    narrow_size = F.nullif(size, F.lit(0))
    narrow_at = position - 1 - wide_rows
    in_wide = (position - 1 - (position - 1) % (size + 1)) / (size + 1) + 1
    in_narrow = extra + (narrow_at - narrow_at % narrow_size) / narrow_size + 1
    return F.when(position <= wide_rows, in_wide).otherwise(in_narrow)


def quantiles(
    df: DataFrame, values: Sequence[str], points: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact interpolated quantiles of several numeric columns, per group of the columns ``by``.

    One row per (by, campo) with the list ``q``, one entry per point. NULLs do not count; a column
    without values has no row. The wanted places are found by selection: a histogram over bands of four
    percent in value shows the bands that hold them, and only rows in these are counted again in 65,536 parts, until every
    wanted part is one value. That is two or three narrow passes over the rows, all columns and groups at once;
    nothing is sorted or written but the histogram rows that are wanted.
    """
    cells = [F.struct(F.lit(c).alias("campo"), F.col(c).cast("double").alias("v")) for c in values]
    pairs = df.select(*by, F.inline(F.array(*cells))).filter("v IS NOT NULL")
    group = [*by, "campo"]

    # bands grow with the value, so one histogram suits any range: sign and logarithm, zero in between
    size = F.greatest(F.least(F.log2(F.abs("v")), F.lit(_WIDEST)), F.lit(-_WIDEST)) + _WIDEST + 1
    band = F.when(F.isnan("v"), F.lit(1 << 40)).when(F.col("v") == 0, F.lit(0)).otherwise(F.signum("v") * F.floor(size * _BANDS))
    of_group = Window.partitionBy(*group)
    counted = _histogram(pairs.withColumn("_b", band.cast("long")), group).withColumn("_total", F.sum("n").over(of_group))
    spots = [F.lit(p) * (F.col("_total") - 1) for p in points]
    places = F.array_distinct(F.array(*[f(s).cast("long") for s in spots for f in (F.floor, F.ceil)]))
    found = _picked(counted.withColumn("_wants", F.transform(places, lambda p: F.struct(p.alias("at"), p.alias("rest")))), group)
    done = []
    while True:
        found = materialize(found)
        done.append(found.filter("NOT _lo < _hi"))
        open_ = found.filter("_lo < _hi")
        if open_.isEmpty():
            break
        # a few rows per group: the parts that hold a wanted place
        parts = materialize(open_.groupBy(*group, "_total", "_lo", "_hi").agg(F.collect_list(F.struct("at", "rest")).alias("_wants")))
        renamed = parts.select(*[F.col(c).alias(f"_g_{c}") for c in group], F.col("_lo").alias("_from"), F.col("_hi").alias("_to"))
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in group])
        inside = pairs.join(renamed, same & F.col("v").between(F.col("_from"), F.col("_to")))
        step = F.floor((F.col("v") - F.col("_from")) / (F.col("_to") - F.col("_from")) * _PARTS)
        finer = _histogram(inside.withColumn("_b", step), [*group, "_from", "_to"])
        keys = parts.withColumnsRenamed({"_lo": "_g_lo", "_hi": "_g_hi", **{c: f"_g_{c}" for c in group}})
        wanted = finer.join(keys, same & (F.col("_from") == F.col("_g_lo")) & (F.col("_to") == F.col("_g_hi")))
        found = _picked(wanted, [*group, "_from", "_to"]).drop("_from", "_to")
    every = reduce(DataFrame.unionByName, done)
    picks, out = [F.max("_total").alias("_total")], []
    for i, spot in enumerate(spots):
        for name, at in (("lo", F.floor(spot)), ("hi", F.ceil(spot))):
            picks.append(F.max(F.when(F.col("at") == at, F.col("_lo"))).alias(f"{name}{i}"))
        low, high = F.col(f"lo{i}"), F.col(f"hi{i}")
        out.append(low + (high - low) * (spot - F.floor(spot)))
    return every.groupBy(*group).agg(*picks).select(*group, F.array(*out).alias("q"))


# Bands per doubling of the value, for exponents of two up to this; parts that a band is cut into.
_BANDS, _WIDEST, _PARTS = 16, 1100, 65536


def _histogram(rows: DataFrame, group: Sequence[str]) -> DataFrame:
    """Rows, smallest and largest value of each slot ``_b``."""
    return rows.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("_lo"), F.max("v").alias("_hi"))


def _picked(histogram: DataFrame, group: Sequence[str]) -> DataFrame:
    """The slots that hold a wanted place: (group, _total, at, rest, _lo, _hi), ``rest`` being the place within the slot."""
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    here = F.filter("_wants", lambda w: (w["rest"] >= F.col("_before")) & (w["rest"] < F.col("_before") + F.col("n")))
    hit = histogram.withColumn("_before", before).select(*group, "_total", "_lo", "_hi", "_before", F.explode(here).alias("_w"))
    return hit.select(*group, "_total", F.col("_w.at").alias("at"), (F.col("_w.rest") - F.col("_before")).alias("rest"), "_lo", "_hi")


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row of each key.

    Spark keeps one candidate per key and task before the shuffle, so a hot key stays small.
    """
    ranked = df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.filter("_n = 1").drop("_n")


def drop_repeats(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``first_per_key`` for keys that hardly ever repeat.

    The keys alone are counted first, and the repeated ones are written. Rows with a key of their own
    pass, and only rows of the repeated keys are compared. Whether the written keys are broadcast to
    the rows follows from their size, as Spark finds it. The input is read up to three times, so it
    should be a stored table.
    """
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    repeated, rows = materialize_counted(counted.select(*[F.col(k).alias(f"_r_{k}") for k in key]))
    if rows == 0:
        return df
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in key])
    alone = df.join(repeated, same, "left_anti")
    return alone.unionByName(first_per_key(df.join(repeated, same, "left_semi"), key, order))


def top_k(df: DataFrame, column: str, k: int, tie_break: str) -> DataFrame:
    return df.orderBy(F.desc(column), tie_break).limit(k)


def latest_by(df: DataFrame, key: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """Per key, the values of ``columns`` in the row with the highest ``order``."""
    return df.groupBy(*key).agg(*[F.max_by(c, order).alias(c) for c in columns])
