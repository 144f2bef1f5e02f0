"""Column sketches that add up: distinct counts, quantiles and frequencies of a run as a few thousand rows per column.

A sketch is a frame (campo, clase, casilla, peso) of slots with weights. The sketches of two runs merge slot by slot, by the
larger weight for distinct counts and by the sum for the others, and the merge is exactly the sketch of the rows of
both runs together. So profiles of long-lived tables need only the new rows of each run.

* ``D``, distinct counts: the longest run of leading zeros among the hashes of each of 4,096 slots (about 1.6 % standard error).
* ``Q``, quantiles of numbers: counts of bands of 2.2 percent in value (so many percent is the error of a quantile).
* ``F``, frequencies of values: counts in four rows of 2,048 slots, of which the least is an upper bound.

NULLs are in no slot. All is one pass, counted by one number per slot and added up before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

REGISTER_BITS = 12
REGISTERS = 1 << REGISTER_BITS
BANDS = 32  # of each doubling of a value
ROWS, WIDTH = 4, 2048
_WIDEST = 1100  # exponents of two
_CLASSES = ("D", "F", "Q")
# a code holds a rank below 2 ** 6 and a slot of either sign below 2 ** 19
_RANK_BITS, _SLOT_BITS = 6, 20
_RANKS, _SLOTS = 1 << _RANK_BITS, 1 << _SLOT_BITS


def _band(v: Column) -> Column:
    size = F.greatest(F.least(F.log2(F.abs(v)), F.lit(_WIDEST)), F.lit(-_WIDEST)) + _WIDEST + 1
    return F.when(v == 0, F.lit(0)).otherwise(F.signum(v) * F.floor(size * BANDS)).cast("long")


def _slot(row: int, text: Column) -> Column:
    return (F.pmod(F.xxhash64(F.lit(row), text), F.lit(WIDTH)) + row * WIDTH).cast("long")


def sketch(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The sketch of some columns; numbers have quantiles as well. NaN counts as a value, but has no quantile."""
    types = {f.name: f.dataType for f in df.schema.fields}
    fields = [
        F.struct(
            F.lit(i).cast("long").alias("f"),
            F.col(name).cast("string").alias("t"),
            (F.col(name) if isinstance(types[name], NumericType) else F.lit(None)).cast("double").alias("v"),
        )
        for i, name in enumerate(columns)
    ]
    # one row a value first: the code that makes its slots stays short enough to be compiled, whatever the number of columns
    values = df.select(F.inline(F.array(*fields))).filter("t IS NOT NULL").withColumn("h", F.xxhash64("t"))
    rest = F.shiftrightunsigned("h", REGISTER_BITS)
    zeros = F.when(rest == 0, F.lit(64 - REGISTER_BITS)).otherwise(64 - REGISTER_BITS - F.length(F.bin(rest)))
    cells = [_code("D", F.pmod("h", F.lit(REGISTERS)), zeros + 1), _code("Q", F.when(~F.isnan("v"), _band(F.col("v"))), F.lit(0))]
    cells += [_code("F", _slot(row, F.col("t")), F.lit(0)) for row in range(ROWS)]
    # rows are counted by one number for column, class, slot and rank: rows of texts would cost most of the time
    codes = values.select(F.explode(F.array(*cells)).alias("c")).filter("c IS NOT NULL")
    counted = codes.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    rank, rest = F.col("c").bitwiseAND(_RANKS - 1), F.shiftright("c", _RANK_BITS)
    slot, group = rest.bitwiseAND(_SLOTS - 1) - _SLOTS // 2, F.shiftright(rest, _SLOT_BITS).cast("int")
    names = F.array(*[F.lit(c) for c in columns])
    return _added(
        counted.select(
            names[F.floor(group / len(_CLASSES)).cast("int")].alias("campo"),
            F.array(*[F.lit(c) for c in _CLASSES])[group % len(_CLASSES)].alias("clase"),
            slot.alias("casilla"),
            F.when(rank > 0, rank).otherwise(F.col("n")).alias("peso"),
        )
    )


def _code(kind: str, slot: Column, rank: Column) -> Column:
    """Column, class, slot and rank of a register (0 for classes that count rows) as one number."""
    group = F.col("f") * len(_CLASSES) + _CLASSES.index(kind)
    return (group * _SLOTS + slot.cast("long") + _SLOTS // 2) * _RANKS + rank.cast("long")


def merge(*sketches: DataFrame) -> DataFrame:
    """The sketch of all rows that the given ones were made of."""
    rows = sketches[0]
    for more in sketches[1:]:
        rows = rows.unionByName(more)
    return _added(rows)


def _added(rows: DataFrame) -> DataFrame:
    weight = F.when(F.col("clase") == "D", F.max("peso")).otherwise(F.sum("peso")).alias("peso")
    return rows.groupBy("campo", "clase", "casilla").agg(weight)


def distinct_counts(sketch: DataFrame) -> DataFrame:
    """(campo, distintos): estimates of the distinct values."""
    registers = sketch.filter("clase = 'D'").groupBy("campo").agg(
        F.count(F.lit(1)).alias("used"), F.sum(F.pow(F.lit(2.0), -F.col("peso"))).alias("mass")
    )
    empty = F.lit(REGISTERS) - F.col("used")
    raw = (0.7213 / (1 + 1.079 / REGISTERS)) * REGISTERS * REGISTERS / (F.col("mass") + empty)
    few = F.lit(REGISTERS) * F.log(F.lit(REGISTERS) / empty)
    return registers.select("campo", F.when((raw <= 2.5 * REGISTERS) & (empty > 0), few).otherwise(raw).alias("distintos"))


def quantiles(sketch: DataFrame, points: Sequence[float]) -> DataFrame:
    """(campo, q): for each point the middle of the band that holds the value at that share of the rows."""
    bands = sketch.filter("clase = 'Q'")
    of_field = Window.partitionBy("campo")
    upto = F.sum("peso").over(of_field.orderBy("casilla"))
    counted = bands.select("campo", "casilla", "peso", upto.alias("upto"), F.sum("peso").over(of_field).alias("total"))
    middle = F.pow(F.lit(2.0), (F.abs("casilla") + 0.5) / BANDS - _WIDEST - 1) * F.signum("casilla")
    picks = []
    for point in points:
        spot = F.floor(F.lit(point) * (F.col("total") - 1))
        picks.append(F.max(F.when((F.col("upto") > spot) & (F.col("upto") - F.col("peso") <= spot), middle)))
    return counted.groupBy("campo").agg(F.array(*picks).alias("q"))


def frequencies(sketch: DataFrame, values: DataFrame) -> DataFrame:
    """(campo, valor, veces): at most how often each of some values (campo, valor as text) occurs."""
    slots = F.array(*[_slot(row, F.col("valor")) for row in range(ROWS)])
    asked = values.select("campo", "valor", F.explode(slots).alias("casilla"))
    met = asked.join(sketch.filter("clase = 'F'"), ["campo", "casilla"], "left")
    return met.groupBy("campo", "valor").agg(F.min(F.coalesce("peso", F.lit(0))).alias("veces"))


def drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """(campo, deriva): how far the values of numeric columns moved between two runs, as the population stability
    index over the doublings of the value (0: not at all; above 0.25 it is commonly called a shift)."""
    coarse = F.floor(F.col("casilla") / BANDS).alias("doble")

    def shares(sketch: DataFrame, name: str) -> DataFrame:
        counts = sketch.filter("clase = 'Q'").groupBy("campo", coarse).agg(F.sum("peso").alias("n"))
        total = F.sum("n").over(Window.partitionBy("campo"))
        return counts.select("campo", "doble", (F.col("n") / total).alias(name))

    both = shares(before, "p").join(shares(after, "q"), ["campo", "doble"], "full_outer")
    p, q = (F.greatest(F.coalesce(c, F.lit(0.0)), F.lit(1e-6)) for c in ("p", "q"))
    return both.groupBy("campo").agg(F.sum((p - q) * F.log(p / q)).alias("deriva"))
