"""Grouped figures kept up to date by the changes of a batch instead of a new pass over the fact.

A change is a signed row: +1 for a row that comes, -1 for one that goes. Sums follow directly. Distinct counts can also
go down, so a log keeps how often each (group, value) was added and removed: a value stops counting when its
rows cancel out. The same logs give the smallest and largest value of a group after one of them left.

Logs are only appended to, dealt into folders by the hash of the group; of the figures, the folders with touched groups are
replaced. A batch reads the folders of its groups and, for distinct counts, shuffles only the pairs that it touches.
All tables of a state change in one published version.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrella.session import materialize
from estrella.sources.snapshots import Change, Snapshot

SIGN = "_signo"
ROWS = "filas"
_BUCKET = "_b"


@dataclass(frozen=True)
class Figures:
    """What is kept per group: row count, sums (name to column), distinct counts (name to column), and the smallest
    and largest value of columns (column to two names). NULLs are not counted and not summed; NULL is a group."""

    name: str
    by: tuple[str, ...]
    sums: Mapping[str, str] = field(default_factory=dict)
    distinct: Mapping[str, str] = field(default_factory=dict)
    ends: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    buckets: int = 16

    @property
    def logged(self) -> list[str]:
        return sorted({*self.distinct.values(), *self.ends})

    def log(self, column: str) -> str:
        return f"{self.name}__{column}"

    def columns(self) -> list[str]:
        return [*self.by, ROWS, *self.sums, *self.distinct, *[n for names in self.ends.values() for n in names]]


def signed(rows: DataFrame, sign: int) -> DataFrame:
    return rows.withColumn(SIGN, F.lit(sign).cast("long"))


def upsert_changes(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """The signed rows of an upsert: target rows whose key the source has go, the source's come.

    ``source`` has one row per key and should be a stored table.
    """
    same = list(key)
    gone = target.join(source.select(*same), same, "left_semi")
    return signed(gone, -1).unionByName(signed(source.select(*target.columns), 1))


def start(change: Change, figures: Figures, rows: DataFrame) -> None:
    """The state of a first set of rows; replaces one of that name."""
    _prepared(change, figures, signed(rows, 1), fresh=True)


def apply(change: Change, figures: Figures, changes: DataFrame) -> int:
    """Bring a state up to date with signed rows. Returns the number of touched groups.

    Changes that take away more than there is raise ``ValueError``. No changes change nothing.
    """
    # every figure reads the changes, which mostly come from a join
    needed = dict.fromkeys([*figures.by, *figures.sums.values(), *figures.logged, SIGN])
    return _prepared(change, figures, materialize(changes.select(*needed)), fresh=False)


def read(snapshot: Snapshot, figures: Figures) -> DataFrame:
    """The figures of all groups that have rows."""
    return snapshot.read(figures.name).select(*figures.columns())


def compact(change: Change, figures: Figures) -> None:
    """Rewrite the logs without the pairs that cancelled out; the figures stay."""
    for column in figures.logged:
        log = change.now.read(figures.log(column))
        change.replace(figures.log(column), _net(log, figures, column).withColumn(_BUCKET, _bucket(figures)), [_BUCKET])


def _bucket(figures: Figures) -> Column:
    return F.pmod(F.xxhash64(*figures.by), F.lit(figures.buckets)).cast("int")


def _net(rows: DataFrame, figures: Figures, column: str) -> DataFrame:
    return rows.groupBy(*figures.by, column).agg(F.sum("n").alias("n")).filter("n <> 0")


def _prepared(change: Change, figures: Figures, changes: DataFrame, fresh: bool) -> int:
    by = list(figures.by)
    # sums have the type that a sum of the column has, not the wider one of its product with the sign
    types = dict(changes.agg(*[F.sum(c).alias(name) for name, c in figures.sums.items()], F.count(F.lit(1)).alias(ROWS)).dtypes)
    moved = changes.groupBy(*by).agg(
        F.sum(SIGN).alias(ROWS), *[F.sum(F.col(c) * F.col(SIGN)).cast(types[name]).alias(name) for name, c in figures.sums.items()]
    )
    moved = materialize(moved.withColumn(_BUCKET, _bucket(figures)))
    pairs = {
        c: materialize(
            changes.filter(F.col(c).isNotNull()).groupBy(*by, c).agg(F.sum(SIGN).alias("n")).filter("n <> 0").withColumn(_BUCKET, _bucket(figures))
        )
        for c in figures.logged
    }
    # one number per folder at most
    touched = {str(r[0]) for r in moved.select(_BUCKET).distinct().collect()}
    if not touched and not fresh:
        return 0
    inside = [(v,) for v in touched]

    parts = [moved.select(*by, ROWS, *figures.sums)]
    if not fresh:
        old = materialize(change.now.read(figures.name, lambda v: v[0] in touched))
        mine = _semi(old, moved, by)
        parts.append(mine.select(*by, ROWS, *figures.sums, *figures.distinct))
    for name, column in figures.distinct.items():
        parts.append(_gained(change, figures, column, pairs[column], touched, fresh).withColumnRenamed("gained", name))
    for column, names in figures.ends.items():
        parts.append(_ends(change, figures, column, pairs[column], moved, touched, fresh, names))
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    ends = [n for names in figures.ends.values() for n in names]
    added = [ROWS, *figures.sums, *figures.distinct]
    made = whole.groupBy(*by).agg(
        *[F.sum(c).cast(types.get(c, "long")).alias(c) for c in added], *[F.max(c).alias(c) for c in ends]
    )
    made = materialize(made.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in figures.distinct}).withColumn(_BUCKET, _bucket(figures)))
    wrong = made.filter((F.col(ROWS) < 0) | reduce(lambda a, b: a | b, [F.col(c) < 0 for c in figures.distinct], F.lit(False)))
    if not wrong.isEmpty():
        raise ValueError(f"{figures.name}: changes take away rows that were never added")
    made = made.filter(F.col(ROWS) > 0)
    for column, log in pairs.items():
        (change.replace if fresh else change.append)(figures.log(column), log, [_BUCKET])
    if fresh:
        change.replace(figures.name, made, [_BUCKET])
    else:
        untouched = _semi(old, moved, by, "left_anti")
        change.replace_folders(figures.name, inside, made.unionByName(untouched.select(*made.columns)))
    return moved.count()


def _semi(rows: DataFrame, keys: DataFrame, columns: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Semi or anti join in which NULL equals NULL."""
    asked = keys.select(*[F.col(c).alias(f"_k_{c}") for c in columns])
    return rows.join(asked, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in columns]), how)


def _gained(change: Change, figures: Figures, column: str, pairs: DataFrame, touched: set[str], fresh: bool) -> DataFrame:
    """By how much the number of distinct values of each group changes."""
    by = list(figures.by)
    both = pairs.select(*by, column, F.col("n").alias("more"), F.lit(0).cast("long").alias("n"))
    if not fresh:
        log = change.now.read(figures.log(column), lambda v: v[0] in touched)
        before = _semi(log, pairs, [*by, column]).select(*by, column, F.lit(0).cast("long").alias("more"), "n")
        both = both.unionByName(before)
    counted = both.groupBy(*by, column).agg(F.sum("n").alias("before"), F.sum("more").alias("more"))
    now = (F.col("before") + F.col("more") > 0).cast("int") - (F.col("before") > 0).cast("int")
    return counted.groupBy(*by).agg(F.sum(now).alias("gained"))


def _ends(
    change: Change, figures: Figures, column: str, pairs: DataFrame, moved: DataFrame, touched: set[str], fresh: bool, names: tuple[str, str]
) -> DataFrame:
    """Smallest and largest value of the touched groups after the change, from their log."""
    rows = pairs
    if not fresh:
        log = change.now.read(figures.log(column), lambda v: v[0] in touched)
        rows = _semi(log, moved, list(figures.by)).unionByName(pairs)
    left = _net(rows, figures, column)
    return left.groupBy(*figures.by).agg(F.min(column).alias(names[0]), F.max(column).alias(names[1]))
