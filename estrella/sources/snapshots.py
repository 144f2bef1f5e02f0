"""Tables in versions: several tables change together or not at all, and readers keep the version they opened.

Below the root folder, ``data`` holds immutable folders of Parquet files and ``manifests`` one small JSON file per
version that lists the folders of every table. A writer puts its new folders aside and then publishes the next manifest under
a name that must not exist yet, so of two writers one wins and the other starts again from the winner's version. A
job that stops before that leaves folders that no manifest names; ``vacuum`` removes them.

An upsert replaces either whole folders (``Change.upsert``) or no file at all (``Change.merge``): then the positions of the
rows that went are kept as bitmaps per file, readers leave them out, and ``Change.compact`` rewrites what has holes.

A manifest grows with the number of folders (about 150 bytes each), not with the rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from estrella.operators.ranking import first_per_key
from estrella.operators.upsert import upsert
from estrella.session import CODEC, materialize
from estrella.sources.atomic import create_once

_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# name of a folder's level for the partition column of some place; the columns themselves stay in the files
_LEVEL = "_p{}"
# a word of a bitmap holds 2 ** 6 positions
_WORD = 6

Values = tuple[str | None, ...]


class Conflict(Exception):
    """Another writer published the version this one wanted to publish."""


@dataclass(frozen=True)
class Table:
    """The folders of one table in one version, by the text of their partition values."""

    schema: str
    partition: tuple[str, ...] = ()
    folders: Mapping[Values, tuple[str, ...]] = field(default_factory=dict)
    # folders of bitmaps of rows that went, and the folders that these rows are in
    gone: tuple[str, ...] = ()
    holed: frozenset[str] = frozenset()

    def paths(self) -> list[str]:
        return [p for some in self.folders.values() for p in some]

    def columns(self) -> list[str]:
        return StructType.fromJson(json.loads(self.schema)).names


@dataclass(frozen=True)
class Snapshot:
    """One version of all tables. Reading from it gives the same rows whatever is published later."""

    spark: SparkSession
    number: int
    tables: Mapping[str, Table]

    def read(self, name: str, only: Callable[[Values], bool] = lambda values: True) -> DataFrame:
        """A table, or of a partitioned one the folders whose values (as text, None for NULL) ``only`` accepts."""
        table = self.tables[name]
        return _read(self.spark, table, [p for values, some in table.folders.items() if only(values) for p in some])

    def __contains__(self, name: str) -> bool:
        return name in self.tables


def _read(spark: SparkSession, table: Table, paths: Sequence[str]) -> DataFrame:
    """The rows of some folders of a table."""
    columns = table.columns()
    whole, holed = [p for p in paths if p not in table.holed], [p for p in paths if p in table.holed]
    rows = _scan(spark, table, whole) if whole or not holed else None
    if not holed:
        return rows
    left = _placed(spark, table, holed).select(*columns)
    return left if rows is None else rows.unionByName(left)


def _scan(spark: SparkSession, table: Table, paths: Sequence[str]) -> DataFrame:
    schema = StructType.fromJson(json.loads(table.schema))
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _placed(spark: SparkSession, table: Table, paths: Sequence[str]) -> DataFrame:
    """The rows of some folders with their folder ``_folder``, file ``_file`` and position ``_at``, without those that went."""
    if not paths:
        place = {"_folder": F.lit(""), "_file": F.lit(""), "_at": F.lit(0).cast("long")}
        return _scan(spark, table, paths).withColumns(place)
    place = _of_file(table, F.col("_metadata.file_path"))
    rows = _scan(spark, table, paths).select(*table.columns(), *place, F.col("_metadata.row_index").alias("_at"))
    if not table.holed.intersection(paths):
        return rows
    went = spark.read.parquet(*table.gone).groupBy("_file", "_word").agg(F.bit_or("_bits").alias("_bits"))
    met = rows.withColumn("_word", F.shiftright("_at", _WORD)).join(went, ["_file", "_word"], "left")
    return met.filter(F.col("_bits").isNull() | (F.getbit("_bits", _place()) == 0)).drop("_word", "_bits")


def _of_file(table: Table, path: Column) -> list[Column]:
    """Folder and name of a file from its path."""
    return [
        F.regexp_replace(path, "/[^/]*$", "").alias("_folder"),
        # write, partition folders and file: unique, however the root is spelled
        F.substring_index(path, "/", -(2 + len(table.partition))).alias("_file"),
    ]


def _files(spark: SparkSession, table: Table) -> DataFrame:
    """Folder and name of the files of a table, one row each."""
    if not table.paths():
        return _placed(spark, table, []).select("_folder", "_file")
    paths = _scan(spark, table, table.paths()).select(F.col("_metadata.file_path").alias("_path")).distinct()
    return paths.select(*_of_file(table, F.col("_path")))


def _located(spark: SparkSession, table: Table) -> DataFrame:
    """All rows with their places; only folders with holes meet the bitmaps."""
    holed = [p for p in table.paths() if p in table.holed]
    rows = _placed(spark, table, [p for p in table.paths() if p not in table.holed])
    return rows.unionByName(_placed(spark, table, holed)) if holed else rows


def _place():
    return F.col("_at").bitwiseAND((1 << _WORD) - 1).cast("int")


class Snapshots:
    """The versions below a root folder that all executors and all writers reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._java = spark.sparkContext._jvm
        self._hadoop = self._java.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._hadoop.Path(self.root).getFileSystem(self._conf)

    def numbers(self) -> list[int]:
        folder = self._hadoop.Path(f"{self.root}/manifests")
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def open(self, number: int | None = None) -> Snapshot:
        """The newest version or a given one; version 0 has no tables."""
        if number is None:
            number = max(self.numbers(), default=0)
        if number == 0:
            return Snapshot(self.spark, 0, {})
        stream = self._fs.open(self._hadoop.Path(self._manifest(number)))
        try:
            held = json.loads(self._java.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        tables = {
            name: Table(
                t["schema"],
                tuple(t["partition"]),
                {tuple(v): tuple(some) for v, some in t["folders"]},
                tuple(t["gone"]),
                frozenset(t["holed"]),
            )
            for name, t in held["tables"].items()
        }
        return Snapshot(self.spark, number, tables)

    def begin(self) -> Change:
        """A change on top of the newest version."""
        return Change(self, self.open())

    def update(self, work: Callable[[Change], None], attempts: int = 5) -> int:
        """Run ``work`` on a change and publish it, again from the newest version if another writer was first."""
        for _ in range(attempts - 1):
            change = self.begin()
            work(change)
            try:
                return change.publish()
            except Conflict:
                continue
        change = self.begin()
        work(change)
        return change.publish()

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete all but the newest ``keep`` manifests and the folders that none of these names.

        No writer may be at work, and no reader of an older version. Returns the folders deleted.
        """
        numbers = self.numbers()
        kept = {p for n in numbers[-keep:] for t in self.open(n).tables.values() for p in (*t.paths(), *t.gone)}
        for number in numbers[:-keep]:
            self._fs.delete(self._hadoop.Path(self._manifest(number)), False)
        gone = []
        for folder in self._under(self._hadoop.Path(f"{self.root}/data")):
            path = folder.toString()
            if not any(p == path or p.startswith(f"{path}/") for p in kept):
                self._fs.delete(folder, True)
                gone.append(path)
        return gone

    def _under(self, folder) -> list:
        """Folders of single writes: data/<table>/<write>."""
        if not self._fs.exists(folder):
            return []
        return [w.getPath() for t in self._fs.listStatus(folder) for w in self._fs.listStatus(t.getPath())]

    def _manifest(self, number: int) -> str:
        return f"{self.root}/manifests/{number:012d}.json"

    def _publish(self, snapshot: Snapshot) -> None:
        """One rename onto a name that must be free makes the version visible."""
        tables = {
            name: {
                "schema": t.schema,
                "partition": t.partition,
                "folders": [[v, some] for v, some in t.folders.items()],
                "gone": t.gone,
                "holed": sorted(t.holed),
            }
            for name, t in snapshot.tables.items()
        }
        text = json.dumps({"number": snapshot.number, "tables": tables})
        if not create_once(self.spark, self._manifest(snapshot.number), text):
            raise Conflict(f"version {snapshot.number} exists")

    def _write(self, name: str, df: DataFrame, partition: Sequence[str]) -> dict[Values, str]:
        """Write rows to a new folder; the folders with files by their partition values."""
        path = f"{self.root}/data/{name}/{uuid.uuid4().hex}"
        levels = [_LEVEL.format(i) for i in range(len(partition))]
        dealt = df.withColumns({level: F.col(c).cast("string") for level, c in zip(levels, partition, strict=True)}) if levels else df
        dealt.write.option("compression", CODEC).partitionBy(*levels).parquet(path)
        if not levels:
            return {(): path}
        # the last levels that hold files: an empty frame has none
        found = self._fs.globStatus(self._hadoop.Path("/".join([path, *["*=*"] * len(levels)]))) or []
        return {_values(s.getPath().toString(), levels): s.getPath().toString() for s in found}


def _values(path: str, levels: Sequence[str]) -> Values:
    parts = [p.partition("=")[2] for p in path.split("/")[-len(levels) :]]
    return tuple(None if p == _NULL_PARTITION else unquote(p) for p in parts)


class Change:
    """New contents for some tables, visible only once published, and then all together."""

    def __init__(self, store: Snapshots, base: Snapshot):
        self.store, self.base = store, base
        self.tables = dict(base.tables)

    @property
    def now(self) -> Snapshot:
        """The base with the changes made so far, for reads of the same job."""
        return replace(self.base, tables=dict(self.tables))

    def publish(self) -> int:
        """Make the changes the next version; ``Conflict`` if the base is not the newest one any more."""
        number = self.base.number + 1
        self.store._publish(Snapshot(self.base.spark, number, self.tables))
        return number

    def replace(self, name: str, df: DataFrame, partition: Sequence[str] = ()) -> None:
        """The rows become the whole table."""
        made = self.store._write(name, df, partition)
        self.tables[name] = Table(df.schema.json(), tuple(partition), {v: (p,) for v, p in made.items()})

    def append(self, name: str, df: DataFrame, partition: Sequence[str] = ()) -> None:
        """Add rows; the table is created if it is not there. Its partition columns stay as they are."""
        if name not in self.tables:
            return self.replace(name, df, partition)
        table = self.tables[name]
        made = self.store._write(name, df.select(*table.columns()), table.partition)
        self.tables[name] = replace(table, folders=_added(table.folders, made))

    def drop(self, name: str) -> None:
        self.tables.pop(name, None)

    def replace_folders(self, name: str, gone: Sequence[Values], df: DataFrame) -> None:
        """The folders of some partition values are left out, and the rows are added in folders of their own."""
        table = self.tables[name]
        left = set(gone)
        made = self.store._write(name, df.select(*table.columns()), table.partition)
        kept = {v: some for v, some in table.folders.items() if v not in left}
        held = {p for some in kept.values() for p in some}
        self.tables[name] = _tidy(replace(table, folders=_added(kept, made), holed=table.holed & held))

    def upsert(
        self, name: str, source: DataFrame, key: Sequence[str], columns: Sequence[str], order: Sequence[str] | None = None
    ) -> int:
        """Upsert into a table; only the folders that hold a key of the source or get a row of it are replaced.

        The partition columns are overwritten like ``columns``, so rows may move. ``order`` picks the first of several
        source rows with one key. Returns the number of partitions replaced; the others are neither read in full nor
        written. The touched folders are found from the files that hold the keys.
        """
        table = self.tables[name]
        if order is not None:
            source = first_per_key(source, key, order)
        source = materialize(source)
        homes = _located(self.base.spark, table).select(*key, "_folder").join(source.select(*key), list(key), "left_semi")
        # one row per folder of the table at most
        held = {_plain(r[0]) for r in homes.select("_folder").distinct().collect()}
        values = source.select(*[F.col(p).cast("string") for p in table.partition]).distinct().collect() if table.partition else [()]
        wanted = {tuple(r) for r in values}
        touched = [v for v, some in table.folders.items() if v in wanted or any(_plain(p) in held for p in some)]
        inside = set(touched)
        affected = self.now.read(name, lambda v: v in inside)
        self.replace_folders(name, touched, upsert(affected, source, key, [*columns, *table.partition]))
        return len(inside | wanted)


    def merge(
        self, name: str, source: DataFrame, key: Sequence[str], columns: Sequence[str], order: Sequence[str] | None = None
    ) -> None:
        """The upsert without rewriting a file: the rows that change are marked as gone and come again in new folders.

        Arguments and results as for ``upsert``. The table's keys are read to find the rows of the batch, and meet it
        with a number for their file. Only rows that keep some of their values are read in full.
        """
        spark, table = self.base.spark, self.tables[name]
        if order is not None:
            source = first_per_key(source, key, order)
        rows = _located(spark, table)
        written = {*columns, *table.partition}
        whole = all(c in source.columns and (c in written or c in key) for c in table.columns())
        if whole:
            # nothing of a matched row survives: the batch itself is what comes, and is stored where it stays
            self.append(name, rows.select(*table.columns()).filter(F.lit(False)).unionByName(source.select(*table.columns())))
            source = _scan(spark, table, [p for p in self.tables[name].paths() if p not in set(table.paths())])
        else:
            source = materialize(source)
        # one row per file of the table
        files = materialize(_files(spark, table).withColumn("_no", F.monotonically_increasing_id()))
        placed = rows.select(*key, "_file", "_at").join(F.broadcast(files.select("_file", "_no")), "_file")
        hit = placed.select(*key, "_no", "_at").join(source.select(*key), list(key), "left_semi")
        bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), _place())).alias("_bits")
        marks = materialize(hit.groupBy("_no", F.shiftright("_at", _WORD).alias("_word")).agg(bits).join(F.broadcast(files), "_no"))
        if not whole:
            met = rows.withColumn("_word", F.shiftright("_at", _WORD)).join(marks.select("_file", "_word", "_bits"), ["_file", "_word"])
            old = met.filter(F.getbit("_bits", _place()) == 1).select(*table.columns())
            self.append(name, upsert(old, source, key, [*columns, *table.partition]))
        # one row per folder of the table at most
        folders = {_plain(r[0]) for r in marks.select("_folder").distinct().collect()}
        if folders:
            path = f"{self.store.root}/data/{name}/{uuid.uuid4().hex}"
            marks.select("_file", "_word", "_bits").write.option("compression", CODEC).parquet(path)
            now = frozenset(p for p in table.paths() if _plain(p) in folders)
            self.tables[name] = replace(self.tables[name], gone=(*table.gone, path), holed=table.holed | now)

    def compact(self, name: str) -> int:
        """Rewrite the folders that rows went from, those of a partition as one. Returns the number of partitions rewritten."""
        table = self.tables[name]
        holed = [v for v, some in table.folders.items() if table.holed.intersection(some)]
        if holed:
            inside = set(holed)
            self.replace_folders(name, holed, self.now.read(name, lambda v: v in inside))
        return len(holed)


def _tidy(table: Table) -> Table:
    """Without bitmaps once no folder has holes."""
    return table if table.holed else replace(table, gone=())


def _plain(path: str) -> str:
    """A path without its scheme and escapes, as listings and file metadata write them differently."""
    return unquote(unquote(path.partition(":")[2] or path)).lstrip("/")


def _added(folders: Mapping[Values, tuple[str, ...]], made: Mapping[Values, str]) -> dict[Values, tuple[str, ...]]:
    out = dict(folders)
    for values, path in made.items():
        out[values] = (*out.get(values, ()), path)
    return out
