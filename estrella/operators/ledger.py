"""Run ledger: script inventory, execution log, load footprints, rejects and their reports.

The log is append-only: a run leaves a start event and an end event, and its current state is the
latest one. Nothing is updated in place.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from estrella.functions import numbers as num
from estrella.sources.atomic import create_once

# Run ids of shared ledgers: milliseconds since 2020, writer, sequence.
EPOCH_MS, WRITER_BITS, SEQUENCE_BITS = 1_577_836_800_000, 12, 10

EVENT_SCHEMA = (
    "log_id bigint, script_id bigint, evento int, momento timestamp_ntz, resultado string, detalle string, "
    "registros_proc bigint"
)
SCRIPT_SCHEMA = "script_id bigint, script_nombre string, script_desc string, etapa string"


def local_now(zone: str) -> datetime:
    """Wall-clock time of a zone, without the zone."""
    return datetime.now(ZoneInfo(zone)).replace(tzinfo=None)


@dataclass
class Ledger:
    """Collects the few rows a pipeline run writes about itself (not data rows)."""

    spark: SparkSession
    scripts: list[Row] = field(default_factory=list)
    events: list[Row] = field(default_factory=list)
    zone: str = "UTC"
    _runs: int = 0

    def resume(self, scripts: DataFrame, events: DataFrame) -> None:
        """Continue the numbering of an earlier application. One application at a time may write a warehouse."""
        self.scripts = [Row(**r.asDict()) for r in scripts.orderBy("script_id").collect()]
        self._runs = events.agg(F.max("log_id")).first()[0] or 0

    def register(self, name: str, description: str, stage: str) -> int:
        """Script id; registering a name again changes nothing."""
        for row in self.scripts:
            if row.script_nombre == name:
                return row.script_id
        self.scripts.append(
            Row(script_id=len(self.scripts) + 1, script_nombre=name, script_desc=description, etapa=stage)
        )
        return len(self.scripts)

    def _next(self) -> int:
        self._runs += 1
        return self._runs

    @contextmanager
    def run(self, name: str, description: str = "", stage: str = "ingenieria") -> Iterator[Run]:
        script = self.register(name, description, stage)
        current = Run(self._next())
        self._add(current.log_id, script, 0, num.RUNNING, None, None)
        try:
            yield current
        except Exception as error:
            self._add(current.log_id, script, 1, num.ERROR, str(error), None)
            raise
        self._add(current.log_id, script, 1, current.status, current.detail, current.rows)

    def _add(self, log_id, script, event, state, detail, rows) -> None:
        self.events.append(
            Row(log_id=log_id, script_id=script, evento=event, momento=local_now(self.zone), resultado=state, detalle=detail, registros_proc=rows)
        )

    def script_table(self) -> DataFrame:
        return self.spark.createDataFrame(self.scripts, SCRIPT_SCHEMA)

    def event_table(self) -> DataFrame:
        return self.spark.createDataFrame(self.events, EVENT_SCHEMA)


@dataclass
class SharedLedger(Ledger):
    """A ledger below a folder that any number of applications write at once without waiting for each other.

    A script is registered by creating its file, which only the first of its name can; its id is a hash of the name. A run's id
    is made of the time, the writer's number (claimed the same way) and a sequence, so ids of all writers differ and follow the
    time. Events are appended as files of each writer's own by ``publish``.
    """

    root: str = ""

    def __post_init__(self) -> None:
        self.writer = 0
        while not create_once(self.spark, f"{self.root}/writers/{self.writer}", self.spark.sparkContext.applicationId):
            self.writer += 1

    def register(self, name: str, description: str, stage: str) -> int:
        """Script id; registering a name again, by whatever writer, changes nothing."""
        script = int(hashlib.sha256(name.encode()).hexdigest()[:15], 16)
        entry = {"script_id": script, "script_nombre": name, "script_desc": description, "etapa": stage}
        create_once(self.spark, f"{self.root}/scripts/{script:015x}.json", json.dumps(entry))
        return script

    def _next(self) -> int:
        now = (time.time_ns() // 1_000_000 - EPOCH_MS) << (WRITER_BITS + SEQUENCE_BITS)
        mine = (self.writer % (1 << WRITER_BITS)) << SEQUENCE_BITS
        # several runs in one millisecond, or a clock that went back, go on counting
        self._runs = now | mine if now | mine > self._runs else self._runs + 1
        return self._runs

    def publish(self) -> None:
        """Append this writer's events since the last time."""
        if self.events:
            super().event_table().coalesce(1).write.mode("append").parquet(f"{self.root}/events")
            self.events = []

    def script_table(self) -> DataFrame:
        return self.spark.read.schema(SCRIPT_SCHEMA).json(f"{self.root}/scripts")

    def event_table(self) -> DataFrame:
        """The events that all writers published, and this one's own."""
        self.publish()
        return self.spark.read.schema(EVENT_SCHEMA).parquet(f"{self.root}/events")


@dataclass
class Run:
    log_id: int
    status: str = num.OK
    detail: str | None = None
    rows: int | None = None


def fold_runs(events: DataFrame) -> DataFrame:
    """One row per run with its latest state; ``fecha_fin`` is NULL while it is still running."""
    return events.groupBy("log_id").agg(
        F.max_by("script_id", "evento").alias("script_id"),
        F.min("momento").alias("fecha_inicio"),
        F.max(F.when(F.col("evento") > 0, F.col("momento"))).alias("fecha_fin"),
        F.max_by("resultado", "evento").alias("resultado"),
        F.max_by("detalle", "evento").alias("detalle"),
        F.max_by("registros_proc", "evento").alias("registros_proc"),
    )


def latest_run(runs: DataFrame, scripts: DataFrame, name: str) -> DataFrame:
    script = scripts.filter(F.col("script_nombre") == name)
    return runs.join(script, "script_id", "left_semi").agg(F.max("log_id").alias("log_id"))


def run_kpis(runs: DataFrame) -> DataFrame:
    """Runs by state; a state that never occurs is NULL."""
    one = F.lit(1).cast("bigint")
    return runs.agg(
        F.count(F.lit(1)).alias("total_ejecuciones"),
        F.sum(F.when(F.col("resultado") == num.OK, one)).alias("ok"),
        F.sum(F.when(F.col("resultado") == num.WARNING, one)).alias("warnings"),
        F.sum(F.when(F.col("resultado") == num.ERROR, one)).alias("errores"),
        F.sum("registros_proc").alias("total_registros_proc"),
    )


def run_history(runs: DataFrame, scripts: DataFrame) -> DataFrame:
    joined = runs.join(scripts, "script_id").orderBy("log_id")
    return joined.select("log_id", "script_nombre", "etapa", "fecha_inicio", "fecha_fin", "resultado", "registros_proc", "detalle")


def loads_by_target(loads: DataFrame) -> DataFrame:
    sums = loads.groupBy("tabla_destino").agg(
        F.sum("registros_insertados").alias("insertados"),
        F.sum("registros_rechazados").alias("rechazados"),
        F.sum("registros_leidos").alias("leidos"),
    )
    return sums.orderBy(F.desc("insertados"), "tabla_destino")


def controls_by_table(results: DataFrame) -> DataFrame:
    return (
        results.groupBy("tabla")
        .agg(
            F.count_if(F.col("resultado") == num.OK).alias("ok"),
            F.count_if(F.col("resultado") == num.ERROR).alias("errores"),
        )
        .orderBy("tabla")
    )


def controls_long(results: DataFrame) -> DataFrame:
    """One row per table and state, for charting."""
    return controls_by_table(results).unpivot("tabla", ["ok", "errores"], "estado", "controles")


def reject_report(rejects: DataFrame, runs: DataFrame, scripts: DataFrame) -> DataFrame:
    named = rejects.join(runs.select("log_id", "script_id"), "log_id", "left").join(
        scripts.select("script_id", "script_nombre"), "script_id", "left"
    )
    return named.select("script_nombre", "tabla_origen", "clave_registro", "motivo_rechazo", "decision")


def inventory_report(scripts: DataFrame, runs: DataFrame) -> DataFrame:
    """Per script: times run, last end and last state."""
    per_script = runs.groupBy("script_id").agg(
        F.count("log_id").alias("veces"),
        F.max("fecha_fin").alias("ultima_ejecucion"),
        F.max_by("resultado", "log_id").alias("ultimo_resultado"),
    )
    joined = scripts.join(per_script, "script_id", "left")
    return joined.select(
        "script_id",
        "script_nombre",
        "etapa",
        "script_desc",
        F.coalesce("veces", F.lit(0)).alias("veces_ejecutado"),
        "ultima_ejecucion",
        "ultimo_resultado",
    ).orderBy("script_id")


def run_summary(loads: DataFrame, log_id: int | Column) -> DataFrame:
    """Footprints of one run in load order."""
    return loads.filter(F.col("log_id") == log_id).drop("log_id")
