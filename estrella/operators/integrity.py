"""Referential checks that count foreign keys before joining, and row-level rejects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrella.functions import numbers as num
from estrella.session import materialize

@dataclass(frozen=True)
class ForeignKey:
    """``child.column`` must appear in ``parent.parent_key`` (or in one of ``also``)."""

    table: str
    child: DataFrame
    column: str
    parent: DataFrame
    parent_key: str
    key: str | None = None
    also: tuple[tuple[DataFrame, str], ...] = ()
    counted: DataFrame | None = None

    def known(self) -> DataFrame:
        names = [(self.parent, self.parent_key), *self.also]
        return reduce(DataFrame.unionByName, [df.select(F.col(c).alias(self.column)) for df, c in names])

    def value_counts(self) -> DataFrame:
        """Distinct foreign keys with their rows; a frequent key is one row from here on."""
        if self.counted is not None:
            return self.counted
        return self.child.groupBy(self.column).agg(F.count(F.lit(1)).alias("n"))

    def missing(self) -> DataFrame:
        return self.value_counts().join(self.known(), self.column, "left_anti")

    def orphans(self) -> DataFrame:
        """Every child row without a parent (NULL keys are not orphans).

        The distinct keys meet the parent first; the child is only searched for those missing.
        """
        gone = self.missing().filter(F.col(self.column).isNotNull()).select(self.column)
        return self.child.join(gone, self.column, "left_semi")


def count_together(checks: Mapping[str, ForeignKey]) -> dict[str, ForeignKey]:
    """The same checks with the keys of each child table counted in one pass over it.

    The counts of a child, one row per (check, key), are written and serve every later use.
    """
    children: dict[int, list[str]] = {}
    for name, check in checks.items():
        children.setdefault(id(check.child), []).append(name)
    out = {}
    for names in children.values():
        child = checks[names[0]].child
        columns = list(dict.fromkeys(checks[n].column for n in names))
        cells = [F.struct(F.lit(c).alias("campo"), F.col(c).cast("string").alias("valor")) for c in columns]
        counts = materialize(child.select(F.inline(F.array(*cells))).groupBy("campo", "valor").agg(F.count(F.lit(1)).alias("n")))
        for name in names:
            column = checks[name].column
            value = F.col("valor").cast(child.schema[column].dataType).alias(column)
            out[name] = replace(checks[name], counted=counts.filter(F.col("campo") == column).select(value, "n"))
    return {name: out[name] for name in checks}


def check_foreign_keys(checks: Sequence[ForeignKey], control: str = "INTEGRIDAD_REFERENCIAL") -> DataFrame:
    """One row per check with the number of orphan rows; the rows themselves are those of ``reject_orphans``."""
    return reduce(DataFrame.unionByName, [_check_one(c, control) for c in checks])


def _check_one(fk: ForeignKey, control: str) -> DataFrame:
    missing = fk.missing().filter(F.col(fk.column).isNotNull())
    counted = missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("cant_errores"))
    bad = F.concat(F.col("cant_errores").cast("string"), F.lit(f" registros con {fk.column} inválido"))
    return counted.select(
        F.lit(fk.table).alias("tabla"),
        F.lit(fk.column).alias("campo"),
        F.lit(control).alias("control"),
        F.when(F.col("cant_errores") == 0, num.OK).otherwise(num.ERROR).alias("resultado"),
        F.col("cant_errores").cast("bigint").alias("cant_errores"),
        F.when(F.col("cant_errores") == 0, F.lit(f"Todos los {fk.column} existen")).otherwise(bad).alias("detalle"),
    )


def reject_orphans(fk: ForeignKey, reason: str, decision: str = num.REJECTED_PARTIAL) -> DataFrame:
    """One reject row per orphan, naming the missing key."""
    return fk.orphans().select(
        F.lit(fk.table).alias("tabla_origen"),
        F.col(fk.key).cast("string").alias("clave_registro"),
        F.concat(F.lit(reason), F.col(fk.column).cast("string")).alias("motivo_rechazo"),
        F.lit(decision).alias("decision"),
    )
