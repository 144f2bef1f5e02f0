"""Field rules over raw text tables, compiled so that one pass answers all row rules of a table.

Every rule yields one row ``(tabla, campo, control, resultado, cant_errores, detalle)``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estrella.functions import numbers as num
from estrella.functions import text as txt

RESULT_COLUMNS = ["tabla", "campo", "control", "resultado", "cant_errores", "detalle"]


@dataclass(frozen=True)
class Rule:
    """One control on one field. ``fails`` marks bad rows; ``unique`` counts repeated keys."""

    field: str
    control: str
    fails: Callable[[], Column] | None = None
    unique: tuple[str, ...] = ()
    severity: str = num.ERROR
    good: str = "Sin errores"
    bad: str = "Hay registros que no cumplen el control"
    informative: bool = field(default=False)


def _text(column: str, trimmed: bool) -> Column:
    return F.trim(F.col(column)) if trimmed else F.col(column)


def not_null(column: str, control: str = "NOT NULL") -> Rule:
    return Rule(column, control, lambda: txt.is_blank(F.col(column)), good="Sin nulos", bad="Hay registros nulos")


def required(column: str, control: str) -> Rule:
    return Rule(column, control, lambda: txt.is_blank_trimmed(F.col(column)), bad="El campo es obligatorio")


def unique(columns: Sequence[str], control: str, joiner: str = "+") -> Rule:
    return Rule(joiner.join(columns), control, unique=tuple(columns), good="Sin duplicados", bad="Hay claves duplicadas")


def primary_key(column: str, control: str = "NOT NULL + SIN_DUPLICADOS") -> Rule:
    """Blank rows plus repeated keys."""
    return Rule(column, control, lambda: txt.is_blank(F.col(column)), unique=(column,), good="PK válida", bad="PK inválida")


def castable_int(column: str, control: str = "CASTEABLE_A_ENTERO", null_word: bool = False) -> Rule:
    def fails() -> Column:
        bad = ~F.trim(F.col(column)).rlike(txt.INTEGER_TEXT)
        return bad & (F.col(column) != txt.NULL_WORD) if null_word else bad

    return Rule(column, control, fails, bad="Hay valores no enteros")


def int_or_null(column: str, control: str = "ES_ENTERO_O_NULL") -> Rule:
    return castable_int(column, control, null_word=True)


def length_is(column: str, size: int, control: str, needed: bool = False) -> Rule:
    """Exact length. ``needed`` trims and also fails blanks; otherwise NULL passes."""

    def fails() -> Column:
        if needed:
            return txt.is_blank_trimmed(F.col(column)) | (F.length(F.trim(F.col(column))) != size)
        return F.length(F.col(column)) != size

    return Rule(column, control, fails, bad=f"Hay valores con longitud distinta de {size}")


def forbidden(column: str, value: str, control: str = "VALOR_INCONSISTENTE", severity: str = num.WARNING) -> Rule:
    return Rule(column, control, lambda: F.col(column) == value, severity=severity, bad=f"Hay registros con valor {value}")


def date_prefix(column: str, control: str = "FORMATO_FECHA", needed: bool = False) -> Rule:
    """Starts like a date. ``needed`` also fails blanks; otherwise NULL and the null word pass."""

    def fails() -> Column:
        if needed:
            return txt.is_blank_trimmed(F.col(column)) | ~F.trim(F.col(column)).rlike(txt.DATE_PREFIX)
        return (F.col(column) != txt.NULL_WORD) & ~F.col(column).rlike(txt.DATE_PREFIX)

    return Rule(column, control, fails, bad="Hay fechas inválidas")


def in_set(column: str, values: Sequence[str], control: str, trimmed: bool = False) -> Rule:
    return Rule(
        column,
        control,
        lambda: ~_text(column, trimmed).isin(list(values)),
        bad="Valores inválidos",
    )


def numeric(column: str, control: str = "ES_NUMERICO") -> Rule:
    return Rule(column, control, lambda: ~F.col(column).rlike(txt.NUMERIC_TEXT), bad="Hay valores no numéricos")


def numeric_between(
    column: str,
    low: float,
    high: float | None,
    control: str,
    severity: str = num.ERROR,
    trimmed: bool = False,
) -> Rule:
    def fails() -> Column:
        value = _text(column, trimmed)
        number = value.try_cast("decimal(38,10)")
        outside = (number < low) if high is None else ~number.between(low, high)
        # well-formed text without a sign that is too long for the type lies above every limit
        too_long = F.lit(False) if high is None else number.isNull() & value.isNotNull()
        return ~value.rlike(txt.NUMERIC_TEXT) | F.coalesce(outside, too_long)

    return Rule(column, control, fails, severity=severity, bad="Hay valores fuera de rango")


def int_between(column: str, low: int, high: int | None, control: str, trimmed: bool = False) -> Rule:
    def fails() -> Column:
        value = _text(column, trimmed)
        number = value.try_cast("bigint")
        outside = (number < low) if high is None else ~number.between(low, high)
        return ~value.rlike(txt.INTEGER_TEXT) | outside | (value.rlike(txt.INTEGER_TEXT) & number.isNull())

    return Rule(column, control, fails, bad="Hay enteros fuera de rango")


def numeric_key(columns: Sequence[str], control: str, joiner: str = "/") -> Rule:
    """Key made of digits. A single key also fails when blank; in a composite key NULL passes."""

    def fails() -> Column:
        tests = [~F.trim(F.col(c)).rlike(txt.INTEGER_TEXT) for c in columns]
        if len(columns) == 1:
            tests.append(txt.is_blank_trimmed(F.col(columns[0])))
        return reduce(lambda a, b: a | b, tests)

    return Rule(joiner.join(columns), control, fails, bad="La clave debe ser numérica")


def expected_nulls(column: str, control: str = "NULOS_ESPERADOS") -> Rule:
    """Counts nulls for information; never fails."""
    return Rule(
        column,
        control,
        lambda: F.col(column).isNull() | (F.col(column) == txt.NULL_WORD),
        good="Nulos esperados",
        bad="Nulos esperados. Cantidad",
        informative=True,
    )


def _repeated(df: DataFrame, rule: Rule) -> DataFrame:
    return df.groupBy(*rule.unique).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def check(table: str, df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Evaluate all rules of one table."""
    counters = [
        (F.count_if(r.fails()) if r.fails else F.lit(0).cast("bigint")).alias(f"c{i}") for i, r in enumerate(rules)
    ]
    if any(r.fails for r in rules):
        wide = df.agg(F.count(F.lit(1)).alias("_rows"), *counters)
        cells = [F.struct(F.lit(i).alias("i"), F.col(f"c{i}").alias("n")) for i in range(len(rules))]
        counted = wide.select(F.inline(F.array(*cells)))
    else:
        counted = None
    pieces = [] if counted is None else [counted]
    for i, rule in enumerate(rules):
        if rule.unique:
            pieces.append(_repeated(df, rule).agg(F.lit(i).alias("i"), F.count(F.lit(1)).alias("n")))
    counts = reduce(DataFrame.unionByName, pieces).groupBy("i").agg(F.sum("n").alias("cant_errores"))

    spec = F.array(
        *[
            F.struct(
                F.lit(r.field).alias("campo"),
                F.lit(r.control).alias("control"),
                F.lit(num.OK if r.informative else r.severity).alias("grado"),
                F.lit(r.good).alias("bien"),
                F.lit(r.bad).alias("mal"),
                F.lit(r.informative).alias("informa"),
            )
            for r in rules
        ]
    )
    described = counts.withColumn("r", spec[F.col("i")])
    # always a count: the keys and values are the rows of ``offenders``
    bad_text = F.concat("r.mal", F.lit(": "), F.col("cant_errores").cast("string"))
    return described.select(
        F.lit(table).alias("tabla"),
        F.col("r.campo").alias("campo"),
        F.col("r.control").alias("control"),
        F.when(F.col("cant_errores") == 0, num.OK).otherwise(F.col("r.grado")).alias("resultado"),
        F.col("cant_errores").cast("bigint").alias("cant_errores"),
        F.when(F.col("cant_errores") == 0, F.col("r.bien")).otherwise(bad_text).alias("detalle"),
    )


def check_all(tables: Sequence[tuple[str, DataFrame, Sequence[Rule]]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [check(name, df, rules) for name, df, rules in tables])


def listing(results: DataFrame) -> DataFrame:
    """By table, field and control, with the place in that order as a column."""
    place = F.row_number().over(Window.orderBy("tabla", "campo", "control"))
    return results.withColumn("orden", place).orderBy("orden")


def offenders(table: str, df: DataFrame, key: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """Every bad row of every row rule with its key and the field's value, one output row per (key, rule)."""
    tests = [
        F.when(
            r.fails(),
            F.struct(
                F.lit(r.field).alias("campo"),
                F.lit(r.control).alias("control"),
                (F.col(r.field).cast("string") if r.field in df.columns else F.lit(None).cast("string")).alias("valor"),
            ),
        )
        for r in rules
        if r.fails and not r.informative
    ]
    key_text = F.concat_ws("/", *[F.col(k).cast("string") for k in key])
    hits = df.select(key_text.alias("clave_registro"), F.explode(F.array_compact(F.array(*tests))).alias("r"))
    return hits.select(F.lit(table).alias("tabla"), "r.campo", "r.control", "clave_registro", "r.valor")


def roll_up(results: DataFrame, soften: bool = False) -> DataFrame:
    """One row: worst state and counts. ``soften`` reports errors as a warning (partial load)."""
    counts = results.agg(
        F.count_if(F.col("resultado") == num.ERROR).alias("errores"),
        F.count_if(F.col("resultado") == num.WARNING).alias("warnings"),
        F.count(F.lit(1)).alias("registros_proc"),
    )
    worst = num.WARNING if soften else num.ERROR
    state = F.when(F.col("errores") > 0, worst).when(F.col("warnings") > 0, num.WARNING).otherwise(num.OK)
    if soften:
        state = F.when(F.col("errores") > 0, worst).otherwise(num.OK)
    detail = F.concat(
        F.lit("Errores: "), F.col("errores").cast("string"), F.lit(" | Warnings: "), F.col("warnings").cast("string")
    )
    return counts.select(state.alias("resultado"), detail.alias("detalle"), "errores", "warnings", "registros_proc")
