"""From raw text to typed rows: normalisation, valid/reject split, corrections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrella.functions import numbers as num
from estrella.functions import text as txt

REJECT_COLUMNS = ["tabla_origen", "clave_registro", "motivo_rechazo", "decision"]


@dataclass(frozen=True)
class Field:
    """How one raw text column becomes a typed one.

    ``via`` rounds through a narrower type, ``prefix_date`` reads the first ten characters as a
    date, ``scrub`` strips signs and separators before the cast, ``keep`` leaves the text as is.
    """

    name: str
    type: str = "string"
    nulls: tuple[str, ...] = (txt.NULL_WORD,)
    via: str | None = None
    prefix_date: bool = False
    scrub: bool = False
    keep: bool = False

    def cleaned(self) -> Column:
        raw = F.col(self.name)
        if self.keep:
            return raw
        if self.scrub:
            return txt.scrubbed(raw)
        if self.prefix_date:
            return txt.first_ten(raw, self.nulls)
        return txt.text_or_null(raw, self.nulls)

    def value(self) -> Column:
        return txt.typed(self.cleaned(), self.type, self.via).alias(self.name)

    def lost(self) -> Column:
        """Text was there but did not fit the type."""
        return self.cleaned().isNotNull() & txt.typed(self.cleaned(), self.type, self.via).isNull()


def stage(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Typed projection of a raw table; columns not listed are dropped."""
    return df.select(*[f.value() for f in fields])


def cast_rejects(table: str, df: DataFrame, fields: Sequence[Field], key: Sequence[str]) -> DataFrame:
    """One reject per value that could not be cast, so nothing disappears silently."""
    lost = [
        F.when(f.lost(), F.concat(F.lit(f"Valor no convertible en {f.name}: "), f.cleaned()))
        for f in fields
        if f.type != "string"
    ]
    hits = df.select(_key_text(key).alias("clave_registro"), F.explode(F.array_compact(F.array(*lost))).alias("motivo_rechazo"))
    return hits.select(F.lit(table).alias("tabla_origen"), "clave_registro", "motivo_rechazo", F.lit(num.REJECTED).alias("decision"))


def split_valid(
    table: str, df: DataFrame, valid: Column, key: Sequence[str], reason: Column, strict_null: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Rows that pass and, as reject rows, those that do not.

    ``strict_null`` rejects rows whose test is unknown; without it they are in neither part.
    """
    failed = F.coalesce(~valid, F.lit(True)) if strict_null else ~valid
    rejects = df.filter(failed).select(
        F.lit(table).alias("tabla_origen"),
        _key_text(key).alias("clave_registro"),
        reason.alias("motivo_rechazo"),
        F.lit(num.REJECTED).alias("decision"),
    )
    return df.filter(valid), rejects


def score_reason(score: Column) -> Column:
    # fixed value: the wording of the reject reason
    shown = F.coalesce(txt.text_or_null(score, ("",)), F.lit("<vacio>"))
    return F.concat(F.lit("Score invalido: valor "), shown, F.lit(". La regla de calidad exige score entre 1 y 5."))


def valid_score(score: Column, low: int = 1, high: int = 5) -> Column:
    whole = F.trim(score)
    return whole.rlike(txt.INTEGER_TEXT) & F.coalesce(whole.try_cast("bigint").between(low, high), F.lit(False))


def corrupted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which any of ``columns`` carries the replacement character."""
    return df.filter(reduce(lambda a, b: a | b, [txt.is_corrupt(F.col(c)) for c in columns]))


def apply_corrections(df: DataFrame, key: str, corrections: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace ``columns`` by the non-null values of the row with the same key in ``corrections``.

    Columns missing from ``corrections`` stay as they are.
    """
    fixed = [c for c in columns if c in corrections.columns]
    fixes = corrections.select(key, *[F.col(c).alias(f"_new_{c}") for c in fixed])
    joined = df.join(fixes, key, "left")
    return joined.select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in fixed else F.col(c) for c in df.columns])


def propagate(mart: DataFrame, dim: DataFrame, key: str, columns: Mapping[str, str]) -> DataFrame:
    """Refresh mart columns (name in the mart to name in the dimension) from a corrected dimension."""
    fresh = dim.select(key, *[F.col(source).alias(f"_new_{target}") for target, source in columns.items()])
    marked = fresh.withColumn("_hit", F.lit(True))
    joined = mart.join(marked, key, "left")
    return joined.select(
        *[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in mart.columns]
    )


def _key_text(key: Sequence[str]) -> Column:
    return F.concat_ws("/", *[F.trim(F.col(k).cast("string")) for k in key])
