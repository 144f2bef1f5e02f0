"""Cleaning and typing of raw text columns. All expressions stay inside Catalyst."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that stands for "no value" in the raw files.
NULL_WORD = "NULL"
EMPTY = ""

REPLACEMENT_CHARACTER = "�"

INTEGER_TEXT = r"^[0-9]+\z"
NUMERIC_TEXT = r"^[0-9]+(\.[0-9]+)?\z"
DATE_PREFIX = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"


def text_or_null(value: Column, tokens: Sequence[str] = (NULL_WORD,)) -> Column:
    """Trim, then turn each of ``tokens`` into NULL."""
    cleaned = F.trim(value)
    for token in tokens:
        cleaned = F.nullif(cleaned, F.lit(token))
    return cleaned


def typed(value: Column, data_type: str, via: str | None = None) -> Column:
    """Cast text, giving NULL when it does not fit; ``via`` rounds to a narrower type first.

    ``char(n)`` cuts the text after n characters.
    """
    if via:
        value = value.try_cast(via)
    if data_type == "string":
        return value
    if data_type.startswith("char("):
        return F.substring(value, 1, int(data_type[5:-1]))
    return value.try_cast(data_type)


def first_ten(value: Column, tokens: Sequence[str] = (EMPTY,)) -> Column:
    """The first ten characters, as a date is written; each of ``tokens`` becomes NULL."""
    return text_or_null(F.substring(F.trim(value), 1, 10), tokens)


def scrubbed(value: Column) -> Column:
    """A number's text without currency signs, percent signs, separators and blanks."""
    return F.nullif(F.regexp_replace(value, "[^0-9.-]", ""), F.lit(""))


def recode(value: Column, mapping: Mapping[str, str]) -> Column:
    """Replace listed values; others pass unchanged."""
    if not mapping:
        return value
    result = None
    for old, new in mapping.items():
        hit = value == F.lit(old)
        result = F.when(hit, F.lit(new)) if result is None else result.when(hit, F.lit(new))
    return result.otherwise(value)


def full_name(first: Column, last: Column) -> Column:
    """First and last name; NULL when either part is missing."""
    return F.trim(F.concat(first, F.lit(" "), last))


def is_blank(value: Column) -> Column:
    return value.isNull() | (value == "")


def is_blank_trimmed(value: Column) -> Column:
    return value.isNull() | (F.trim(value) == "")


def is_corrupt(value: Column) -> Column:
    """True where decoding has lost a character."""
    return F.coalesce(value.contains(REPLACEMENT_CHARACTER), F.lit(False))
