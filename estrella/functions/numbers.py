"""Ratios, shares, thresholds and segment labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# States of a control, a load and a segment.
OK, WARNING, ERROR = "OK", "WARNING", "ERROR"
RUNNING = "EN_PROCESO"
LOADED, PARTIAL, REJECTED, CORRECTED = "CARGADO", "CARGADO_PARCIAL", "RECHAZADO", "CORREGIDO"
REJECTED_PARTIAL = "RECHAZADO_PARCIAL"
CUSTOMER_SEGMENTS = ("PREMIUM", "REGULAR", "BAJO")
PRODUCT_SEGMENTS = ("TOP", "MID", "LOW")
SCORE_SEGMENTS = ("ALTO", "MEDIO", "BAJO")

MONEY = "decimal(18,4)"
WIDE = "decimal(20,0)"


def ratio(amount: Column, count: Column, scale: int = 4) -> Column:
    """``amount / count`` rounded half up; NULL when the count is zero."""
    return F.round(amount / F.nullif(count, F.lit(0)).cast(WIDE), scale)


def percentage(part: Column, whole: Column, scale: int) -> Column:
    """Share in percent, exact to ``scale`` digits; zero for an empty whole."""
    share = part.cast(WIDE) * F.lit(100) / F.nullif(whole, F.lit(0)).cast(WIDE)
    return F.coalesce(F.round(share, scale), F.lit(0)).cast(f"decimal(14,{scale})")


def evaluate(value: Column, warn: Column, error: Column, worst: Column | str = ERROR) -> Column:
    """Compare with two thresholds; exceeding one (not meeting it) raises the state, to ``worst`` beyond the second."""
    return F.when(value > error, worst).when(value > warn, WARNING).otherwise(OK)


def severity_order(state: Column) -> Column:
    return F.when(state == ERROR, 1).when(state == WARNING, 2).otherwise(3)


def quintile_segment(tile: Column, labels: Sequence[str], tiles: int = 5) -> Column:
    top, middle, low = labels
    return F.when(tile == tiles, top).when(tile >= 2, middle).otherwise(low)


def score_segment(score: Column) -> Column:
    high, middle, low = SCORE_SEGMENTS
    return F.when(score >= 4, high).when(score == 3, middle).when(score.isNotNull(), low)
