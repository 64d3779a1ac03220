"""Rounding and scaling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    """To one decimal, half to even; 0 of nothing."""
    return F.when(whole > 0, F.bround(part / whole * 100, 1)).otherwise(F.lit(0.0))


def thirds(c: Column) -> Column:
    """To three decimals, half to even."""
    return F.rint(c * 1000) / 1000


def sixths(c: Column) -> Column:
    """To six decimals, half up."""
    return F.floor(c * 1000000 + 0.5) / 1000000


def clip(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))
