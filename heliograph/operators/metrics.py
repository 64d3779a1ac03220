"""Counters of a run, gathered while a plan runs anyway."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def counted(rows: DataFrame, **conditions: Column) -> tuple[DataFrame, Observation]:
    """rows, and an observation that has ``rows`` and how many meet each condition once an action on them has run."""
    o = Observation()
    return rows.observe(o, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in conditions.items()]), o
