"""Exact quantiles of columns of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The interval around a quantile is narrowed until it holds so few values; only these reach the driver.
FEW = 50_000


def quantile(rows: DataFrame, column: str, p: float, few: int = FEW) -> float | None:
    """The p-quantile with linear interpolation, as of all values in one sorted list; None of no values.

    Mergeable sketches give an interval that holds it, exact counts confirm
    that, and the interval is narrowed further until its distinct values
    are few. Each step is an aggregation; no task holds more than a sketch.
    """
    x = rows.select(F.col(column).cast("double").alias("x")).filter("x is not null")
    n = x.count()
    if not n:
        return None
    place = p * (n - 1)
    k = int(place)
    part, below, size, width = x, 0, n, 2e-3
    while True:
        if size <= few:
            break
        low, high = max(0.0, (k - below) / size - width), min(1.0, (k + 1 - below) / size + width)
        a, b = part.agg(F.percentile_approx("x", [low, high], 10_000)).first()[0]
        seen = part.agg(F.count_if(F.col("x") < a).alias("under"), F.count_if((F.col("x") >= a) & (F.col("x") <= b)).alias("inside")).first()
        if below + seen.under > k or below + seen.under + seen.inside <= min(k + 1, n - 1):
            width *= 4
            continue
        if a == b:
            return a
        if seen.inside == size:
            break  # ties: what is left are few distinct values
        part, below, size = part.filter((F.col("x") >= a) & (F.col("x") <= b)), below + seen.under, seen.inside
    wanted, at = {k: None, min(k + 1, n - 1): None}, below
    for r in part.groupBy("x").agg(F.count("*").alias("c")).orderBy("x").toLocalIterator():
        for i in wanted:
            if at <= i < at + r.c:
                wanted[i] = r.x
        at += r.c
        if at > k + 1:
            break
    low, high = wanted[k], wanted[min(k + 1, n - 1)]
    return low + (place - k) * (high - low)
