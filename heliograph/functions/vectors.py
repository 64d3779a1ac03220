"""Vector expressions over array columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def unit(v: Column) -> Column:
    """Scaled to length 1; a zero vector stays. The length is bound to a name, as a lambda would compute it again for each element."""
    scaled = lambda n: F.transform(doubles(v), lambda x: x / F.when(n == 0, 1.0).otherwise(n))
    return F.get(F.transform(F.array(F.sqrt(dot(v, v))), scaled), F.lit(0))
