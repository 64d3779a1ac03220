"""Shares and coverage per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliograph.functions.numbers import percent


def topic_shares(sources: DataFrame, rows: DataFrame, matched: Column, date: str = "date") -> DataFrame:
    """Per row of ``sources(source, rank, ...)``: matched, total, pct, d0 and d1 of ``rows(source, date)``, highest share first.

    One pass counts both. A source without rows has zeros and blank dates;
    ties keep the order of rank.
    """
    counted = rows.groupBy("source").agg(F.count_if(matched).alias("matched"), F.count("*").alias("total"), F.min(F.col(date).cast("string")).alias("d0"), F.max(F.col(date).cast("string")).alias("d1"))
    joined = sources.join(counted, "source", "left")
    none = {"matched": F.coalesce("matched", F.lit(0)), "total": F.coalesce("total", F.lit(0)), "d0": F.coalesce("d0", F.lit("")), "d1": F.coalesce("d1", F.lit(""))}
    return joined.withColumns(none).withColumn("pct", percent(F.col("matched"), F.col("total"))).orderBy(F.desc("pct"), "rank")


def coverage(shares: DataFrame) -> DataFrame:
    """One row: from, to and the number of sources with rows; blanks don't count."""
    dated = lambda c: F.nullif(F.col(c), F.lit(""))
    return shares.agg(F.coalesce(F.min(dated("d0")), F.lit("")).alias("from"), F.coalesce(F.max(dated("d1")), F.lit("")).alias("to"), F.count_if(F.col("total") > 0).alias("sources"))


def map_fill(areas: DataFrame, shares: DataFrame, homes: DataFrame) -> DataFrame:
    """Every area (code) with its share, 0 where unknown, its opacity and its home page."""
    joined = areas.join(shares.select("code", "pct", "matched", "total"), "code", "left").join(homes, "code", "left")
    filled = joined.withColumns({"pct": F.coalesce("pct", F.lit(0.0)), "matched": F.coalesce("matched", F.lit(0)), "total": F.coalesce("total", F.lit(0)), "home": F.coalesce("home", F.lit(""))})
    return filled.withColumn("opacity", 0.15 + 0.85 * F.col("pct") / 100)
