"""Counts per day and week, shares of a day, brushing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heliograph.functions.dates import week_start

MOST_DAYS = 1001


def day_spine(rows: DataFrame, date: str = "d", most: int = MOST_DAYS) -> DataFrame:
    """d: every day from the first to the last, as many as ``most``."""
    ends = rows.agg(F.min(date).alias("a"), F.max(date).alias("z")).filter("a is not null")
    return ends.select(F.explode(F.slice(F.sequence("a", "z"), 1, most)).alias("d"))


def daily_counts(rows: DataFrame, codes: list[str], most: int = MOST_DAYS) -> DataFrame:
    """d, a column per code, total: days without rows count 0. From ``rows(d, code)``."""
    pivoted = rows.groupBy("d").pivot("code", codes).count()
    filled = day_spine(rows, most=most).join(pivoted, "d", "left").fillna(0, codes)
    return filled.withColumn("total", sum((F.col(f"`{c}`") for c in codes), F.lit(0)))


def daily_peak(daily: DataFrame) -> DataFrame:
    """One row: the highest daily total, at least 1."""
    return daily.agg(F.greatest(F.lit(1), F.coalesce(F.max("total"), F.lit(0))).alias("peak"))


def daily_shares(rows: DataFrame) -> DataFrame:
    """d, code, n, share of the day's total."""
    counted = rows.groupBy("d", "code").agg(F.count("*").alias("n"))
    return counted.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("d")))


def brush(rows: DataFrame, low, high, off: list[str]) -> DataFrame:
    """Rows within the days, without the codes that are switched off; newest first, then by headline."""
    return rows.filter(F.col("d").between(F.lit(low).cast("date"), F.lit(high).cast("date")) & ~F.col("code").isin(off)).orderBy(F.desc("d"), "h")


def listing(rows: DataFrame, collation: str = "UNICODE") -> DataFrame:
    """rows(d, h) with place, from 1 within a day: newest day first, headlines as a reader of the locale expects them; equal ones by code point."""
    by = Window.partitionBy("d").orderBy(F.collate("h", collation), F.collate("h", "UTF8_BINARY"))
    return rows.withColumn("place", F.row_number().over(by))


def week_index(rows: DataFrame, date: str = "d") -> DataFrame:
    """week and its place among the weeks that occur, from 0. Weeks are few; only they are ordered."""
    weeks = rows.select(week_start(F.col(date)).alias("week")).filter("week is not null").distinct()
    return weeks.select("week", (F.row_number().over(Window.orderBy("week")) - 1).alias("i"))


def day_lists(rows: DataFrame) -> DataFrame:
    """d and its articles, by headline."""
    return rows.groupBy("d").agg(F.sort_array(F.collect_list(F.struct("h", "u", "code"))).alias("articles"))
