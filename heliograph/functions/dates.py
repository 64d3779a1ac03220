"""Dates and stamps. Malformed input gives null or a fall-back, never an error."""

from __future__ import annotations

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STAMP = "yyyy-MM-dd_HH.mm.ss"


def parse_stamp(c: Column) -> Column:
    """yyyy-MM-dd_HH.mm.ss as UTC; null if it is anything else."""
    return F.try_to_timestamp(c, F.lit(STAMP))


def local_label(c: Column, zone: str = "Europe/Amsterdam") -> Column:
    """A stamp as ``dd MMM HH:mm`` in a zone; else its first ten characters."""
    return F.coalesce(F.date_format(F.from_utc_timestamp(parse_stamp(c), zone), "dd MMM HH:mm"), F.substring(c, 1, 10))


def week_start(c: Column) -> Column:
    """The Monday on or before a date given as text, date or timestamp; null if it is none."""
    return F.trunc(F.substring(c.cast("string"), 1, 10).try_cast("date"), "week")


def long_date(c: Column) -> Column:
    """As 5 Jan 2024."""
    return F.date_format(c, "d MMM yyyy")


def short_date(c: Column) -> Column:
    """As 5 Jan."""
    return F.date_format(c, "d MMM")


def span_label(low: Column, high: Column) -> Column:
    """One day in full, or a range whose first day goes without its year."""
    return F.when(low == high, long_date(low)).otherwise(F.concat(short_date(low), F.lit(" – "), long_date(high)))


def run_stamps(now: datetime, zone: str = "Europe/Amsterdam", name: str = "Amsterdam") -> tuple[str, str]:
    """A short and a full stamp of one instant. The caller gives the instant, so a run can be repeated."""
    at = now.astimezone(ZoneInfo(zone))
    return f"{at:%Y-%m-%d %H:%M} {name}", f"{at:%Y-%m-%d %H:%M:%S %Z (UTC%:z)} · {zone}"


def scrape_columns(rows: DataFrame, at: datetime) -> DataFrame:
    """rows with scrape_date and scrape_datetime of a run, as text in UTC."""
    return rows.withColumns({"scrape_date": F.lit(f"{at:%Y-%m-%d}"), "scrape_datetime": F.lit(f"{at:%Y-%m-%d_%H.%M.%S}")})
