"""Incremental forms: first-seen archive, new rows only, buckets of time, revision alerts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliograph.operators.archive import append_new
from heliograph.operators.buckets import BucketedArchive


def first_seen(rows: DataFrame, key: str, at: str, *values: str) -> DataFrame:
    """Per key, the earliest row by ``at``, then by the values. The same aggregation over a batch and over a stream (complete or update mode)."""
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(at, *values)).alias("r")).select(key, "r.*")


def keep_archive(stream: DataFrame, archive_path: str, checkpoint: str, key: str, *order: str, then: Callable[[DataFrame], None] | None = None):
    """Starts a query that appends rows of new keys to a Parquet archive, and hands them on, e.g. to be embedded."""

    def step(batch: DataFrame, number: int) -> None:
        fresh = append_new(archive_path, batch, key, *order, run=f"batch-{number:09d}")
        if then:
            then(fresh)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def keep_bucketed(stream: DataFrame, archive: BucketedArchive, checkpoint: str, *order: str, then: Callable[[DataFrame], None] | None = None):
    """The same into a bucketed archive: a batch reads the bitmaps of its buckets, and rows of those buckets alone that may hold its keys."""

    def step(batch: DataFrame, number: int) -> None:
        fresh = archive.append(batch, *order, run=f"batch-{number:09d}")
        if then:
            then(fresh)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def week_of(at: Column) -> Column:
    """The start of the Monday-aligned week that holds a time, as a window start."""
    return F.window(at, "7 days", "7 days", "4 days")["start"]


def bucket_counts(rows: DataFrame, at: str, size: str, *by: str, late: str | None = None) -> DataFrame:
    """start, by, n per window of time; on a stream, ``late`` sets the watermark."""
    if late:
        rows = rows.withWatermark(at, late)
    w = F.window(at, "7 days", "7 days", "4 days") if size == "7 days" else F.window(at, size)
    return rows.groupBy(w.alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *by, "n")


def revision_alerts(rows: DataFrame) -> DataFrame:
    """aid, first and last: for each article seen under two headlines at least, the least and the greatest of them by code point.

    Over a stream in update mode. The state of an article is two headlines,
    however often it changes; revision_history tells all versions in order.
    """
    both = rows.filter("aid is not null and headline is not null").groupBy("aid").agg(F.min("headline").alias("first"), F.max("headline").alias("last"))
    return both.filter("first <> last")
