"""Timelines, weeks, stamps, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from heliograph.functions.dates import local_label, week_start
from heliograph.operators import timeline
from heliograph.plans.registry import query
from heliograph.plans.tables import DAYS, articles, days, table
from heliograph.scratch import scratch_folder
from heliograph.streaming import archive as streams
from heliograph.streaming.revisions import HISTORY, latest, revision_changes
from heliograph.streaming.tables import batches_to, read_batches

CODES = ["click", "purchase", "signup", "view"]
_SPINE = f"{DAYS}, spine AS (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM day_rows)"
_PIVOT = ", ".join(f"count(*) FILTER (WHERE code = '{c}') AS \"{c}\"" for c in CODES)


@query(f"WITH {_SPINE} SELECT spine.d, {_PIVOT}, count(*) FILTER (WHERE code IN ({', '.join(map(repr, CODES))})) AS total FROM spine LEFT JOIN day_rows USING (d) GROUP BY spine.d")
def daily_pivot(spark, sf_dir):
    return timeline.daily_counts(days(spark, sf_dir), CODES)


@query(f"WITH {DAYS} SELECT greatest(1, max(n)) AS peak FROM (SELECT d, count(*) AS n FROM day_rows WHERE code IN ({', '.join(map(repr, CODES))}) GROUP BY d)")
def daily_peak(spark, sf_dir):
    return timeline.daily_peak(timeline.daily_counts(days(spark, sf_dir), CODES))


@query(f"WITH {DAYS}, c AS (SELECT d, code, count(*) AS n FROM day_rows GROUP BY d, code) SELECT d, code, n, floor(n / sum(n) OVER (PARTITION BY d) * 1000000 + 0.5) / 1000000 AS share FROM c")
def daily_share(spark, sf_dir):
    from heliograph.functions.numbers import sixths

    return timeline.daily_shares(days(spark, sf_dir)).withColumn("share", sixths(F.col("share")))


@query(f"WITH {DAYS} SELECT d, code, h FROM day_rows WHERE d BETWEEN DATE '2024-01-05' AND DATE '2024-01-12' AND code NOT IN ('view')")
def range_brush(spark, sf_dir):
    return timeline.brush(days(spark, sf_dir), "2024-01-05", "2024-01-12", ["view"]).select("d", "code", "h")


@query(
    """WITH l AS (SELECT DATE '2024-01-01' + CAST(doc_id % 40 AS INTEGER) AS d, doc_id, split_part(text, chr(10), 1) AS h FROM documents WHERE text IS NOT NULL)
SELECT d, h, row_number() OVER (PARTITION BY d ORDER BY icu_sort_key(h, 'root'), h, doc_id) AS place FROM l""".replace(", h, doc_id)", ", h)")
)
def locale_listing(spark, sf_dir):
    """Headlines of a day as a reader expects them, in Unicode's order."""
    return timeline.listing(articles(spark, sf_dir).filter("body is not null").select(F.col("date").alias("d"), F.col("headline").alias("h"))).withColumn("place", F.col("place").cast("bigint"))


@query(f"WITH {DAYS}, w AS (SELECT DISTINCT CAST(date_trunc('week', d) AS DATE) AS week FROM day_rows) SELECT week, row_number() OVER (ORDER BY week) - 1 AS i FROM w")
def week_index(spark, sf_dir):
    return timeline.week_index(days(spark, sf_dir)).withColumn("i", F.col("i").cast("bigint"))


@query(f"WITH {DAYS} SELECT d, count(*) AS n, string_agg(h, '|' ORDER BY h COLLATE \"C\") AS articles FROM day_rows WHERE code = 'purchase' GROUP BY d".replace(' COLLATE "C"', ""))
def day_lists(spark, sf_dir):
    lists = timeline.day_lists(days(spark, sf_dir).filter("code = 'purchase'"))
    return lists.select("d", F.size("articles").cast("bigint").alias("n"), F.array_join(F.transform("articles", lambda a: a["h"]), "|").alias("articles"))


@query("SELECT event_id, CAST(date_trunc('week', ts) AS DATE) AS week FROM events")
def week_starts(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", week_start(F.col("ts")).alias("week"))


@query(
    "SELECT event_id, CASE WHEN event_id % 1000 = 0 THEN '2024-01-01' ELSE strftime(ts + CASE WHEN ts >= TIMESTAMP '2024-03-31 01:00:00' AND ts < TIMESTAMP '2024-10-27 01:00:00' THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END, '%d %b %H:%M') END AS label FROM events"
)
def ts_amsterdam(spark, sf_dir):
    """Stamps of events as local labels, and one malformed stamp per thousand."""
    stamp = F.date_format("ts", "yyyy-MM-dd_HH.mm.ss")
    return table(spark, sf_dir, "events").select("event_id", local_label(F.when(F.col("event_id") % 1000 == 0, F.lit("2024-01-01 at noon")).otherwise(stamp)).alias("label"))


@query("SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def day_windows(spark, sf_dir):
    return streams.bucket_counts(table(spark, sf_dir, "events"), "ts", "1 day", "event_type")


@query("SELECT CAST(date_trunc('week', ts) AS TIMESTAMP) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def week_windows(spark, sf_dir):
    return streams.bucket_counts(table(spark, sf_dir, "events"), "ts", "7 days", "event_type")


@query("SELECT user_id, min(ts) AS ts, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id")
def stream_first_seen(spark, sf_dir):
    """The events as a stream of files, replayed to its end; equal to first_seen."""
    schema = table(spark, sf_dir, "events").schema
    rows = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")
    found = streams.first_seen(rows, "user_id", "ts", "event_id")
    folder = scratch_folder(spark, "first-seen")
    batches_to(found, f"{folder}/found", f"{folder}/checkpoint", "complete").awaitTermination()
    return read_batches(spark, f"{folder}/found", "user_id bigint, ts timestamp, event_id bigint", last=True)


@query(
    """WITH v AS (SELECT CAST(conv_id AS VARCHAR) AS aid, text AS h, min(turn) AS t FROM conversations WHERE text IS NOT NULL AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id, text)
SELECT aid, count(*) AS n, string_agg(h, '|' ORDER BY t) AS versions, CAST(TIMESTAMP '2024-01-01' + to_minutes(CAST(max(t) AS INTEGER)) AS TIMESTAMP) AS last FROM v GROUP BY aid HAVING count(*) >= 2"""
)
def stream_revision_history(spark, sf_dir):
    """Turns of conversations as sightings of headlines, a minute apart, streamed through state to the end."""
    schema = table(spark, sf_dir, "conversations").schema
    turns = spark.readStream.schema(schema).parquet(f"{sf_dir}/conversations.parquet*").filter("turn is not null and conv_id is not null")
    at = F.timestamp_micros(F.lit(1704067200000000) + F.col("turn") * 60_000_000)
    rows = turns.select(F.col("conv_id").cast("string").alias("aid"), F.concat_ws("/", "conv_id", "turn").alias("url"), F.col("text").alias("headline"), at.alias("at"), F.col("turn").alias("ord"))
    folder = scratch_folder(spark, "history")
    batches_to(revision_changes(rows), f"{folder}/found", f"{folder}/checkpoint", "update").awaitTermination()
    found = latest(read_batches(spark, f"{folder}/found", HISTORY))
    return found.select("aid", "n", F.array_join(F.transform("versions", lambda x: x["h"]), "|").alias("versions"), "last")
