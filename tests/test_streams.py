"""State kept over batches and restarts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from heliograph.operators.revisions import revision_history
from heliograph.streaming import revisions, tables

ROW = "aid string, url string, headline string, at timestamp, ord bigint"


def sightings(n, seed=1):
    rng = random.Random(seed)
    at = lambda: None if rng.random() < 0.05 else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(5000))
    urls = [(str(rng.randrange(40)), f"u{k}") for k in range(90)]  # a url is of one article
    return [(*rng.choice(urls), f"h{rng.randrange(4)}", at(), i) for i in range(n)]


@pytest.mark.parametrize("same_url", [False, True])
def test_history_survives_restarts(spark, tmp_path, same_url):
    """Each run takes up the checkpoint of the one before; rows come in no order."""
    rows, source, out, checkpoint = sightings(300), str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for k in range(3):
        spark.createDataFrame(rows[100 * k : 100 * k + 100], ROW).coalesce(1).write.mode("append").parquet(source)
        stream = revisions.revision_changes(spark.readStream.schema(ROW).parquet(source), same_url)
        tables.batches_to(stream, out, checkpoint, "update").awaitTermination()
    changes = tables.read_batches(spark, out, revisions.HISTORY)
    got = [tuple(r) for r in revisions.latest(changes).select("aid", "n", "versions", "last").orderBy("aid").collect()]
    whole = revision_history(spark.createDataFrame(rows, ROW), same_url=same_url)
    assert got == [tuple(r) for r in whole.select("aid", F.col("n").cast("bigint").alias("n"), "versions", "last").orderBy("aid").collect()]
    assert changes.groupBy("aid", "change").count().filter("count > 1").isEmpty()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != revisions.ROCKS


def test_idle_articles_are_forgotten(spark, tmp_path):
    source, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    day = lambda d: dt.datetime(2024, 1, d)
    batches = [[("1", "a", "x", day(1), 1), ("2", "b", "x", day(1), 2)], [("2", "c", "y", day(2), 3)], [("3", "d", "x", day(20), 4)], [("3", "e", "x", day(21), 5)], [("1", "f", "y", day(22), 6), ("3", "g", "z", day(22), 7)]]
    for rows in batches:
        spark.createDataFrame(rows, ROW).coalesce(1).write.mode("append").parquet(source)
        stream = revisions.revision_changes(spark.readStream.schema(ROW).parquet(source), idle="5 days")
        tables.batches_to(stream, out, checkpoint).awaitTermination()
    got = {(r.aid, r.n) for r in tables.read_batches(spark, out, revisions.HISTORY).collect()}
    assert got == {("2", 2), ("3", 2)}  # the first headline of article 1 had been forgotten


def test_complete_results_are_those_of_the_last_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    for k in range(2):
        spark.createDataFrame([(k, 1), (7, k)], "a long, b long").coalesce(1).write.mode("append").parquet(source)
        counts = spark.readStream.schema("a long, b long").parquet(source).groupBy("a").count()
        tables.batches_to(counts, str(tmp_path / "out"), str(tmp_path / "cp"), "complete").awaitTermination()
    got = {(r.a, r["count"]) for r in tables.read_batches(spark, str(tmp_path / "out"), "a long, count long", last=True).collect()}
    assert got == {(0, 1), (1, 1), (7, 2)}
