"""The bucketed archive: each key once, little read, repeated runs."""

import numpy as np
from pyspark.sql import functions as F

from heliograph.operators import buckets

SCHEMA = "url string, at bigint, headline string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(2)


def test_bitmaps_lose_no_key():
    rng = np.random.default_rng(1)
    for n in (1, 7, 1000):
        h = rng.integers(-(1 << 63), 1 << 63, n)
        b = buckets.bitmap(h)
        assert buckets.may_hold(b, h).all()
        assert buckets.may_hold(b, rng.integers(-(1 << 63), 1 << 63, 5000)).mean() < 0.05


def test_each_key_once(spark, tmp_path):
    a = buckets.BucketedArchive(spark, str(tmp_path / "a"), SCHEMA, "url", buckets=8)
    one = a.append(frame(spark, [("u1", 2, "late"), ("u1", 1, "first"), ("u2", 1, "x"), (None, 1, "no key")]), "at", "headline", run="one")
    assert {(r.url, r.headline) for r in one.collect()} == {("u1", "first"), ("u2", "x")}
    two = a.append(frame(spark, [("u1", 0, "earlier, but known"), ("u3", 1, "y")]), "at", run="two")
    assert {r.url for r in two.collect()} == {"u3"}
    for _ in range(2):  # the same run again, with other rows at first
        again = a.append(frame(spark, [("u3", 5, "z"), ("u4", 1, "w")]), "at", run="two")
    assert {r.url for r in again.collect()} == {"u3", "u4"}
    assert {(r.url, r.headline) for r in a.rows().collect()} == {("u1", "first"), ("u2", "x"), ("u3", "z"), ("u4", "w")}
    assert buckets.BucketedArchive(spark, str(tmp_path / "a"), SCHEMA, "url", buckets=99).buckets == 8
    assert a.append(frame(spark, []), "at", run="none").count() == 0


def test_new_keys_read_no_rows(spark, tmp_path):
    a = buckets.BucketedArchive(spark, str(tmp_path / "a"), SCHEMA, "url", buckets=16)
    made = lambda lo, hi: spark.range(lo, hi).select(F.concat(F.lit("u"), "id").alias("url"), "id", F.lit("h")).toDF("url", "at", "headline")
    for k in range(3):
        counts: dict = {}
        a.append(made(3000 * k, 3000 * k + 3000), "at", run=str(k))
        assert a.append(made(100_000 + 8 * k, 100_008 + 8 * k), "at", run=f"few {k}", counts=counts).count() == 8
        assert counts["touched"] <= 8 and counts["read"] <= 2  # a bitmap errs once in a few hundred keys
    counts = {}
    assert a.append(made(5, 6), "at", run="known", counts=counts).count() == 0 and counts == {"read": 1, "touched": 1}
    assert a.rows().count() == 9024


def test_stream_into_buckets(spark, tmp_path):
    from heliograph.streaming.archive import keep_bucketed

    source, seen = str(tmp_path / "in"), []
    a = buckets.BucketedArchive(spark, str(tmp_path / "a"), SCHEMA, "url", buckets=4)
    for k in range(2):
        frame(spark, [("u1", k, "h"), (f"only {k}", k, "h")]).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        keep_bucketed(stream, a, str(tmp_path / "cp"), "at", then=lambda b: seen.append(b.count())).awaitTermination()
    assert seen == [2, 1] and sorted((r.url, r["at"]) for r in a.rows().collect()) == [("only 0", 0), ("only 1", 1), ("u1", 0)]
