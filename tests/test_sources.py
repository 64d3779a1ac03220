"""Snapshots, masters and streams on small files."""

import datetime as dt

from pyspark.sql import functions as F

from heliograph.sources import snapshots
from heliograph.streaming import archive as streams


def _write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_snapshots(spark, tmp_path):
    d = tmp_path / "s"
    _write(d, "2026-07-12_21.48.16.csv", ["url,headline", 'u1,"a, ""quoted"" õ"', "u2,b"])
    _write(d, "2026-07-12_22.48.16.csv", ["url,headline", "u1,changed", "u3,c"])
    (d / "2026-07-12_23.48.16.csv").write_text("\n")
    rows = snapshots.read_snapshots(spark, str(d), "err_ee")
    assert rows.count() == 4
    first = streams.first_seen(rows, "url", "scraped_at", "headline").orderBy("url").collect()
    assert [(r.url, r.headline, r.scraped_at.hour) for r in first] == [("u1", 'a, "quoted" õ', 21), ("u2", "b", 21), ("u3", "c", 22)]
    assert snapshots.read_snapshots(spark, str(tmp_path / "none"), "x").count() == 0
    assert snapshots.read_master(spark, str(tmp_path / "none.csv"), "x").count() == 0

    q = streams.first_seen(snapshots.stream_snapshots(spark, str(d), "err_ee", 1), "url", "scraped_at", "headline").writeStream.format("memory").queryName("fs").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("fs").orderBy("url").collect() == first

    arch, seen = str(tmp_path / "arch"), []
    q = streams.keep_archive(snapshots.stream_snapshots(spark, str(d), "err_ee", 1), arch, str(tmp_path / "cp"), "url", "scraped_at", then=lambda b: seen.append(b.count()))
    q.awaitTermination()
    assert spark.read.parquet(arch).count() == 3 and sum(seen) == 3


def test_load_articles_prefers_the_first_source(spark):
    a = spark.createDataFrame([("u", "A ", 1), (None, "x", 2)], "url string, headline string, row int")
    b = spark.createDataFrame([("u", "B", 0), ("v", None, 1)], "url string, headline string, row int")
    assert {(r.url, r.headline) for r in snapshots.load_articles([a, b], "row").collect()} == {("u", "A"), ("v", "")}


def test_windows_start_on_monday(spark):
    rows = spark.createDataFrame([(dt.datetime(2026, 7, 12, 23), ), (dt.datetime(2026, 7, 13, 0),)], "t timestamp")
    got = sorted(str(r.w) for r in rows.select(streams.week_of(F.col("t")).alias("w")).collect())
    assert got == ["2026-07-06 00:00:00", "2026-07-13 00:00:00"]


def test_alerts(spark):
    rows = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "a"), ("2", "a")], "aid string, headline string")
    assert [r.aid for r in streams.revision_alerts(rows).collect()] == ["1"]


def test_windows_of_a_stream_close_at_the_watermark(spark, tmp_path):
    schema, folder = "t timestamp, code string", tmp_path / "in"
    folder.mkdir()
    q = streams.bucket_counts(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder)), "t", "1 day", "code", late="1 day")
    q = q.writeStream.format("memory").queryName("closed").outputMode("append").start()
    try:
        for k, day in enumerate((1, 1, 2, 5, 1, 9)):  # the fifth row is too late
            (folder / f"{k}.json").write_text(f'{{"t": "2024-01-0{day} 10:00:00", "code": "x"}}\n')
            q.processAllAvailable()
        got = sorted((r.start.day, r.n) for r in spark.table("closed").collect())
    finally:
        q.stop()
    assert got == [(1, 2), (2, 1), (5, 1)]


def test_masters_of_any_header(spark, tmp_path):
    (tmp_path / "old.csv").write_text('url,headline,scrape_date\nu1,"a ""b""\nc",2024-01-01\n', encoding="utf-8")
    (r,) = snapshots.read_master(spark, str(tmp_path / "old.csv"), "err_ee").collect()
    assert tuple(r) == ("u1", 'a "b"\nc', "2024-01-01", None, "err_ee")
    (tmp_path / "new.csv").write_text("extra,scrape_datetime,headline,url\nx,2024-01-01_05.00.00,h,u2\n", encoding="utf-8")
    (r,) = snapshots.read_master(spark, str(tmp_path / "new.csv"), "err_ee").collect()
    assert (r.url, r.headline, r.scrape_date, r.scrape_datetime) == ("u2", "h", None, "2024-01-01_05.00.00")
    (tmp_path / "empty.csv").write_text("")
    assert snapshots.read_master(spark, str(tmp_path / "empty.csv"), "err_ee").count() == 0
    assert snapshots.read_master(spark, str(tmp_path / "none.csv"), "err_ee").count() == 0


def test_streamed_snapshots_keep_line_ends(spark, tmp_path):
    d = tmp_path / "snapshots"
    d.mkdir()
    (d / "2024-01-01_05.00.00.csv").write_text('url,headline\nu1,"two\nlines"\n', encoding="utf-8")
    q = snapshots.stream_snapshots(spark, str(d), "err_ee").writeStream.format("memory").queryName("line_ends").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r.headline for r in spark.table("line_ends").collect()] == ["two\nlines"] == [r.headline for r in snapshots.read_snapshots(spark, str(d), "err_ee").collect()]
