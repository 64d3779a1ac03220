"""Snapshot files (one CSV per run, the time in its name) and master archives."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph.functions.dates import parse_stamp
from heliograph.functions.text import clean_headline
from heliograph.operators.archive import keep_first, union_sources

SNAPSHOT = "url string, headline string"
MASTER = "url string, headline string, scrape_date string, scrape_datetime string"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _csv(reader, schema: str):
    return reader.schema(schema).option("header", True).option("escape", '"').option("encoding", "UTF-8")


def _stamped(rows: DataFrame, source: str) -> DataFrame:
    return rows.withColumns({"scraped_at": parse_stamp(F.regexp_extract(F.col("_metadata.file_name"), r"(\d{4}-\d\d-\d\d_\d\d\.\d\d\.\d\d)", 1)), "source": F.lit(source)})


def read_snapshots(spark: SparkSession, folder: str, source: str) -> DataFrame:
    """url, headline, scraped_at and source of all files of a folder; a folder that isn't there, and files without lines, give no rows."""
    if not exists(spark, folder):
        return spark.createDataFrame([], f"{SNAPSHOT}, scraped_at timestamp, source string")
    return _stamped(_csv(spark.read.option("multiLine", True), SNAPSHOT).csv(folder), source)


def stream_snapshots(spark: SparkSession, folder: str, source: str, files_per_batch: int = 50) -> DataFrame:
    """The same as a stream of files."""
    return _stamped(_csv(spark.readStream.option("maxFilesPerTrigger", files_per_batch).option("multiLine", True), SNAPSHOT).csv(folder), source)


def read_master(spark: SparkSession, path: str, source: str) -> DataFrame:
    """A master archive with its source; none there, or none that can be read, gives no rows.

    Columns are found by the names in the header, in any order; one that the
    header lacks is null, others are ignored. Damaged files are skipped.
    """
    none = spark.createDataFrame([], f"{MASTER}, source string")
    if not exists(spark, path):
        return none
    reader = spark.read.option("multiLine", True).option("header", True).option("escape", '"').option("encoding", "UTF-8").option("ignoreCorruptFiles", True)
    try:
        rows = reader.csv(path)
    except Exception as x:  # noqa: BLE001  a header that can't be read is told, and the other sources still load
        print(f"{path} is skipped: {str(x)[:200]}", file=sys.stderr)
        return none
    wanted = [name.split()[0] for name in MASTER.split(", ")]
    return rows.select(*[F.col(f"`{c}`") if c in rows.columns else F.lit(None).cast("string").alias(c) for c in wanted], F.lit(source).alias("source"))


def load_articles(frames: list[DataFrame], *order: str) -> DataFrame:
    """All sources with clean headlines; per url the row that comes first in the order of the frames, then ``order``."""
    ranked = [f.withColumn("source_rank", F.lit(i)) for i, f in enumerate(frames)]
    rows = union_sources(ranked).withColumn("headline", clean_headline(F.col("headline")))
    return keep_first(rows, "url", "source_rank", *order)


def write_snapshot(rows: DataFrame, folder: str, stamp: str) -> None:
    """One immutable set of CSV files per run, under its stamp."""
    rows.select("url", "headline").write.option("header", True).option("escape", '"').csv(f"{folder}/{stamp}.csv")
