"""The test tables as articles, dated events and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as ord, url, source, headline (the first line), body, date and lang."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ord"),
        F.col("doc_id").cast("string").alias("url"),
        "source",
        F.substring_index("text", "\n", 1).alias("headline"),
        F.col("text").alias("body"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 40).cast("int")).alias("date"),
        "lang",
    )


ARTICLES = """art AS (SELECT doc_id AS ord, CAST(doc_id AS VARCHAR) AS url, source, split_part(text, chr(10), 1) AS headline,
  text AS body, DATE '2024-01-01' + CAST(doc_id % 40 AS INTEGER) AS date, lang FROM documents)"""


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as d, code, h and u."""
    return table(spark, sf_dir, "events").select(F.to_date("ts").alias("d"), F.col("event_type").alias("code"), F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("h"), F.col("event_id").cast("string").alias("u"), "event_id")


DAYS = "day_rows AS (SELECT CAST(ts AS DATE) AS d, event_type AS code, 'event ' || CAST(event_id AS VARCHAR) AS h, CAST(event_id AS VARCHAR) AS u, event_id FROM events)"


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"), "label")
