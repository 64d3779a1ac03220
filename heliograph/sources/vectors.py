"""A cache of text vectors, keyed by url within scope and model."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph.functions.text import slug
from heliograph.operators.similarity import embed_new
from heliograph.sources.snapshots import exists

CACHE = "url string, vec array<float>, scope string, model string"


def read_cache(spark: SparkSession, path: str, scope: str, model: str) -> DataFrame:
    """url and vec of one scope and model; a cache that isn't there is empty. Scope and model are partitions, so nothing else is read."""
    rows = spark.read.schema(CACHE).parquet(path) if exists(spark, path) else spark.createDataFrame([], CACHE)
    return rows.filter((F.col("scope") == scope) & (F.col("model") == model)).select("url", "vec")


def cached_vectors(rows: DataFrame, path: str, scope: str, model: str, encode: Callable[[list[str]], np.ndarray]) -> DataFrame:
    """url and vec of every url of ``rows(url, text)``; those that the cache lacks are encoded and appended to it first."""
    spark = rows.sparkSession
    key = spark.range(1).select(slug(F.lit(model)).alias("m")).first().m
    fresh = embed_new(rows, read_cache(spark, path, scope, key), encode)
    fresh.withColumns({"scope": F.lit(scope), "model": F.lit(key)}).write.mode("append").partitionBy("scope", "model").parquet(path)
    return read_cache(spark, path, scope, key).join(rows.select("url").distinct(), "url", "left_semi")


def first_that_works(*encoders: Callable[[], Callable[[list[str]], np.ndarray]]) -> Callable[[list[str]], np.ndarray]:
    """The first encoder that can be made; the error of the last if none can."""
    error: Exception = ValueError("no encoder given")
    for make in encoders:
        try:
            return make()
        except Exception as e:  # noqa: BLE001  the next may work
            error = e
    raise error
