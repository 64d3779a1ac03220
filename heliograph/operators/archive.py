"""The archive of first-seen rows: union, keep-first, first-seen, insert-only upsert."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heliograph.scratch import settle


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """All rows by column name; a column that a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def keep_first(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """Per key, the row that comes first; rows without a key go.

    Aggregates before the shuffle, so a key with many rows is no load.
    ``order`` must tell rows of a key apart.
    """
    whole = F.struct(*[F.col(c) for c in rows.columns])
    picked = rows.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(F.min_by(whole, F.struct(*order)).alias("r"))
    return picked.select("r.*")


def lacking(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """The rows whose key ``known`` lacks; rows without a key stay."""
    return rows.join(known.select(key).distinct(), key, "left_anti").select(*rows.columns)


def upsert_new(old: DataFrame, new: DataFrame, key: str, *order: str) -> DataFrame:
    """Old rows unchanged, then the first new row of each key that old lacks."""
    fresh = lacking(keep_first(new, key, *order), old, key)
    return old.unionByName(fresh.select(*old.columns), allowMissingColumns=True)


def append_new(archive_path: str, new: DataFrame, key: str, *order: str, run: str | None = None) -> DataFrame:
    """Append to a Parquet archive what it lacks, and return the rows added.

    Each call writes one folder, ``run=...``, once, and returns what it holds. A
    call that is repeated under the same name, as after a crash, replaces
    its folder by the same rows: it compares with the other folders only.
    """
    spark = new.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(archive_path)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    run = run or uuid.uuid4().hex
    fresh = keep_first(new, key, *order)
    if there:
        schema = f"{', '.join(f'`{n}` {t}' for n, t in new.dtypes)}, run string"
        fresh = lacking(fresh, spark.read.schema(schema).parquet(archive_path).filter(F.col("run") != run), key)
    own = f"{archive_path}/run={run}"
    fresh.write.mode("overwrite").parquet(own)
    return spark.read.schema(fresh.schema).parquet(own)


def numbered(rows: DataFrame, *order: str, name: str = "ord") -> DataFrame:
    """rows with their place, from 0, in a declared order. Partitions are numbered in parallel; only their sizes meet."""
    ranged = settle(rows.repartitionByRange(*[F.col(c) for c in order]).withColumn("__p", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy("__p").agg(F.count("*").alias("n"))
    ahead = sizes.select("__p", (F.sum("n").over(Window.orderBy("__p")) - F.col("n")).alias("__ahead"))
    within = F.row_number().over(Window.partitionBy("__p").orderBy(*order)) - 1
    return ranged.withColumn("__w", within).join(F.broadcast(ahead), "__p").withColumn(name, F.col("__ahead") + F.col("__w")).drop("__p", "__w", "__ahead")
