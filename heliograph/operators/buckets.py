"""An insert-only archive in hashed buckets, so that a batch reads little of it.

Rows lie in ``bucket=.../run=...`` folders by a hash of their key. Next to
them, ``marks`` has for each bucket and run a bitmap of the hashes of its
keys (a Bloom filter, sized for the run). Of a batch, only keys that some bitmap of
their bucket may hold are looked up, and for those only the key column of
their buckets is read; a batch of new keys reads bitmaps alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph.operators.archive import keep_first
from heliograph.scratch import discard, settle
from heliograph.sources.snapshots import exists

#: Buckets of an archive, fixed when it is begun; bits for each key, and places that a key sets.
BUCKETS, BITS, PLACES = 256, 12, 5
_MARKS = "n bigint, bits binary, bucket int, run string"


def _places(h: np.ndarray, size: int) -> np.ndarray:
    """PLACES bits of a bitmap of ``size`` bits for each hash."""
    h = h.view(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return ((h[:, None] + np.arange(PLACES, dtype=np.uint64) * step[:, None]) % np.uint64(size)).astype(np.int64)


def bitmap(hashes: np.ndarray) -> bytes:
    size = max(64, BITS * len(hashes) + 7 & ~7)
    bits = np.zeros(size, bool)
    bits[_places(hashes, size)] = True
    return np.packbits(bits).tobytes()


def may_hold(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    b = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
    return b[_places(hashes, len(b))].all(axis=1)


class BucketedArchive:
    """Rows of one schema under a path, each key once. ``append`` returns the rows that were new."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.key = spark, path, schema, key
        if exists(spark, f"{path}/about"):
            self.buckets = spark.read.schema("buckets int").json(f"{path}/about").first().buckets
        else:
            self.buckets = buckets
            spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").json(f"{path}/about")

    def _hashed(self, rows: DataFrame) -> DataFrame:
        h = F.xxhash64(F.col(self.key).cast("string"))
        return rows.withColumn("hash", h).withColumn("bucket", F.pmod("hash", F.lit(self.buckets)).cast("int"))

    def rows(self) -> DataFrame:
        """All rows of the archive."""
        if not exists(self.spark, f"{self.path}/rows"):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(f"{self.schema}, bucket int, run string").parquet(f"{self.path}/rows").drop("bucket", "run")

    def _suspects(self, fresh: DataFrame, run: str) -> DataFrame:
        """hash and bucket of keys that a bitmap of another run may hold."""
        marks = self.spark.read.schema(_MARKS).parquet(f"{self.path}/marks").filter(F.col("run") != run)
        touched = [r.bucket for r in fresh.select("bucket").distinct().collect()]  # at most as many as there are buckets
        asked = fresh.groupBy("bucket").agg(F.collect_list("hash").alias("hashes"))

        def looked_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for bucket, bits, hashes in zip(b["bucket"], b["bits"], b["hashes"]):
                    h = np.asarray(hashes, np.int64)
                    yield pd.DataFrame({"bucket": bucket, "hash": h[may_hold(bits, h)]})

        held = marks.filter(F.col("bucket").isin(touched)).join(asked, "bucket").select("bucket", "bits", "hashes")
        return held.mapInPandas(looked_up, "bucket int, hash bigint").distinct()

    def append(self, new: DataFrame, *order: str, run: str, counts: dict | None = None) -> DataFrame:
        """Add of ``new`` the first row, by ``order``, of each key that the archive lacks; rows without a key are left out.

        A call that is repeated under the same name of a run, as after a
        crash, compares with the other runs only and replaces its own rows.
        ``counts`` gets the buckets whose keys were read and those touched.
        """
        fresh = settle(self._hashed(keep_first(new, self.key, *order)), "fresh")
        buckets: list[int] = []
        found = fresh
        if exists(self.spark, f"{self.path}/marks"):
            suspects = settle(self._suspects(fresh, run), "suspects")
            buckets = [r.bucket for r in suspects.select("bucket").distinct().collect()]
            if buckets:
                known = self.spark.read.schema(f"{self.schema}, bucket int, run string").parquet(f"{self.path}/rows")
                known = known.filter(F.col("bucket").isin(buckets) & (F.col("run") != run)).select(self.key)
                doubtful = fresh.join(suspects, ["bucket", "hash"], "left_semi").join(known, self.key, "left_semi").select(self.key)
                found = fresh.join(doubtful, self.key, "left_anti")
        if counts is not None:
            counts |= {"read": len(buckets), "touched": fresh.select("bucket").distinct().count()}
        found = settle(found, "found")
        names = [f.name for f in self.spark.createDataFrame([], self.schema).schema.fields]
        dealt = found.withColumn("run", F.lit(run)).repartition("bucket")
        dynamic = {"partitionOverwriteMode": "dynamic"}
        self._clear(run)
        dealt.select(*names, "bucket", "run").write.mode("overwrite").options(**dynamic).partitionBy("bucket", "run").parquet(f"{self.path}/rows")
        marks = found.groupBy("bucket").agg(F.collect_list("hash").alias("hashes")).mapInPandas(_marked, "n bigint, bits binary, bucket int")
        marks.withColumn("run", F.lit(run)).write.mode("overwrite").options(**dynamic).partitionBy("bucket", "run").parquet(f"{self.path}/marks")
        discard(fresh)
        return found.select(*names)

    def _clear(self, run: str) -> None:
        """Removes what an earlier call of this run may have left in any bucket."""
        base = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = base.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for kind in ("rows", "marks"):
            for b in range(self.buckets):
                p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/bucket={b}/run={run}")
                if fs.exists(p):
                    fs.delete(p, True)


def _marked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame({"n": b["hashes"].map(len), "bits": [bitmap(np.asarray(h, np.int64)) for h in b["hashes"]], "bucket": b["bucket"]})
