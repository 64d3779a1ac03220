"""Streams whose batches are written down as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from heliograph.streaming.revisions import ROCKS


def batches_to(stream: DataFrame, folder: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Starts a query over all that is there now; each batch is one folder of ``folder``, replaced if the batch is run again."""

    def step(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    spark = stream.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKS)
    try:
        return stream.writeStream.outputMode(mode).foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def read_batches(spark: SparkSession, folder: str, schema: str, last: bool = False) -> DataFrame:
    """All rows that batches_to() wrote; with ``last`` those of the last batch, which has the whole result in complete mode."""
    found = spark.read.schema(f"{schema}, batch bigint").parquet(folder)
    if last:
        newest = found.selectExpr("max(batch) as n").first().n
        found = found.filter(found.batch == newest) if newest is not None else found
    return found.drop("batch")
