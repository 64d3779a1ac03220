"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliograph.scratch import discard, settle


def connected(edges: DataFrame) -> DataFrame:
    """node and root, the least node that is reachable, of every node of ``edges(a, b)``.

    Large and small stars in turn, until every node is linked to its root
    alone. Each step aggregates before it shuffles, so a node with many
    edges is no load on one task.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    e = settle(pairs.distinct(), "edges")
    while True:
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = settle(both.join(least, "u").filter("v >= u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select("v", "m").union(joined.select("u", "m")).toDF("u", "v").filter("v <= u").distinct()
        old, e = e, settle(small, "edges")
        discard(large)
        changes = e.withColumn("k", F.lit(1)).union(old.withColumn("k", F.lit(-1))).groupBy("u", "v").agg(F.sum("k").alias("k")).filter("k <> 0")
        same = changes.isEmpty()
        discard(old)
        if same:
            return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
