"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from heliograph.llm.common import discard, settle, text_of

WORDS = r"[^\x20\x09-\x0D]+"
SOURCE_WEIGHTS, FACTOR, CAP = (3, 1, 2), 1.5, 2.0
BUCKET_ROWS = 1024
#: The range of weights that doubles leave room for: 2 to the power of minus this up to 2 to the power of this.
POWERS = 60


def chance(doc_id: Column, text: Column, seed: int) -> Column:
    """A number above 0 and below 1, the same for the same id, text and seed."""
    digest = F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(text_of(text)), F.lit(str(seed))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def sampling_key(u: Column, weight: Column) -> Column:
    """An exponential key of rate ``weight``: the lower, the sooner a document is taken."""
    return -F.log(u) / weight


def source_targets(sources: DataFrame, weights: tuple[float, ...] = SOURCE_WEIGHTS, factor: float = FACTOR, cap: float = CAP) -> DataFrame:
    """The rows of ``sources(source, n_docs, source_size)`` with target.

    Sources by code point, null last, weigh ``weights`` in turn. They share
    factor times all sizes by weight; none gets more than cap times its own
    size, and what is above goes to the others by weight. With sources in
    the order in which they fill up, one pass of prefix sums gives where
    that ends. One row per source is all that this orders.
    """
    n = len(weights)
    order = W.orderBy(F.col("source").asc_nulls_last())
    s = sources.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % n + 1).cast("int")))
    fill = W.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    every = W.partitionBy()
    size = F.col("source_size").cast("double")
    s = s.withColumns(
        {
            "total": F.sum(size).over(every),
            "before": F.coalesce(F.sum(size).over(fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)),
            "w_left": F.sum("w").over(fill.rowsBetween(0, W.unboundedFollowing)),
        }
    )
    s = s.withColumn("full", (factor * F.col("total") - cap * F.col("before")) * F.col("w") >= cap * size * F.col("w_left"))
    s = s.withColumns({"c": F.coalesce(F.sum(F.when(F.col("full"), size)).over(every), F.lit(0.0)), "open_w": F.sum(F.when(~F.col("full"), F.col("w"))).over(every)})
    target = F.when(F.col("full"), cap * size).otherwise((factor * F.col("total") - cap * F.col("c")) * F.col("w") / F.col("open_w"))
    return s.select("source", "n_docs", "source_size", target.alias("target"))


def mix(docs: DataFrame, quality: DataFrame | None = None, weights: tuple[float, ...] = SOURCE_WEIGHTS, factor: float = FACTOR, cap: float = CAP, seed: int = 17, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, source, size, source_size, target and taken of every row of ``docs(doc_id, text, source)``.

    A source takes its documents whole as often as its target holds its
    size. The rest of the target goes to documents in the order of their
    keys, whose rate is the weight in ``quality(doc_id, weight)`` (1 where
    it has none, the largest where it has several), up to the document
    whose middle lies beyond it. So what is taken is within half a document
    of the target. The order within a source comes from buckets of keys:
    sizes are summed per bucket, so no source is sorted in one task. Buckets
    are cut by the distribution of keys that the source's weights give, so
    they are even whatever the weights are.

    A null text has size 0, and a size of 0 is taken 0 times; a very long
    text is counted whole. A null source is a source. Rows of the same id
    and text are interchangeable; keys that tie are ordered by id and size.
    A weight that isn't positive counts as the least there is. Other columns
    are ignored; an empty table gives no rows.
    """
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORDS)), F.lit(0)).cast("long")
    # Texts end here: the join with the weights shuffles numbers only.
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"), chance(F.col("doc_id"), F.col("text"), seed).alias("u"))
    if quality is None:
        rows = rows.withColumn("weight", F.lit(1.0))
    else:
        of = quality.groupBy("doc_id").agg(F.max("weight").cast("double").alias("weight"))
        least, most = F.lit(2.0**-POWERS), F.lit(2.0**POWERS)
        rows = rows.join(of, "doc_id", "left").withColumn("weight", F.greatest(least, F.least(most, F.coalesce(F.nanvl("weight", least), F.lit(1.0)))))
    rows = settle(rows.select("doc_id", "source", "size", F.ceil(F.log2("weight")).cast("int").alias("power"), sampling_key(F.col("u"), F.col("weight")).alias("k")), "sized")
    # Of each source and power of two, how many documents weigh up to that.
    powers = settle(rows.groupBy("source", "power").agg(F.count("*").alias("n"), F.sum("size").alias("size")), "powers")
    sources = powers.groupBy("source").agg(F.sum("n").alias("n_docs"), F.sum("size").alias("source_size"), F.array_sort(F.collect_list(F.struct("power", "n"))).alias("powers"))
    targets = source_targets(sources.select("source", "n_docs", "source_size"), weights, factor, cap)
    name = lambda t: t.withColumns({"_null": F.col("source").isNull(), "_name": F.coalesce("source", F.lit(""))}).drop("source")
    sources = name(targets).join(name(sources.select("source", "powers")), ["_null", "_name"])
    sources = sources.withColumns(
        {
            "epochs": F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-12)).otherwise(0),
            "buckets": F.ceil(F.col("n_docs") / bucket_rows),
        }
    ).withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    sources = settle(sources, "sources")
    discard(powers)
    rows = rows.withColumns({"_null": F.col("source").isNull(), "_name": F.coalesce("source", F.lit(""))}).join(sources, ["_null", "_name"])
    # The share of the source's keys below this one, as its weights let expect.
    share = F.aggregate("powers", F.lit(0.0), lambda sum_, x: sum_ - x["n"] / F.col("n_docs") * F.expm1(-F.col("k") * F.pow(F.lit(2.0), x["power"].cast("double"))))
    rows = rows.withColumn("bucket", F.least(F.floor(share * F.col("buckets")), F.col("buckets") - 1)).drop("powers", "power")
    place = ["_null", "_name", "bucket"]
    sums = rows.groupBy(*place).agg(F.sum("size").alias("in_bucket"))
    sums = sums.withColumn("ahead", F.sum("in_bucket").over(W.partitionBy("_null", "_name").orderBy("bucket")) - F.col("in_bucket")).drop("in_bucket")
    rows = rows.join(sums, place)
    within = W.partitionBy(*place).orderBy("k", "doc_id", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
    middle = F.col("ahead") + F.sum("size").over(within) - F.col("size") / 2
    taken = F.col("epochs") * F.col("size") + F.when((F.col("budget") > 0) & (middle <= F.col("budget")), F.col("size")).otherwise(0)
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))
