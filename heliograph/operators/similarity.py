"""Nearest neighbours, isolation, tone and the tables built from them."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliograph.functions.dates import week_start
from heliograph.functions.numbers import clip, thirds
from heliograph.functions.quantiles import quantile
from heliograph.functions.vectors import doubles, dot, unit
from heliograph.operators import blocks
from heliograph.operators.archive import lacking
from heliograph.operators.encode import PieceEncoder, encoded

def neighbours(vectors: DataFrame, queries: DataFrame, k: int = 5, block: int = blocks.BLOCK, each: int = blocks.PER_PIVOT, counts: dict | None = None) -> DataFrame:
    """id, rank, other, sim: the k rows of ``vectors(id, v)`` most similar by dot product to each of ``queries(id, v)``.

    A row is not its own neighbour; ties, of similarities equal to twelve
    decimals, go to the lower id. Exact: with one more part that brings all
    rows to the length of the longest, the most similar are the nearest, and
    blocks too far away to hold them are left out. ``counts`` gets the pairs
    of rows compared and those there are.
    """
    made = lambda df: df.filter("v is not null").select(F.col("id").cast("bigint").alias("id"), doubles(F.col("v")).alias("v"))
    rows, square = made(vectors), dot(F.col("v"), F.col("v"))
    most = rows.agg(F.max(square).alias("hi"), F.min(square).alias("lo"), F.count("*").alias("n")).first()
    level = most.hi is None or most.lo >= most.hi * (1 - 1e-12)
    inf = F.lit(float("inf")).alias("tau")
    more = lambda df, last: df if level else df.withColumn("v", F.concat("v", F.array(last)))
    full = more(rows, F.sqrt(F.greatest(F.lit(most.hi) - square, F.lit(0.0)))).select("id", "v", F.col("id").alias("g"), inf)
    asked = full if level and queries is vectors else more(made(queries).dropDuplicates(["id"]), F.lit(0.0)).select("id", "v", F.col("id").alias("g"), inf)
    found = blocks.nearest(asked, full, k, block, each, counts, most.n)
    order = Window.partitionBy("id").orderBy(F.desc(F.round("dot", 12)), "other")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("id", "rank", "other", F.col("dot").alias("sim"))


def isolation(nearest: DataFrame) -> DataFrame:
    """id and iso = 1 - the highest similarity, from what neighbours() gives."""
    return nearest.filter("rank = 1").select("id", (1 - F.col("sim")).alias("iso"))


def most_isolated(isolated: DataFrame, k: int = 20) -> DataFrame:
    return isolated.orderBy(F.desc("iso"), "id").limit(k)


def neighbour_majority(nearest: DataFrame, labels: DataFrame) -> DataFrame:
    """id, label, majority and votes: the label that most neighbours have, ties to the lower one. An optional audit of labels."""
    other = labels.select(F.col("id").alias("other"), F.col("label").alias("theirs"))
    votes = nearest.join(other, "other").groupBy("id", "theirs").agg(F.count("*").alias("votes"))
    best = votes.groupBy("id").agg(F.max_by(F.struct("theirs", "votes"), F.struct("votes", -F.col("theirs"))).alias("b"))
    return best.join(labels, "id").select("id", "label", F.col("b.theirs").alias("majority"), F.col("b.votes").alias("votes"))


def centroid(vectors: DataFrame) -> list[float]:
    """Of a few anchors ``(v)``: the mean of their unit vectors, scaled to length 1. Vectors have fixed length, so this is one row."""
    each = vectors.select(F.posexplode(unit(F.col("v"))).alias("i", "x")).groupBy("i").agg(F.avg("x").alias("x"))
    m = np.array([r.x for r in each.orderBy("i").collect()])
    return (m / (np.linalg.norm(m) or 1.0)).tolist()


def tone(vectors: DataFrame, up: list[float], down: list[float]) -> DataFrame:
    """id and tone of ``vectors(id, v)``: how much nearer to ``up`` than to ``down``, less the median, over the 95th percentile of its size, within [-1, 1]."""
    literal = lambda v: F.array(*[F.lit(float(x)) for x in v])
    raw = vectors.select("id", (dot(F.col("v"), literal(up)) - dot(F.col("v"), literal(down))).alias("raw"))
    centred = raw.select("id", (F.col("raw") - F.lit(quantile(raw, "raw", 0.5))).alias("raw"))
    scale = quantile(centred.select(F.abs("raw").alias("size")), "size", 0.95) or 1.0
    return centred.select("id", clip(F.col("raw") / scale, -1.0, 1.0).alias("tone"))


def tone_heatmap(points: DataFrame, noise: Column | None = None) -> DataFrame:
    """c, week, m, n over ``points(c, d, tone)``: mean tone to three decimals per cluster and week, and with a null c per week over all.

    Tones are rounded before the mean. Noise counts in the weekly line but
    has no cells of its own.
    """
    rows = points.select("c", week_start(F.col("d")).alias("week"), thirds(F.col("tone")).alias("t"), (noise if noise is not None else F.lit(False)).alias("noise")).filter("week is not null")
    sets = rows.groupingSets([["c", "noise", "week"], ["week"]], "c", "noise", "week").agg(F.avg("t").alias("m"), F.count("*").alias("n"), F.grouping("c").alias("line"))
    return sets.filter("line = 1 or not noise").select(F.when(F.col("line") == 0, F.col("c")).alias("c"), "week", thirds(F.col("m")).alias("m"), "n")


def renumber(rows: DataFrame, cluster: str = "cluster", noise: int = -1) -> DataFrame:
    """cluster, id, size: ids from 0 by size, largest first, ties by the raw id; noise, if any, comes last. Clusters are few; only they are ordered."""
    sizes = rows.groupBy(cluster).agg(F.count("*").alias("size"))
    order = Window.orderBy(F.col(cluster) == noise, F.desc("size"), cluster)
    return sizes.select(F.col(cluster).alias("cluster"), (F.row_number().over(order) - 1).alias("id"), "size")


def palette(k: int) -> tuple[list[str], list[str]]:
    """k light and k dark colours, hues a golden angle apart."""

    def colour(i: int, s: float, l: float) -> str:  # noqa: E741
        h = i * 137.508 % 360
        f = lambda n: l - s * min(l, 1 - l) * max(-1, min((n + h / 30) % 12 - 3, 9 - (n + h / 30) % 12, 1))
        return "#" + "".join(f"{round(f(n) * 255):02x}" for n in (0, 8, 4))

    return [colour(i, 0.62, 0.46) for i in range(max(1, k))], [colour(i, 0.68, 0.62) for i in range(max(1, k))]


def embed_new(rows: DataFrame, cache: DataFrame, encode: Callable[[list[str]], np.ndarray] | None = None, key: str = "url", text: str = "text", load: Callable[[], Callable[[list[str]], np.ndarray]] = PieceEncoder) -> DataFrame:
    """key and unit vec of rows whose key the cache lacks, by ``encode`` or by what ``load`` makes once a worker; the least text of a key counts."""
    missing = lacking(rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(text).alias(text)), cache, key)
    found = missing.select(F.col(key).cast("string").alias(key), encoded(F.col(text), load if encode is None else lambda: encode).alias("vec"))
    return found.select(key, unit(F.col("vec")).cast("array<float>").alias("vec"))


def nearest_point(points: DataFrame, x: float, y: float, within: float = 13.0) -> DataFrame:
    """The row of ``points(ord, x, y)`` nearest to a place, if nearer than ``within``; ties to the lower ord."""
    d2 = (F.col("x") - x) * (F.col("x") - x) + (F.col("y") - y) * (F.col("y") - y)
    near = points.withColumn("d2", d2).filter(F.col("d2") < within * within)
    return near.agg(F.min_by(F.struct("ord", "x", "y", "d2"), F.struct("d2", "ord")).alias("r")).filter("r is not null").select("r.*")


def extents(points: DataFrame, padding: float = 0.08) -> DataFrame:
    """One row: the ranges of x and y, each widened by a share of its size, or of 1 if it has none."""
    m = points.agg(*[f(c).alias(f"{n}_{c}") for c in ("x", "y") for n, f in (("lo", F.min), ("hi", F.max))])
    pad = lambda c: padding * F.when(F.col(f"hi_{c}") == F.col(f"lo_{c}"), 1.0).otherwise(F.col(f"hi_{c}") - F.col(f"lo_{c}"))
    return m.select(*[(F.col(f"{n}_{c}") + s * pad(c)).alias(f"{n}_{c}") for c in ("x", "y") for n, s in (("lo", -1), ("hi", 1))])
