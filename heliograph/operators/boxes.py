"""Exact nearest rows of few dimensions: boxes of a tree of medians, each row sent only to boxes that its bound reaches.

The tree is fitted on a bounded sample, which only decides how rows are
dealt; boxes are measured over all rows. A row is first compared with its own
box, which bounds how far its answer can be; then it goes, alone and not with
its box, to the other boxes that near. In few dimensions these are few, and
their number doesn't grow with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliograph.operators.blocks import _FOUND, _matrix, _nearest
from heliograph.scratch import discard, settle

#: Rows of a box, at most about twice so many; rows of the sample for a box, and in all; queries of a task's group; dimensions from which on boxes leave little out.
LEAF, SAMPLED, MOST_SAMPLED, QUERIES, DIMENSIONS = 1024, 32, 1 << 17, 4096, 8


def medians(x: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The dimension and the cut of each inner node of a tree of that depth: the median in the widest dimension."""
    dim, cut = np.zeros(2**depth - 1, int), np.zeros(2**depth - 1)
    members = {0: np.arange(len(x))}
    for i in range(len(dim)):
        own = members.pop(i)
        if len(own):
            dim[i] = np.ptp(x[own], axis=0).argmax()
            cut[i] = np.median(x[own, dim[i]])
        right = x[own, dim[i]] > cut[i]
        members[2 * i + 1], members[2 * i + 2] = own[~right], own[right]
    return dim, cut


def _leaves(batches: Iterator[pd.DataFrame], shared, depth: int) -> Iterator[pd.DataFrame]:
    dim, cut = shared.value
    for b in batches:
        if len(b):
            x, at = _matrix(b["v"]), np.zeros(len(b), int)
            for _ in range(depth):
                at = 2 * at + 1 + (x[np.arange(len(x)), dim[at]] > cut[at])
            yield b.assign(leaf=at - 2**depth + 1)


def _sides(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        if len(b):
            b = b.sort_values("block")
            x, (block, at) = _matrix(b["v"]), np.unique(b["block"].to_numpy(), return_index=True)
            yield pd.DataFrame({"block": block, "lo": list(np.minimum.reduceat(x, at)), "hi": list(np.maximum.reduceat(x, at))})


def _joined(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"block": [key[0]], "lo": [_matrix(parts["lo"]).min(0)], "hi": [_matrix(parts["hi"]).max(0)]})


def _sent(batches: Iterator[pd.DataFrame], shared, group) -> Iterator[pd.DataFrame]:
    """Each query once for each box that it reaches, with the box as ``to``; not to its own, if it has one, nor to one of its group alone."""
    block, lo, hi = shared.value
    only = group.value if group is not None else np.full(len(block), -1)
    known = group is not None
    for b in batches:
        for i in range(0, len(b), 512):
            part = b.iloc[i : i + 512]
            x, d2 = _matrix(part["v"]), 0.0
            for j in range(x.shape[1]):
                d2 = d2 + np.square(np.maximum(np.maximum(lo[None, :, j] - x[:, j, None], x[:, j, None] - hi[None, :, j]), 0))
            near = np.sqrt(d2) <= part["tau"].to_numpy()[:, None] * (1 + 1e-9) + 1e-9
            near &= part["g"].to_numpy()[:, None] != only[None] if known else part["block"].to_numpy()[:, None] != block[None]
            row, to = np.nonzero(near)
            yield part[["id", "v", "g", "tau"]].iloc[row].assign(to=block[to])


class Boxes:
    """``rows``: id, v and block of ``rows(id, v)``, whose ids and vectors are distinct."""

    def __init__(self, rows: DataFrame, size: int = LEAF):
        spark, n = rows.sparkSession, rows.count()
        depth = max(0, int(np.ceil(np.log2(max(1, min(n / size, MOST_SAMPLED // SAMPLED))))))
        few = rows.select("v").orderBy(F.xxhash64("id"), "id").limit(SAMPLED << depth).collect()
        tree = spark.sparkContext.broadcast(medians(np.array([r.v for r in few], np.float64).reshape(len(few), -1), depth))
        placed = settle(rows.select("id", "v").mapInPandas(partial(_leaves, shared=tree, depth=depth), "id long, v array<double>, leaf long"), "placed")
        counts = placed.groupBy("leaf").agg(F.count("*").alias("n")).orderBy("leaf").toPandas()  # a row a leaf
        counts["shares"] = -(-counts["n"] // (2 * size))
        counts["start"] = counts["shares"].cumsum() - counts["shares"]
        cuts = spark.createDataFrame(counts[["leaf", "shares", "start"]], "leaf long, shares long, start long")
        block = (F.col("start") + F.pmod(F.xxhash64("id"), "shares")).alias("block")
        self.rows = settle(placed.join(F.broadcast(cuts), "leaf").select("id", "v", block), "boxes")
        discard(placed)
        sides = "block long, lo array<double>, hi array<double>"
        found = self.rows.mapInPandas(_sides, sides).groupBy("block").applyInPandas(_joined, sides).orderBy("block").toPandas()
        self.block = found["block"].to_numpy()
        self.shared = spark.sparkContext.broadcast((self.block, _matrix(found["lo"]), _matrix(found["hi"])))

    def nearest(self, k: int) -> DataFrame:
        """What blocks.nearest() finds for all rows, each a group of its own."""
        own = self.rows.select("id", "v", F.col("id").alias("g"), F.lit(float("inf")).alias("tau"), "block")
        near = own.groupBy("block").applyInPandas(lambda key, x: _nearest(key, x, x, k), _FOUND)
        near = settle(near, "near")
        bound = near.groupBy("id").agg(F.slice(F.array_sort(F.collect_list("d")), 1, k).alias("d")).filter(F.size("d") == k).select("id", F.element_at("d", -1).alias("found"))
        asked = own.join(bound, "id", "left").withColumn("tau", F.coalesce("found", "tau")).drop("found")
        return near.unionByName(self._compared(asked, own, k))

    def within(self, asked: DataFrame, rows: DataFrame, k: int = 1) -> DataFrame:
        """What blocks.compared() finds for ``asked(id, v, g, tau)`` among ``rows(id, v, g, block)`` within tau: the k nearest of each box."""
        alone = rows.groupBy("block").agg(F.min("g").alias("a"), F.max("g").alias("z")).toPandas().set_index("block").reindex(self.block)
        only = np.where(alone["a"] == alone["z"], alone["a"], -1).astype(np.int64)
        return self._compared(asked.withColumn("block", F.lit(-1).cast("bigint")), rows, k, rows.sparkSession.sparkContext.broadcast(only))

    def _compared(self, asked: DataFrame, rows: DataFrame, k: int, group=None) -> DataFrame:
        sent = asked.select("id", "v", "g", "tau", "block").mapInPandas(partial(_sent, shared=self.shared, group=group), "id long, v array<double>, g long, tau double, to long")
        sent = settle(sent, "sent")
        shares = sent.groupBy("to").agg(F.ceil(F.count("*") / QUERIES).alias("shares"))  # a row a box
        left = sent.join(F.broadcast(shares), "to").withColumn("share", F.pmod(F.xxhash64("id"), "shares"))
        right = rows.withColumnRenamed("block", "to").join(F.broadcast(shares), "to").withColumn("share", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shares") - 1)))
        right = right.select("to", "share", "id", "v", "g")
        return left.groupBy("to", "share").cogroup(right.groupBy("to", "share")).applyInPandas(partial(_nearest, k=k), _FOUND)
