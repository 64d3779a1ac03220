"""Exact nearest rows by an exchange of block pairs.

Rows are dealt to the nearest of a bounded number of pivots and, within a
pivot's part, to rings by their distance from it; a ring or a share of it
that fits one task is a block. Queries get blocks of their own in the same
way. Each query is first compared with the block of rows that lies nearest
to its own, which bounds how far its answer can be. By the triangle
inequality a row can only be that near if its ring is: |d(query, pivot) -
d(row, pivot)| is no more than their distance. Only pairs of blocks that may
hold such rows are exchanged, by key; neither side is collected.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heliograph.scratch import discard, settle

#: Rows of a block, at most twice so many; rows for a pivot; pivots, which are broadcast; rings of a part.
BLOCK, PER_PIVOT, PIVOTS, RINGS = 4096, 2048, 512, 64
#: Queries that are compared with a block at once.
AT_ONCE = 512
_ROW = "id long, v array<double>, g long, tau double, part int, r double"


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64, copy=False)


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(np.square(x).sum(1)[:, None] + np.square(p).sum(1)[None] - 2 * x @ p.T, 0))


def _placed(batches: Iterator[pd.DataFrame], pivots) -> Iterator[pd.DataFrame]:
    """The nearest pivot of each row and how far it is."""
    for b in batches:
        if len(b):
            d = _distances(_matrix(b["v"]), pivots.value)
            part = d.argmin(1)
            yield b.assign(part=part.astype(np.int32), r=d[np.arange(len(b)), part])


class Blocks:
    """Rows ``(id, v, g, tau)`` in blocks: ``rows`` with part, r and block, and ``table`` with block, part, n, and the ring's lo and hi.

    Without ``rings``, as for few queries, a part is cut by hash alone.
    """

    def __init__(self, rows: DataFrame, pivots, size: int = BLOCK, rings: bool = True):
        placed = settle(rows.mapInPandas(partial(_placed, pivots=pivots), _ROW), "placed")
        # A row for each part at most, and later one for each ring of a part: bounded by PIVOTS and RINGS.
        widest = placed.groupBy("part").agg(F.max("r").alias("most"), F.count("*").alias("n"))
        if rings:
            ring = F.when(F.col("most") > 0, F.least(F.floor(F.col("r") / F.col("most") * RINGS), F.lit(RINGS - 1))).otherwise(F.lit(0)).cast("int").alias("ring")
            ringed = placed.join(F.broadcast(widest.drop("n")), "part").withColumn("ring", ring).drop("most")
            sizes = ringed.groupBy("part", "ring").agg(F.count("*").alias("n"))
            before = F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("ring").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
            cuts = sizes.select("part", "ring", F.floor(before / size).alias("slot"), F.ceil(F.col("n") / size).alias("shares"))
        else:
            ringed = placed.withColumn("ring", F.lit(0))
            cuts = widest.select("part", F.lit(0).alias("ring"), F.lit(0).alias("slot"), F.ceil(F.col("n") / size).alias("shares"))
        block = F.xxhash64("part", "slot", F.pmod(F.xxhash64("id"), "shares")).alias("block")
        self.rows = settle(ringed.join(F.broadcast(cuts), ["part", "ring"]).select("id", "v", "g", "tau", "part", "r", block), "blocks")
        self.table = self.rows.groupBy("block", "part").agg(F.count("*").alias("n"), F.min("r").alias("lo"), F.max("r").alias("hi"))
        if rings:
            self.table = settle(self.table, "table")
        discard(placed)


def _nearest(pair: tuple, left: pd.DataFrame, right: pd.DataFrame, k: int) -> pd.DataFrame:
    """For each query on the left, the k nearest rows on the right within its bound and of another group; ties by id."""
    if not len(left) or not len(right):
        return pd.DataFrame({"id": [], "other": [], "d": [], "dot": []}).astype({"id": "int64", "other": "int64", "d": float, "dot": float})
    q, x = _matrix(left["v"]), _matrix(right["v"])
    qq, xx = np.square(q).sum(1), np.square(x).sum(1)
    ids, own, g, h = left["id"].to_numpy(), right["id"].to_numpy(), left["g"].to_numpy(), right["g"].to_numpy()
    slack = 1e-12 * (qq + xx.max())  # of squares by matrix products
    most = np.square(left["tau"].to_numpy()) * (1 + 1e-9) + slack
    out = []
    for i in range(0, len(q), AT_ONCE):
        part = slice(i, i + AT_ONCE)
        dot = q[part] @ x.T
        d2 = qq[part, None] + xx[None] - 2 * dot
        d2[g[part, None] == h[None]] = np.inf
        n = min(k, len(x)) - 1
        edge = np.minimum(np.partition(d2, n, axis=1)[:, n] + 2 * slack[part], most[part])
        a, b = np.nonzero((d2 <= edge[:, None]) & (d2 < np.inf))
        # The few that may be among the nearest are measured again, without cancellation.
        exact = np.sqrt(np.square(q[part][a] - x[b]).sum(1))
        order = np.lexsort((own[b], exact, a))
        a, b, exact = a[order], b[order], exact[order]
        rank = np.arange(len(a)) - np.searchsorted(a, a)
        # Ties with the last stay too, so that the final order can choose among them.
        last = np.full(len(q[part]), np.inf)
        last[a[rank == n]] = exact[rank == n]
        stay = exact <= last[a] * (1 + 1e-12)
        out.append(pd.DataFrame({"id": ids[part][a[stay]], "other": own[b[stay]], "d": exact[stay], "dot": dot[a[stay], b[stay]]}))
    return pd.concat(out)


_FOUND = "id long, other long, d double, dot double"


def compared(queries: DataFrame, rows: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """What _nearest() finds for each of ``pairs(x, y)`` of blocks of queries and of rows."""
    pairs = pairs.withColumn("pair", F.xxhash64("x", "y"))
    left = queries.join(pairs.select(F.col("x").alias("block"), "pair"), "block").select("pair", "id", "v", "g", "tau")
    right = rows.join(pairs.select(F.col("y").alias("block"), "pair"), "block").select(*(F.col(c).alias(c) for c in ("pair", "id", "v", "g")))
    return left.groupBy("pair").cogroup(right.groupBy("pair")).applyInPandas(partial(_nearest, k=k), _FOUND)


def _reaches(batches: Iterator[pd.DataFrame], pivots) -> Iterator[pd.DataFrame]:
    """For each block of queries and each pivot, the rings in which rows within the queries' bounds can lie."""
    for b in batches:
        if not len(b):
            continue
        d, tau = _distances(_matrix(b["v"]), pivots.value), b["tau"].to_numpy()[:, None] * (1 + 1e-9) + 1e-9
        block, at = np.unique(b["block"].to_numpy(), return_inverse=True)
        low, high = np.full((len(block), d.shape[1]), np.inf), np.full((len(block), d.shape[1]), -np.inf)
        np.minimum.at(low, at, d - tau)
        np.maximum.at(high, at, d + tau)
        x, part = (m.ravel() for m in np.meshgrid(np.arange(len(block)), np.arange(d.shape[1]), indexing="ij"))
        yield pd.DataFrame({"x": block[x], "part": part.astype(np.int32), "low": low.ravel(), "high": high.ravel()})


def pivots_of(rows: DataFrame, most: int = PIVOTS, each: int = PER_PIVOT, n: int | None = None):
    """(ids, vectors as a broadcast) of up to ``most`` of ``rows(id, v)``, those of least hash, one for so many rows."""
    n = rows.count() if n is None else n
    few = rows.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(max(1, min(most, n // each))).collect()
    v = np.array([r.v for r in few], np.float64) if few else np.zeros((0, 0))
    return [r.id for r in few], rows.sparkSession.sparkContext.broadcast(v)


def pairs_within(asked: DataFrame, held: Blocks, pivots) -> DataFrame:
    """x, y: the pairs of blocks in which a row of ``held`` can lie within the tau of one of ``asked(id, v, tau, block)``."""
    reach = asked.mapInPandas(partial(_reaches, pivots=pivots), "x long, part int, low double, high double").groupBy("x", "part").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return reach.join(held.table, "part").filter((F.col("hi") >= F.col("low")) & (F.col("lo") <= F.col("high"))).select("x", F.col("block").alias("y"))


def nearest(queries: DataFrame, rows: DataFrame, k: int, size: int = BLOCK, each: int = PER_PIVOT, counts: dict | None = None, n: int | None = None) -> DataFrame:
    """id, other, d and dot: for each of ``queries(id, v, g, tau)`` the k nearest of ``rows(id, v, g, tau)`` by Euclidean distance, with all ties.

    Rows of the query's own group g are left out, and so are rows farther
    than its tau, infinite if nothing is known. Vectors have one length and
    no nulls. ``counts`` gets the pairs of rows that were compared and that
    there are; ``n`` is the number of rows, if it is known.
    """
    n = rows.count() if n is None else n
    if n == 0:
        return rows.sparkSession.createDataFrame([], _FOUND)
    if n <= min(size, each):  # one block holds all rows, and nothing can be left out
        asked = rows if queries is rows else queries
        m = asked.count()
        asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(max(1, -(-m // size)))))
        if counts is not None:
            counts["compared"] = counts["pairs"] = m * n
        one = rows.withColumn("block", F.lit(0).cast("bigint"))
        return compared(asked, one, asked.select(F.col("block").alias("x")).distinct().withColumn("y", F.lit(0).cast("bigint")), k)
    ids, pivots = pivots_of(rows, each=each, n=n)
    held = Blocks(rows, pivots, size)
    asked = held if queries is rows else Blocks(queries, pivots, size, rings=False)
    # The block of the same part whose ring is nearest to that of the queries.
    x, y = asked.table.alias("x"), held.table.alias("y")
    gap = F.greatest(F.col("y.lo") - F.col("x.hi"), F.col("x.lo") - F.col("y.hi"), F.lit(0.0))
    same = (F.col("x.block") == F.col("y.block")).cast("int")
    first = x.join(y, F.col("x.part") == F.col("y.part")).groupBy(F.col("x.block").alias("x")).agg(F.min_by(F.col("y.block"), F.struct(gap, -same, -F.col("y.n"), F.col("y.block"))).alias("y"))
    first = settle(first, "first")
    near = settle(compared(asked.rows, held.rows, first, k), "near")
    bound = near.groupBy("id").agg(F.slice(F.array_sort(F.collect_list("d")), 1, k).alias("d")).filter(F.size("d") == k).select("id", F.element_at("d", -1).alias("found"))
    bounded = asked.rows.join(bound, "id", "left").withColumn("tau", F.least("tau", F.coalesce("found", F.lit(float("inf"))))).drop("found")
    n_x = asked.table.select(F.col("block").alias("x"), F.col("n").alias("n_x"))
    if asked is held:
        pairs = settle(pairs_within(bounded, held, pivots).join(first, ["x", "y"], "left_anti"), "pairs")
        found = near.unionByName(compared(bounded, held.rows, pairs, k))
    else:
        # Few queries of many parts go together, so that rows are sent once for as many queries as a block takes. Parts are few.
        parts = asked.table.groupBy("part").agg(F.sum("n").alias("n"))
        before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        slots = parts.select("part", F.floor(before / size).alias("slot"), F.ceil(F.col("n") / size).alias("shares"))
        wide = F.xxhash64("slot", F.pmod(F.xxhash64("id"), "shares"))
        bounded = settle(bounded.join(F.broadcast(slots), "part").withColumn("block", wide).drop("slot", "shares"), "bounded")
        n_x = bounded.groupBy(F.col("block").alias("x")).agg(F.count("*").alias("n_x"))
        pairs = settle(pairs_within(bounded, held, pivots), "pairs")
        found, first = compared(bounded, held.rows, pairs, k), pairs.limit(0)
    if counts is not None:
        n_y = held.table.select(F.col("block").alias("y"), F.col("n").alias("n_y"))
        done = pairs.union(first).join(n_x, "x").join(n_y, "y").agg(F.sum(F.col("n_x") * F.col("n_y")).alias("n")).first().n
        counts["compared"], counts["pairs"] = done or 0, (asked.table.agg(F.sum("n")).first()[0] or 0) * (held.table.agg(F.sum("n")).first()[0] or 0)
    return found
