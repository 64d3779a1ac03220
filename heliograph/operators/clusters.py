"""Density clusters over any number of rows: a spanning tree by Boruvka's rounds and the leaves of its condensed tree."""

from __future__ import annotations

from functools import partial, reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliograph.functions.vectors import doubles
from heliograph.operators import blocks, boxes
from heliograph.operators.graph import connected
from heliograph.scratch import discard, settle

#: Neighbours of each row that are known from the start; edges of the tree that one task takes at a time.
NEAR, EDGES = 10, 1 << 16
#: Tasks that the pieces of a range of edges are dealt to.
TASKS = 64
_INF = float("inf")


def _pivot_bounds(batches, pivots, groups: np.ndarray):
    """For each row, how far the nearest pivot of another group is."""
    for b in batches:
        if len(b):
            d = blocks._distances(np.stack(b["v"].to_numpy()), pivots.value)
            d[b["g"].to_numpy()[:, None] == groups[None]] = np.inf
            yield pd.DataFrame({"g": b["g"], "far": d.min(1) * (1 + 1e-9) + 1e-9})


def roots_of(chosen: DataFrame) -> DataFrame:
    """g and root of components that chose each other, from ``chosen(g, h)``: each follows its choice until none is left to follow.

    Choices are least edges, so they make no ring but that of two that chose
    each other; the lower one of these is the root, or one without a choice.
    """
    back = chosen.select(F.col("g").alias("h"), F.col("h").alias("g"), F.lit(True).alias("mutual"))
    to = chosen.join(back, ["g", "h"], "left").select("g", F.when(F.col("mutual") & (F.col("g") < F.col("h")), F.col("g")).otherwise(F.col("h")).alias("root"))
    to = settle(to, "to")
    while True:
        next_ = to
        for _ in range(2):  # two hops at a time
            step = to.select(F.col("g").alias("root"), F.col("root").alias("next"))
            next_ = next_.join(step, "root", "left").select("g", F.coalesce("next", "root").alias("root"))
        old, to = to, settle(next_, "to")
        moved = to.join(old.withColumnRenamed("root", "was"), "g").filter("root <> was").isEmpty()
        discard(old)
        if moved:
            return to


def spanning_tree(points: DataFrame, near: int = NEAR, size: int = blocks.BLOCK, each: int = blocks.PER_PIVOT) -> DataFrame:
    """a, b, d: the edges of a minimum spanning tree of ``points(id, v)`` by Euclidean distance, a < b; of equal trees the one with the least (d, a, b).

    Each round joins every component but the largest to another by its
    least outgoing edge, so their number halves at least. Most of these
    edges are among the ``near`` nearest neighbours, found once. Where a row
    has all of these in its own component, and they are nearer than the
    component's best edge so far, rows of other components are searched
    within that bound. Ids are distinct and vectors too. In few dimensions
    rows are searched by boxes, else by pairs of blocks.
    """
    inf = F.lit(_INF).alias("tau")
    rows = points.select(F.col("id").cast("bigint").alias("id"), doubles(F.col("v")).alias("v"))
    rows = settle(rows.select("id", "v", F.col("id").alias("g"), inf), "points")
    spark = rows.sparkSession
    ids, pivots = blocks.pivots_of(rows, each=each)
    first = rows.select(F.size("v").alias("n")).first()
    boxed = first is not None and first.n <= boxes.DIMENSIONS
    held = (boxes.Boxes(rows, min(size, boxes.LEAF)) if boxed else blocks.Blocks(rows, pivots, size)) if ids else None
    close = held.nearest(near) if boxed else blocks.nearest(rows, rows, near, size, each)
    listed = settle(close.groupBy("id", "other").agg(F.min("d").alias("d")), "listed")
    comp = settle(rows.select("id", "g"), "comp")
    tree = []
    while True:
        sizes = comp.groupBy("g").agg(F.count("*").alias("n"))
        most = sizes.agg(F.max_by("g", F.struct("n", "g")).alias("g"), F.count("*").alias("n")).first()
        if most.n <= 1:
            break
        named = listed.join(comp, "id").join(comp.select(F.col("id").alias("other"), F.col("g").alias("h")), "other")
        edge = F.struct("d", F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"), "h")
        by_row = settle(named.groupBy("id", "g").agg(F.min(F.when(F.col("g") != F.col("h"), edge)).alias("best"), F.max("d").alias("reach")), "by_row")
        best = by_row.filter("best is not null").groupBy("g").agg(F.min("best").alias("best"))
        # The components of the pivots, which are few, bound how far another component can be.
        of = {r.id: r.g for r in comp.filter(F.col("id").isin(ids)).collect()}
        every = held.rows.drop("g").join(comp, "id")
        inside = every.filter(F.col("g") != most.g)
        far = inside.select("v", "g").mapInPandas(partial(_pivot_bounds, pivots=pivots, groups=np.array([of[i] for i in ids])), "g long, far double").groupBy("g").agg(F.min("far").alias("far"))
        bound = far.join(best, "g", "left").select("g", F.least("far", F.coalesce("best.d", F.lit(_INF))).alias("bound"))
        # Rows beyond the listed ones are farther than the last of these.
        asked = inside.join(by_row.select("id", "best", "reach"), "id", "left").filter("best is null").join(bound, "g").filter(F.coalesce("reach", F.lit(-1.0)) < F.col("bound"))
        asked = settle(asked.select("id", "v", "g", F.col("bound").alias("tau"), "block"), "asked")
        found = best.filter(F.col("g") != most.g)
        pairs = None if boxed else settle(blocks.pairs_within(asked, held, pivots), "pairs")
        if not (asked if boxed else pairs).isEmpty():
            there = every.select("id", "v", "g", "block")
            more = held.within(asked, there) if boxed else blocks.compared(asked, there, pairs, 1)
            more = more.join(asked.select("id", "g"), "id").join(comp.select(F.col("id").alias("other"), F.col("g").alias("h")), "other")
            found = found.unionByName(more.groupBy("g").agg(F.min(edge).alias("best")))
        chosen = settle(found.groupBy("g").agg(F.min("best").alias("e")).select("g", "e.*"), "chosen")
        tree.append(chosen.select("a", "b", "d").distinct())
        roots = roots_of(chosen.select("g", "h"))
        old, comp = comp, settle(comp.join(roots, "g", "left").select("id", F.coalesce("root", "g").alias("g")), "comp")
        discard(old, by_row, asked, roots, *([] if boxed else [pairs]))
    discard(comp, listed, rows)
    return reduce(DataFrame.unionByName, tree) if tree else spark.createDataFrame([], "a long, b long, d double")


def merge(edges: pd.DataFrame, nodes: pd.DataFrame, least: int) -> pd.DataFrame:
    """What ``edges(a, b, d, x, y)`` do, the shortest first, to ``nodes(node, size, state)``: node, onto, size, state, leaf.

    A node is small, with fewer than ``least`` rows, whole, if no two sides
    that large were ever joined in it, or split. Two nodes that large make a
    split one; of these, whole ones are leaves then, named by their least
    node. Else the smaller goes into the larger.
    """
    at = {n: i for i, n in enumerate(nodes["node"].tolist())}
    above, size, state, leaf = list(range(len(at))), nodes["size"].tolist(), nodes["state"].tolist(), [None] * len(at)
    members = [[i] for i in range(len(at))]
    names = nodes["node"].tolist()

    def root(i: int) -> int:
        while above[i] != i:
            above[i] = i = above[above[i]]
        return i

    for x, y in edges.sort_values(["d", "a", "b"])[["x", "y"]].itertuples(index=False):
        x, y = root(at[x]), root(at[y])
        if size[x] >= least and size[y] >= least:
            for z in (x, y):
                if state[z] == "whole":
                    name = min(names[i] for i in members[z])
                    for i in members[z]:
                        leaf[i] = name
            kind = "split"
        else:
            large = x if size[x] >= size[y] else y
            kind = state[large] if size[large] >= least else "whole" if size[x] + size[y] >= least else "small"
        if len(members[x]) < len(members[y]):
            x, y = y, x
        above[y] = x
        members[x] += members[y]
        members[y] = []
        size[x], state[x] = size[x] + size[y], kind
    top = [root(i) for i in range(len(at))]
    onto = [min(names[j] for j in members[t]) for t in range(len(at)) if above[t] == t]
    named = dict(zip([t for t in range(len(at)) if above[t] == t], onto))
    return pd.DataFrame({"node": names, "onto": [named[t] for t in top], "size": [size[t] for t in top], "state": [state[t] for t in top], "leaf": pd.array(leaf, dtype="Int64")})


def leaves(tree: DataFrame, points: DataFrame, least: int, at_once: int = EDGES) -> DataFrame:
    """id and leaf of ``points(id, n)``, of which n rows are at that place: the least id of the leaf cluster, null for noise.

    Edges are taken in ranges of length, each of about ``at_once`` of them,
    and within a range by connected piece, whole pieces dealt to TASKS groups:
    there are nearly as many pieces as edges among the shortest.
    """
    n = tree.count()
    parts = -(-n // at_once)
    cuts = tree.approxQuantile("d", [k / parts for k in range(1, parts)], 1 / (8 * parts)) if parts > 1 else []
    kind = F.when(F.col("size") >= least, "whole").otherwise("small")
    state = settle(points.select("id", F.col("id").cast("bigint").alias("node"), F.col("n").alias("size")).withColumn("state", kind).withColumn("leaf", F.lit(None).cast("bigint")), "state")
    low = None
    for high in [*sorted(set(cuts)), None]:
        part = tree
        part = part if low is None else part.filter(F.col("d") > low)
        part = part if high is None else part.filter(F.col("d") <= high)
        low = high
        ends = state.select("id", "node")
        part = part.join(ends.select(F.col("id").alias("a"), F.col("node").alias("x")), "a").join(ends.select(F.col("id").alias("b"), F.col("node").alias("y")), "b")
        part = settle(part.select("a", "b", "d", "x", "y"), "part")
        if cuts:
            roots = connected(part.select(F.col("x").alias("a"), F.col("y").alias("b")))
            roots = settle(roots.select("node", F.pmod(F.xxhash64("root"), F.lit(TASKS)).alias("root")), "groups")
        else:  # all that a task takes
            roots = state.select("node", F.lit(0).cast("bigint").alias("root"))
        pieces = part.join(roots.select(F.col("node").alias("x"), F.col("root").alias("piece")), "x")
        nodes = state.groupBy("node").agg(F.first("size").alias("size"), F.first("state").alias("state")).join(roots, "node").select("node", "size", "state", F.col("root").alias("piece"))
        merged = pieces.groupBy("piece").cogroup(nodes.groupBy("piece")).applyInPandas(lambda e, v: merge(e, v, least), "node long, onto long, size long, state string, leaf long")
        merged = settle(merged, "merged")
        after = state.join(merged.select("node", "onto", F.col("size").alias("size2"), F.col("state").alias("state2"), F.col("leaf").alias("leaf2")), "node", "left")
        after = after.select("id", F.coalesce("onto", "node").alias("node"), F.coalesce("size2", "size").alias("size"), F.coalesce("state2", "state").alias("state"), F.coalesce("leaf", "leaf2").alias("leaf"))
        old, state = state, settle(after, "state")
        discard(old, part, roots, merged)
    return state.select("id", "leaf")


def density_clusters(vectors: DataFrame, least: int | None = None, few: int = 12, size: int = blocks.BLOCK, each: int = blocks.PER_PIVOT, at_once: int = EDGES) -> DataFrame:
    """id and cluster of ``vectors(id, v)``; fewer than ``few`` rows are one cluster; -1 is noise.

    With one neighbour asked for, core distances are 0 and mutual
    reachability is plain distance. Going down the single-linkage tree, a
    split makes two new clusters if both sides have ``least`` rows (a
    thirtieth of all and 6, if not told); else the smaller side falls out.
    Clusters that never split are the leaves, numbered by their least id;
    there are at most one for each ``least`` rows, and only leaves are
    numbered in one task. Equal vectors are one place; rows without a vector
    are left out.
    """
    rows = vectors.filter("v is not null").select("id", doubles(F.col("v")).alias("v"))
    n = rows.count()
    kind = dict(vectors.dtypes)["id"]
    if n < few:
        return rows.select("id", F.lit(0).alias("cluster"))
    least = least or max(6, n // 30)
    at = settle(rows.groupBy("v").agg(F.min(F.col("id").cast("bigint")).alias("place"), F.count("*").alias("n")), "places")
    points = at.select(F.col("place").alias("id"), "v")
    tree = settle(spanning_tree(points, size=size, each=each), "tree")
    found = leaves(tree, at.select(F.col("place").alias("id"), "n"), least, at_once)
    number = settle(found.filter("leaf is not null").select("leaf").distinct(), "numbers").selectExpr("leaf", "cast(row_number() over (order by leaf) - 1 as int) as cluster")
    labels = found.join(number, "leaf", "left").select(F.col("id").alias("place"), F.coalesce("cluster", F.lit(-1)).alias("cluster"))
    return rows.join(at.select("v", "place"), "v").join(labels, "place").select(F.col("id").cast(kind).alias("id"), "cluster")
