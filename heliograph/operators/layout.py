"""Latent-semantic layout, principal components, t-SNE and the layout of a neighbour graph.

Singular vectors and principal components are found over all rows in
Spark. t-SNE and the layout of a neighbour graph (UMAP) move all places at
once; so they lay out a sample of bounded size, in the driver, and every
other row is placed among its nearest landmarks by Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliograph.operators.blocks import nearest
from heliograph.operators.similarity import neighbours
from heliograph.scratch import discard, settle

#: Rows that are multiplied, and rows of products that are summed, at a time; bytes that the driver holds of the basis of singular vectors.
STRIP, MOST_HELD = 256, 64 << 20
#: Bytes of a matrix of terms by terms up to which it is made, the side of its tiles, partitions that hold them; entries of rows, and pairs of a row's terms, at a time.
MOST_SQUARE, TILE, TILED, ENTRIES, PAIRS = 256 << 20, 64, 24, 1 << 14, 1 << 17
#: Rows that t-SNE and the layout of a neighbour graph move.
LANDMARKS = 2000


def dimensions(n: int, terms: int, most: int = 50) -> int:
    return max(0, min(most, n - 1, terms - 1))


def leading(product: Callable[[np.ndarray], np.ndarray], m: int, k: int, tolerance: float = 1e-10, rounds: int = 300, seed: int = 0) -> np.ndarray:
    """The k leading eigenvectors, as columns, of a symmetric matrix of side m that is known by its ``product`` with a few columns only.

    A basis grows by the residuals of the pairs that have not settled, and is
    cut back to the best directions when it would take more than MOST_HELD
    bytes. Ends when every residual is within ``tolerance`` of the greatest
    eigenvalue.
    """
    width = min(m, k + 10)
    held = int(min(m, max(2 * width, min(6 * width, MOST_HELD // (16 * m)))))
    v = np.linalg.qr(np.random.default_rng(seed).normal(size=(m, width)))[0]
    g = product(v)
    for _ in range(rounds):
        t = v.T @ g
        value, y = np.linalg.eigh((t + t.T) / 2)
        value, y = value[::-1], y[:, ::-1]
        x, gx = v @ y[:, :k], g @ y[:, :k]
        off = np.linalg.norm(gx - x * value[:k], axis=0)
        open_ = np.flatnonzero(off > tolerance * max(value[0], 1e-300))
        if not len(open_) or v.shape[1] >= m:
            break
        if v.shape[1] + len(open_) > held:
            v, g = v @ y[:, :width], g @ y[:, :width]
        new = (gx - x * value[:k])[:, open_]
        new = new / np.linalg.norm(new, axis=0)
        for _ in range(2):
            new = new - v @ (v.T @ new)
        u, s, _ = np.linalg.svd(new, full_matrices=False)
        new = u[:, s > 1e-8 * max(s.max(), 1e-300)][:, : m - v.shape[1]]
        new = np.linalg.qr(new - v @ (v.T @ new))[0]
        v, g = np.concatenate([v, new], axis=1), np.concatenate([g, product(new)], axis=1)
    return x


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of about ENTRIES entries at a time, with where each row's begin and the last one's end, their terms and what stands there."""
    for b in batches:
        n = pc.list_value_length(b.column("terms")).to_numpy(zero_copy_only=False).astype(np.int64)
        for cut in np.split(np.arange(len(n)), np.flatnonzero(np.diff(np.cumsum(n) // ENTRIES)) + 1):
            if len(cut):
                part = b.slice(cut[0], len(cut))
                yield part, np.r_[0, np.cumsum(n[cut])], pc.list_flatten(part.column("terms")).to_numpy().astype(np.int64), pc.list_flatten(part.column("ws")).to_numpy()


def _crossed(batches: Iterator[pa.RecordBatch], m: int) -> Iterator[pa.RecordBatch]:
    """The sum of the rows' products with themselves, on and above the diagonal: by strips of TILE terms, the places that aren't 0, counted within the strip, and what stands there."""
    begin = np.arange(m + 1) * m - np.arange(m + 1) * np.arange(-1, m) // 2
    total, base = np.zeros(begin[m]), begin[:-1] - np.arange(m)
    for _, ends, term, w in _pieces(batches):
        row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
        order = np.lexsort((term, row))
        term, w = term[order], w[order]
        left = ends[1:][row] - np.arange(len(term))  # entries of the row from this one on
        for cut in np.split(np.arange(len(term)), np.flatnonzero(np.diff(np.cumsum(left) // PAIRS)) + 1):
            n = left[cut]
            one = np.repeat(cut, n)
            other = one + np.arange(len(one)) - np.repeat(np.cumsum(n) - n, n)
            np.add.at(total, base[term[one]] + term[other], w[one] * w[other])
    for a in range(0, m, TILE):
        strip = total[begin[a] : begin[min(a + TILE, m)]]
        if len(at := np.flatnonzero(strip)):
            yield pa.RecordBatch.from_arrays([pa.array([a // TILE], pa.int32()), pa.array([at.astype(np.int32)]), pa.array([strip[at]])], ["a", "at", "x"])


def _tiles(batches: Iterator[pa.RecordBatch], m: int) -> Iterator[pa.RecordBatch]:
    """Sums of strips, cut into tiles of TILE by TILE terms; each tile beyond the diagonal also as its mirror image."""
    upper = lambda a: np.arange(m) >= np.arange(a * TILE, min((a + 1) * TILE, m))[:, None]
    strips: dict[int, np.ndarray] = {}
    for b in batches:
        for a, at, x in zip(b.column("a").to_pylist(), b.column("at"), b.column("x")):
            if a not in strips:
                strips[a] = np.zeros(np.count_nonzero(upper(a)))
            strips[a][at.values.to_numpy()] += x.values.to_numpy()
    for a, sums in strips.items():
        strip, found = np.zeros((min(TILE, m - a * TILE), m)), []
        strip[upper(a)] = sums
        for c in range(a, -(-m // TILE)):
            tile = strip[:, c * TILE : (c + 1) * TILE]
            if c == a:
                found.append((a, a, (tile + np.triu(tile, 1).T).tobytes()))
            elif tile.any():
                found += [(a, c, tile.tobytes()), (c, a, tile.T.tobytes())]
        a_, c_, x = zip(*found)
        yield pa.RecordBatch.from_arrays([pa.array(a_, pa.int32()), pa.array(c_, pa.int32()), pa.array(x, pa.binary())], ["a", "c", "x"])


def _square(rows: DataFrame, m: int) -> DataFrame:
    """a, c and x: tiles of the transposed matrix times the matrix of ``rows(terms, ws)`` of m terms, written down.

    A task adds up the rows that it reads, in half the matrix, and only its
    sums are shuffled; so rows are read once, and what is read from then on
    depends on terms only.
    """
    strips = rows.select("terms", "ws").mapInArrow(partial(_crossed, m=m), "a int, at array<int>, x array<double>")
    tiles = strips.repartition(TILED, "a").mapInArrow(partial(_tiles, m=m), "a int, c int, x binary")
    return settle(tiles.repartition(TILED, "a"), "square")


def _tiles_times(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    q, total = shared.value, {}
    for b in batches:
        for a, c, x in zip(b.column("a").to_pylist(), b.column("c").to_pylist(), b.column("x")):
            part = q[c * TILE : (c + 1) * TILE]
            total[a] = total.get(a, 0) + np.frombuffer(x.as_buffer()).reshape(-1, len(part)) @ part
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["a", "x"])


def _square_times(tiles: DataFrame, q: np.ndarray) -> np.ndarray:
    shared = tiles.sparkSession.sparkContext.broadcast(q)
    out = np.zeros(q.shape)
    for r in tiles.mapInArrow(partial(_tiles_times, shared=shared), "a int, x binary").collect():
        out[r.a * TILE : (r.a + 1) * TILE] += np.frombuffer(r.x).reshape(-1, q.shape[1])
    shared.destroy()
    return out


def _rows_times(rows: DataFrame, q: np.ndarray) -> np.ndarray:
    """The same from the rows, whose products are summed on the executors; no matrix of terms by terms is made."""
    m, shared = len(q), rows.sparkSession.sparkContext.broadcast(q)

    def multiplied(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(shared.value.shape)
        for b in batches:
            for at in range(0, len(b), STRIP):
                part = b.iloc[at : at + STRIP]
                used, place = np.unique(np.concatenate(part["terms"].to_numpy()), return_inverse=True)
                x = np.zeros((len(part), len(used)))
                x[np.repeat(np.arange(len(part)), part["terms"].map(len)), place] = np.concatenate(part["ws"].to_numpy())
                total[used] += x.T @ (x @ shared.value[used])
        for top in range(0, m, STRIP):
            yield pd.DataFrame({"top": [top], "x": [total[top : top + STRIP].ravel()]})

    def added(key: tuple, strips: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"top": [key[0]], "x": [np.sum(np.stack(strips["x"].to_numpy()), axis=0)]})

    schema = "top int, x array<double>"
    found = rows.select("terms", "ws").mapInPandas(multiplied, schema).groupBy("top").applyInPandas(added, schema).collect()
    shared.destroy()
    out = np.zeros(q.shape)
    for r in found:
        out[r.top : r.top + STRIP] = np.array(r.x).reshape(-1, q.shape[1])
    return out


def _projected(batches: Iterator[pa.RecordBatch], shared, key: str) -> Iterator[pa.RecordBatch]:
    v = shared.value
    for part, ends, term, w in _pieces(batches):
        z = np.add.reduceat(w[:, None] * v[term], ends[:-1], axis=0)
        z = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1) * v.shape[1], pa.int32()), pa.array(z.ravel()))
        yield pa.RecordBatch.from_arrays([part.column(key), z], [key, "z"])


def lsa(weights: DataFrame, n: int, key: str = "ord", most: int = 50) -> DataFrame:
    """key and z: rows of a sparse matrix ``(key, term, w)`` on its leading right singular vectors, each with its largest part positive.

    The vectors are found by products with a few columns at a time, on the
    executors: of the matrix of terms by terms, in tiles, while that takes at
    most MOST_SQUARE bytes, so that rows are read once for all products; of
    the rows beyond. The driver holds a few numbers a term for each of the
    ``most`` vectors. ``weights`` is read twice and should be written down.
    """
    spark = weights.sparkSession
    terms = [r.term for r in weights.select("term").distinct().orderBy("term").collect()]
    m = len(terms)
    k = dimensions(n, m, most)
    if k == 0:
        return weights.select(key).distinct().withColumn("z", F.array().cast("array<double>"))
    of = spark.createDataFrame(list(enumerate(terms)), "i int, term string")
    kind = dict(weights.dtypes)[key]
    rows = weights.join(of, "term").groupBy(key).agg(F.collect_list("i").alias("terms"), F.collect_list("w").alias("ws"))
    rows = settle(rows, "matrix")
    if 8 * m * m <= MOST_SQUARE:
        tiles = _square(rows, m)
        v = leading(partial(_square_times, tiles), m, k)
        discard(tiles)
    else:
        v = leading(partial(_rows_times, rows), m, k)
    v = v * np.sign(v[np.abs(v).argmax(axis=0), np.arange(k)])
    return rows.mapInArrow(partial(_projected, shared=spark.sparkContext.broadcast(v), key=key), f"{key} {kind}, z array<double>")


def plane(projected: DataFrame, key: str = "ord") -> DataFrame:
    """key, x, y: the first two parts of each row."""
    part = lambda i: F.coalesce(F.get("z", F.lit(i)), F.lit(0.0))
    return projected.select(key, part(0).alias("x"), part(1).alias("y"))


def tsne(x: np.ndarray, perplexity: float | None = None, steps: int = 500, rate: float | None = None) -> np.ndarray:
    """Exact t-SNE to two dimensions, started from the leading principal components; for a report's few thousand rows."""
    n = len(x)
    if n < 3:
        return np.zeros((n, 2))
    perplexity = min(perplexity or max(5, min(30, n // 3)), (n - 1) / 3)
    d2 = np.square(x[:, None] - x[None]).sum(-1)
    p = np.zeros((n, n))
    for i in range(n):  # the width of each row's kernel by bisection on its entropy
        low, high, beta, own = 0.0, np.inf, 1.0, np.delete(d2[i], i)
        own = own - own.min()
        for _ in range(60):
            w = np.exp(-own * beta)
            entropy = np.log(w.sum()) + beta * (own * w).sum() / w.sum()
            if entropy > np.log(perplexity):
                low, beta = beta, beta * 2 if high == np.inf else (beta + high) / 2
            else:
                high, beta = beta, (beta + low) / 2
        p[i, np.arange(n) != i] = w / w.sum()
    p = np.maximum((p + p.T) / (2 * n), 1e-12)
    c = x - x.mean(0)
    u, s, _ = np.linalg.svd(c, full_matrices=False)
    y = np.zeros((n, 2))
    k = min(2, len(s))
    y[:, :k] = u[:, :k] * s[:k]
    y *= 1e-4 / (y[:, 0].std() or 1.0)
    move, gain = np.zeros_like(y), np.ones_like(y)
    rate = rate or max(n / 48, 50)
    for t in range(steps):
        q = 1 / (1 + np.square(y[:, None] - y[None]).sum(-1))
        np.fill_diagonal(q, 0)
        force = ((12 if t < steps // 4 else 1) * p - q / q.sum()) * q
        grad = 4 * (force.sum(1)[:, None] * y - force @ y)
        gain = np.maximum(np.where(np.sign(grad) == np.sign(move), gain * 0.8, gain + 0.2), 0.01)
        move = (0.5 if t < steps // 4 else 0.8) * move - rate * gain * grad
        y = y + move
    return y - y.mean(0)


def landmarks_of(rows: DataFrame, key: str, most: int = LANDMARKS) -> DataFrame:
    """At most so many of the rows, those of least hash; all if there are no more."""
    return rows.orderBy(F.xxhash64(key), key).limit(most)


def affinities(d2: np.ndarray, perplexity: float) -> np.ndarray:
    """By row of squared distances, weights that sum up to 1 and whose entropy is that of ``perplexity`` neighbours, by bisection on the kernel's width."""
    own = d2 - d2.min(1, keepdims=True)
    low, high, beta = np.zeros(len(own)), np.full(len(own), np.inf), np.ones(len(own))
    for _ in range(60):
        w = np.exp(-own * beta[:, None])
        entropy = np.log(w.sum(1)) + beta * (own * w).sum(1) / w.sum(1)
        wide = entropy > np.log(perplexity)
        low, high = np.where(wide, beta, low), np.where(wide, high, beta)
        beta = np.where(high == np.inf, beta * 2, (low + high) / 2)
    return w / w.sum(1, keepdims=True)


def placed_among(near: DataFrame, places: dict, weigh: Callable[[np.ndarray], np.ndarray], key: str, kind: str) -> DataFrame:
    """key and z: the mean place of each row's landmarks in ``near(key, other, d)``, weighted by what ``weigh`` makes of the distances.

    ``places`` has a vector for each landmark; so it is as bounded as they are.
    """
    shared = near.sparkSession.sparkContext.broadcast(places)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for d, others in zip(b["d"], b["others"]):
                w = weigh(np.asarray(d, float))
                out.append((w / w.sum()) @ np.stack([shared.value[o] for o in others]))
            yield pd.DataFrame({key: b[key], "z": out})

    listed = near.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("d", "other"))).alias("x"))
    return listed.select(key, F.col("x.d").alias("d"), F.col("x.other").alias("others")).mapInPandas(place, f"{key} {kind}, z array<double>")


def tsne_plane(projected: DataFrame, key: str = "ord", most: int = LANDMARKS) -> DataFrame:
    """key, x, y by t-SNE over z.

    ``most`` landmarks, a sample by hash, are laid out by exact t-SNE; all
    rows where there are no more. Every other row goes to the mean place of
    its nearest landmarks, weighted by affinities of the same perplexity.
    """
    spark, kind = projected.sparkSession, dict(projected.dtypes)[key]
    rows = settle(projected.select(key, "z"), "projected")
    few = landmarks_of(rows, key, most).orderBy(key).toPandas()
    xy = tsne(np.stack(few["z"].to_numpy()) if len(few) else np.zeros((0, 2)))
    found = spark.createDataFrame(pd.DataFrame({key: few[key], "x": xy[:, 0], "y": xy[:, 1]}), f"{key} {kind}, x double, y double")
    if len(few) < most:
        return found
    numbered = pd.DataFrame({"id": np.arange(len(few)), "v": few["z"]})
    marks = spark.createDataFrame(numbered, "id long, v array<double>").select("id", "v", F.col("id").alias("g"), F.lit(float("inf")).alias("tau"))
    rest = rows.join(found.select(key), key, "left_anti")
    asked = rest.select(F.xxhash64(key).alias("id"), F.col("z").alias("v"), F.lit(-1).cast("bigint").alias("g"), F.lit(float("inf")).alias("tau"))
    near = nearest(asked, marks, min(len(few), 3 * 30))
    own = near.join(rest.select(F.col(key), F.xxhash64(key).alias("id")), "id").select(key, "other", "d")
    moved = placed_among(own, dict(enumerate(xy)), lambda d: affinities(np.square(d)[None], min(30.0, (len(d) - 1) / 3))[0], key, kind)
    return found.unionByName(plane(moved, key))


def components_of(vectors: DataFrame, k: int = 2) -> DataFrame:
    """id and z of ``vectors(id, v)``: the k leading principal components, each with its largest loading positive.

    Sums and products of columns are aggregated in Spark; only a matrix of
    the vectors' length is decomposed in the driver.
    """

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, s, g = 0, None, None
        for b in batches:
            if len(b):
                x = np.stack(b["v"].to_numpy()).astype(float)
                n, s, g = n + len(x), x.sum(0) + (0 if s is None else s), x.T @ x + (0 if g is None else g)
        if n:
            yield pd.DataFrame({"n": [n], "s": [s], "g": [g.ravel()]})

    parts = vectors.filter("v is not null").select("id", "v").mapInPandas(moments, "n long, s array<double>, g array<double>")
    flat = parts.select("n", F.posexplode(F.concat("s", "g")).alias("i", "x")).groupBy("i").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).orderBy("i").toPandas()
    schema = f"id {dict(vectors.dtypes)['id']}, z array<double>"
    if flat.empty:
        return vectors.sparkSession.createDataFrame([], schema)
    d, n = int((np.sqrt(1 + 4 * len(flat)) - 1) / 2 + 0.5), flat["n"].iat[0]
    mean = flat["x"].to_numpy()[:d] / n
    _, v = np.linalg.eigh(flat["x"].to_numpy()[d:].reshape(d, d) / n - np.outer(mean, mean))
    v = v[:, ::-1][:, :k]
    v = v * np.sign(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])])
    shared = vectors.sparkSession.sparkContext.broadcast((mean, v))

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, w = shared.value
        for b in batches:
            if len(b):
                yield pd.DataFrame({"id": b["id"], "z": list((np.stack(b["v"].to_numpy()).astype(float) - m) @ w)})

    return vectors.filter("v is not null").select("id", "v").mapInPandas(project, schema)


def memberships(d: np.ndarray, wanted: float) -> np.ndarray:
    """Fuzzy memberships of a row's neighbours at distances d: 1 for the nearest, and ``wanted`` in all, by bisection on the kernel's width."""
    beyond = np.maximum(d - d.min(), 0)
    low, high = 0.0, np.inf
    width = max(float(beyond.mean()), 1e-6)
    for _ in range(64):
        total = np.exp(-beyond / width).sum()
        if abs(total - wanted) < 1e-5:
            break
        if total > wanted:
            high, width = width, (low + width) / 2
        else:
            low, width = width, width * 2 if high == np.inf else (width + high) / 2
        width = max(width, 1e-9)
    return np.exp(-beyond / width)


def curve(least: float, spread: float = 1.0) -> tuple[float, float]:
    """a and b for which 1 / (1 + a d^(2b)) is nearest to 1 up to the distance ``least`` and an exponential decay beyond; by Gauss-Newton steps on their logarithms."""
    x = np.linspace(spread / 100, 3 * spread, 300)
    y = np.where(x < least, 1.0, np.exp(-(x - least) / spread))
    la, lb = 0.0, 0.0
    for _ in range(100):
        power = np.exp(la) * x ** (2 * np.exp(lb))
        f = 1 / (1 + power)
        slope = -f * f * power
        j = np.stack([slope, slope * 2 * np.exp(lb) * np.log(x)], axis=1)
        step = np.linalg.lstsq(j, y - f, rcond=None)[0]
        la, lb = la + np.clip(step[0], -0.5, 0.5), lb + np.clip(step[1], -0.5, 0.5)
    return float(np.exp(la)), float(np.exp(lb))


def graph_layout(start: np.ndarray, i: np.ndarray, j: np.ndarray, w: np.ndarray, least: float, epochs: int = 300, others: int = 5, seed: int = 42) -> np.ndarray:
    """Places from ``start`` on: edges (i, j) pull by their weight w, random rows push.

    Each epoch draws an edge with a probability of its weight over the
    greatest, and moves all ends at once; steps shrink to 0.
    """
    a, b = curve(least)
    rng = np.random.default_rng(seed)
    y, n = start.astype(float).copy(), len(start)
    chance = w / w.max()
    for t in range(epochs):
        rate = 1 - t / epochs
        drawn = rng.random(len(w)) < chance
        u, v = i[drawn], j[drawn]
        gap = y[u] - y[v]
        d2 = np.maximum(np.square(gap).sum(1), 1e-12)
        pull = np.clip((-2 * a * b * d2 ** (b - 1) / (1 + a * d2**b))[:, None] * gap, -4, 4)
        u2 = np.repeat(u, others)
        far = rng.integers(0, n, len(u2))
        gap = y[u2] - y[far]
        d2 = np.square(gap).sum(1)
        push = np.clip((2 * b / ((0.001 + d2) * (1 + a * d2**b)))[:, None] * gap, -4, 4)
        push[far == u2] = 0
        for c in range(y.shape[1]):
            y[:, c] += rate * (np.bincount(u, pull[:, c], n) - np.bincount(v, pull[:, c], n) + np.bincount(u2, push[:, c], n))
    return y


def neighbour_layout(vectors: DataFrame, k: int = 2, least: float = 0.1, near: int | None = None, seed: int = 42, landmarks: int = LANDMARKS, found: DataFrame | None = None) -> DataFrame:
    """id and z of unit ``vectors(id, v)`` with distinct ids: a UMAP of k dimensions by cosine distance.

    ``landmarks`` rows, a sample by hash, are laid out from the principal
    components on; all rows where there are no more. Their nearest
    neighbours are exact, ``near`` of them with the row itself (by default
    15, fewer where there are fewer rows); the driver holds that many edges
    a landmark. Every other row goes to the mean place of its nearest
    landmarks, weighted by its memberships. At most n - 2 dimensions, 2 at
    least; under 3 rows the principal components stand. ``found`` may have
    what neighbours() gives for all rows, if these are no more than the
    landmarks.
    """
    vectors = vectors.filter("v is not null")
    few = settle(landmarks_of(vectors.select("id", "v"), "id", landmarks), "landmarks")
    n = few.count()
    k = max(2, min(k, n - 2))
    low = components_of(few, k)
    if n < 3:
        return low
    near, kind = near or max(2, min(15, n - 1)), dict(vectors.dtypes)["id"]
    rows = low.orderBy("id").toPandas()
    edges = (found.filter(F.col("rank") < near) if found is not None and n < landmarks else neighbours(few, few, near - 1)).orderBy("id", "rank").toPandas()
    ids = rows["id"].to_numpy()
    i, j = np.searchsorted(ids, edges["id"]), np.searchsorted(ids, edges["other"])
    d = np.maximum(1 - edges["sim"].to_numpy(), 0)
    first = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
    w = np.concatenate([memberships(x, np.log2(near)) for x in np.split(d, first[1:])])
    pair = np.minimum(i, j).astype(np.int64) * n + np.maximum(i, j)
    pairs, at = np.unique(pair, return_inverse=True)
    none = np.ones(len(pairs))
    np.multiply.at(none, at, 1 - w)  # a + b - ab of both sides' memberships
    z = np.zeros((n, k))
    held = np.stack(rows["z"].to_numpy())
    z[:, : held.shape[1]] = held
    z = z * (10 / max(np.abs(z).max(), 1e-12)) + np.random.default_rng(seed).normal(0, 1e-4, z.shape)
    z = graph_layout(z, pairs // n, pairs % n, 1 - none, least, seed=seed)
    laid = vectors.sparkSession.createDataFrame(pd.DataFrame({"id": ids, "z": z.tolist()}), f"id {kind}, z array<double>")
    if n < landmarks:
        return laid
    rest = vectors.join(few.select("id"), "id", "left_anti")
    others = neighbours(few, rest, near).select("id", "other", F.greatest(1 - F.col("sim"), F.lit(0.0)).alias("d"))
    return laid.unionByName(placed_among(others, dict(zip(ids.tolist(), z)), lambda x: memberships(x, np.log2(near)), "id", kind))
