"""Neighbours by blocks, spanning trees, clusters, singular vectors and layouts against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliograph.operators import blocks, boxes, clusters, graph, layout, similarity
from heliograph.scratch import settle
from tests import plain


def clouds(rng, n, d, k=5):
    return np.concatenate([rng.normal(rng.normal(0, 6, d), rng.uniform(0.2, 1.0), (n // k, d)) for _ in range(k)])


def frame(spark, x, ids=None):
    return spark.createDataFrame([(int(i), r.tolist()) for i, r in zip(ids if ids is not None else range(len(x)), x)], "id long, v array<double>").repartition(3)


def test_neighbours_across_blocks(spark):
    """Vectors of all lengths, repeated ones among them, in many parts, rings and pairs of blocks."""
    rng = np.random.default_rng(1)
    x = clouds(rng, 400, 6)
    x[17] = x[3] = x[250]
    rows, counts = frame(spark, x), {}
    got = {(r.id, r["rank"]): (r.other, r.sim) for r in similarity.neighbours(rows, rows, 4, block=32, each=40, counts=counts).collect()}
    sim = x @ x.T
    np.fill_diagonal(sim, -np.inf)
    for i in range(400):
        order = np.lexsort((np.arange(400), -sim[i].round(12)))[:4]
        assert [got[i, k][0] for k in range(1, 5)] == order.tolist()
        assert np.allclose([got[i, k][1] for k in range(1, 5)], sim[i, order])
    assert counts["pairs"] == 160_000 and 0 < counts["compared"] <= 160_000


def test_bounds_leave_out_blocks(spark):
    """Unit vectors in tight groups: most pairs need no comparison, and none that counts is lost."""
    rng = np.random.default_rng(2)
    x = np.repeat(rng.normal(size=(10, 5)), 60, axis=0) + rng.normal(0, 0.02, (600, 5))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows, counts = frame(spark, x), {}
    got = {(r.id, r["rank"]): r.other for r in similarity.neighbours(rows, rows, 3, block=64, each=20, counts=counts).collect()}
    sim = x @ x.T
    np.fill_diagonal(sim, -np.inf)
    assert all([got[i, k] for k in (1, 2, 3)] == np.lexsort((np.arange(600), -sim[i].round(12)))[:3].tolist() for i in range(600))
    assert counts["compared"] < counts["pairs"] / 3


def test_neighbours_of_other_queries(spark):
    rng = np.random.default_rng(3)
    x, q = rng.normal(size=(90, 4)), rng.normal(size=(7, 4)) * 3
    got = {(r.id, r["rank"]): r.other for r in similarity.neighbours(frame(spark, x), frame(spark, q, range(1000, 1007)), 5, block=16, each=15).collect()}
    for i in range(7):
        assert [got[1000 + i, k] for k in range(1, 6)] == np.argsort(-(x @ q[i]))[:5].tolist()
    none = frame(spark, x).filter("id < 0")
    assert similarity.neighbours(none, frame(spark, q)).count() == 0 and similarity.neighbours(frame(spark, x), none).count() == 0
    odd = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.5, 0.5])], "id long, v array<double>")
    assert {(r.id, r.other) for r in similarity.neighbours(odd, odd).collect()} == {(1, 3), (3, 1)}


def test_connected(spark):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(1000, 1040)] + [(2000, i) for i in range(2001, 2050)] + [(5, 5)]
    got = {r.node: r.root for r in graph.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    top = {n: n for e in edges for n in e}
    for _ in range(60):
        for a, b in edges:
            top[a] = top[b] = min(top[a], top[b])
    assert got == top


@pytest.mark.parametrize(("n", "size", "each", "at_once", "least"), [(120, 32, 30, 60, 8), (200, 4096, 2048, 1 << 16, None)])
def test_tree_and_clusters_match_plain_versions(spark, n, size, each, at_once, least):
    rng = np.random.default_rng(n + at_once)
    x = clouds(rng, n, 3)
    rows = frame(spark, x)
    if least:
        tree = settle(clusters.spanning_tree(rows, near=3, size=size, each=each))
        want = plain.spanning_tree(x)
        assert sorted((r.a, r.b) for r in tree.collect()) == sorted((min(a, b), max(a, b)) for _, a, b in want)
        leaf = {r.id: r.leaf for r in clusters.leaves(tree, rows.select("id", F.lit(1).cast("bigint").alias("n")), least, at_once).collect()}
        names = {c: k for k, c in enumerate(sorted({c for c in leaf.values() if c is not None}))} | {None: -1}
        got = {i: names[c] for i, c in leaf.items()}
    else:
        got = {r.id: r.cluster for r in clusters.density_clusters(rows, size=size, each=each, at_once=at_once).collect()}
    assert [got[i] for i in range(n)] == plain.leaf_clusters(x, least or max(6, n // 30)).tolist()
    assert len(set(got.values())) > 2


def test_clusters_of_repeated_vectors(spark):
    """Copies are one place of their weight; a group of them alone can be a cluster."""
    x = np.concatenate([np.zeros((40, 2)), np.full((40, 2), 9.0), [[4.0, 4.0]], np.array([[20.0, 0.0]])])
    got = {r.id: r.cluster for r in clusters.density_clusters(frame(spark, x), 10).collect()}
    assert [got[i] for i in range(80)] == [0] * 40 + [1] * 40 and got[80] in (-1, 0, 1) and got[81] == -1
    one = {r.cluster for r in clusters.density_clusters(frame(spark, np.ones((30, 2)))).collect()}
    assert one == {-1}


def test_leading_vectors():
    rng = np.random.default_rng(6)
    for m, n, k in ((600, 300, 20), (40, 100, 39), (30, 5, 4)):
        a = rng.normal(size=(n, m)) * rng.uniform(0.1, 2, m)
        v = layout.leading(lambda q: a.T @ (a @ q), m, k)  # noqa: B023
        want = np.linalg.svd(a, full_matrices=False)[2][:k].T
        assert np.allclose(a @ v @ v.T @ a.T, a @ want @ want.T @ a.T, atol=1e-6)


def test_lsa_products_match_svd(spark):
    rng = np.random.default_rng(7)
    n, m = 400, 1500
    rows = [(i, f"t{j}", float(w)) for i in range(n) for j, w in zip(np.unique(np.minimum(rng.geometric(0.01, 12), m - 1)), rng.random(12) + 0.1)]
    z = {r.ord: np.array(r.z) for r in layout.lsa(spark.createDataFrame(rows, "ord int, term string, w double"), n, most=30).collect()}
    terms = sorted({t for _, t, _ in rows})
    a = np.zeros((n, len(terms)))
    for i, t, w in rows:
        a[i, terms.index(t)] += w
    u, s, _ = np.linalg.svd(a, full_matrices=False)
    want, got = u[:, :30] * s[:30], np.stack([z[i] for i in range(n)])
    assert np.allclose(got @ got.T, want @ want.T, atol=1e-6)


def kept(x, y, k=10):
    """The share of each row's k nearest in x that are among its k nearest in y."""
    both = []
    for m in (x, y):
        d = np.square(m[:, None] - m[None]).sum(-1)
        np.fill_diagonal(d, np.inf)
        both.append(d.argsort(1)[:, :k])
    return np.mean([len({*a} & {*b}) / k for a, b in zip(*both)])


def test_layouts_place_rows_beyond_their_landmarks(spark):
    rng = np.random.default_rng(8)
    x = clouds(rng, 500, 8)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = frame(spark, x)
    by_name = {}
    for name, most in (("all", 2000), ("sample", 150)):
        graph_ = {r.id: r.z for r in layout.neighbour_layout(rows, landmarks=most).collect()}
        flat = {r.ord: (r.x, r.y) for r in layout.tsne_plane(rows.select(F.col("id").alias("ord"), F.col("v").alias("z")), most=most).collect()}
        assert set(graph_) == set(flat) == set(range(500))
        by_name[name] = [kept(x, np.array([m[i] for i in range(500)])) for m in (graph_, flat)]
    print(by_name)
    assert all(b > 0.4 * a and b > 0.1 for a, b in zip(by_name["all"], by_name["sample"]))


def test_blocks_stay_small(spark):
    rows = frame(spark, np.random.default_rng(9).normal(size=(700, 3))).select("id", "v", F.col("id").alias("g"), F.lit(float("inf")).alias("tau"))
    _, pivots = blocks.pivots_of(rows, each=100)
    made = blocks.Blocks(rows, pivots, 30)
    n = [r.n for r in made.table.collect()]
    assert sum(n) == 700 and max(n) <= 60 and len(pivots.value) == 7


def test_built_in_encoder(spark, sf):
    """The query against the encoder called by hand; stems bring texts together."""
    from heliograph.operators.encode import PieceEncoder
    from heliograph.plans.registry import QUERIES

    encoder = PieceEncoder()
    docs = {str(r.doc_id): r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    known = {str(r.doc_id) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = {r.url: np.array(r.vec) for r in QUERIES["embed_documents"](spark, sf).collect()}
    assert set(got) == set(docs) - known and got
    urls = sorted(got)
    assert np.allclose(np.stack([got[u] for u in urls]), encoder([docs[u] for u in urls]), atol=1e-5)
    a, b, c = encoder(["soldiers crossing borders", "a soldier crossed the border", "apple pie with cream"])
    assert a @ b > a @ c + 0.2 and not encoder(["", "..."]).any()


def test_boxes_find_the_nearest(spark):
    """Many boxes; rows go to few of them; groups and bounds as told. Pieces of a range of edges are merged together."""
    rng = np.random.default_rng(12)
    x = np.concatenate([clouds(rng, 300, 4), rng.normal(0, 5, (100, 4))])
    n = len(x)
    d = np.sqrt(np.square(x[:, None] - x[None]).sum(-1))
    np.fill_diagonal(d, np.inf)
    held = boxes.Boxes(frame(spark, x), 16)
    assert len(held.block) >= n // 16 and held.rows.groupBy("block").count().agg(F.max("count")).first()[0] <= 40
    got = {}
    for r in held.nearest(3).collect():
        got.setdefault(r.id, {})[r.other] = r.d
    for i in range(n):
        assert sorted(got[i].values())[:3] == pytest.approx(np.sort(d[i])[:3]) and all(d[i, j] == pytest.approx(v) for j, v in got[i].items())
    group = np.arange(n) // 40
    there = held.rows.withColumn("g", F.floor(F.col("id") / 40))
    asked = there.filter("id % 3 = 0").withColumn("tau", F.lit(2.0))
    best = {}
    for r in held.within(asked, there).collect():
        best[r.id] = min(best.get(r.id, np.inf), r.d)
    for i in range(0, n, 3):
        want = d[i][group != group[i]].min()
        assert best.get(i) == (pytest.approx(want) if want <= 2 else None)
