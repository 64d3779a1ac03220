"""The operators on hand-made rows."""

import datetime as dt
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliograph.operators import archive, clusters, html, layout, report, revisions, shares, similarity, terms, themes, timeline
from heliograph.plans.registry import QUERIES
from heliograph.vocab import NEWS, PROSE, Source, Theme, Vocabulary
from tests import plain

ART = "url string, headline string, ord int"


def test_keep_first_needs_no_luck(spark):
    rows = spark.createDataFrame([("a", "x", 2), ("a", "y", 1), (None, "z", 0), ("b", None, 3)], ART)
    got = {(r.url, r.headline) for r in archive.keep_first(rows.repartition(4), "url", "ord").collect()}
    assert got == {("a", "y"), ("b", None)}


def test_upsert_keeps_old(spark, tmp_path):
    old = spark.createDataFrame([("a", "old", 9)], ART)
    new = spark.createDataFrame([("a", "new", 1), ("b", "n2", 2), ("b", "n1", 1)], ART)
    got = {(r.url, r.headline) for r in archive.upsert_new(old, new, "url", "ord").collect()}
    assert got == {("a", "old"), ("b", "n1")}
    path = str(tmp_path / "archive")
    assert archive.append_new(path, old, "url", "ord").count() == 1
    assert archive.append_new(path, new, "url", "ord").count() == 1
    assert archive.append_new(path, new, "url", "ord").count() == 0
    assert spark.read.parquet(path).count() == 2


def test_numbered(spark):
    rows = spark.createDataFrame([(i * 7 % 50,) for i in range(50)], "x int")
    assert sorted((r.x, r.ord) for r in archive.numbered(rows, "x").collect()) == [(i, i) for i in range(50)]


def test_topic(spark):
    heads = ["War on drones", "Award ceremony", "the warm day", "A cia plot", "Special", "Nato talks", "senator speaks", "pre-war era", None, "civil  defence"]
    got = [r.t for r in spark.createDataFrame([(i, h) for i, h in enumerate(heads)], "i int, h string").orderBy("i").select(themes.on_topic(F.col("h"), NEWS).alias("t")).collect()]
    assert got == [True, False, False, True, False, True, False, True, False, True]


def test_theme_assignment(spark):
    rows = [
        (0, "Kyiv talks", "nato nato"),  # one headline hit
        (1, "Russia and NATO", ""),  # a tie: the broad theme loses
        (2, "Weather", "missile tank tank putin"),  # the body decides
        (3, "Weather", "sunny"),  # nothing
        (4, "NATO army troops near Moscow", ""),  # more hits beat rank
        (5, None, None),
    ]
    got = {r.ord: (r.theme, r.themes) for r in themes.assign(spark.createDataFrame(rows, "ord int, headline string, body string"), NEWS).collect()}
    assert got == {0: (0, [0]), 1: (1, [1, 2]), 2: (2, [2]), 3: (7, [7]), 4: (2, [1, 2]), 5: (7, [7])}


def test_shares(spark):
    src = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "source string, rank int")
    rows = spark.createDataFrame([("a", "2024-01-02", True), ("a", "2024-01-01", False), ("b", "2024-01-05", True), ("b", "2024-01-06", False)], "source string, date string, m boolean")
    got = [(r.source, r.matched, r.total, r.pct, r.d0, r.d1) for r in shares.topic_shares(src, rows, F.col("m")).collect()]
    assert got == [("a", 1, 2, 50.0, "2024-01-01", "2024-01-02"), ("b", 1, 2, 50.0, "2024-01-05", "2024-01-06"), ("c", 0, 0, 0.0, "", "")]
    c = shares.coverage(shares.topic_shares(src, rows, F.col("m"))).first()
    assert (c["from"], c["to"], c.sources) == ("2024-01-01", "2024-01-06", 2)


def test_revisions(spark):
    t = lambda m: dt.datetime(2026, 7, 1, 10, m)
    rows = [
        ("1", "1/a", "Drone seen", t(1), 1), ("1", "1/b", "Drone shot", t(2), 2),
        ("2", "2/a", "Weather", t(1), 3), ("2", "2/b", "Weather", t(2), 4),  # the same headline
        ("3", "3/a", "A war", t(1), 5), ("3", "3/b", "B", t(2), 6), ("3", "3/c", "A war", t(3), 7),  # back again: two versions
        ("4", "4/a", "War", t(1), 8), ("4", "4/b", "Calm", t(2), 9),  # only the old one is on topic
        ("5", "5/a", "Cats", t(1), 10), ("5", "5/b", "Dogs", t(2), 11),  # off topic
        ("6", "6/a", "War one", t(1), 12), ("6", "6/a", "War two", t(2), 13),  # the same url: not seen
        (None, "x", "War", t(1), 14),
    ]
    df = spark.createDataFrame(rows, "aid string, url string, headline string, at timestamp, ord int")
    got = [(r.aid, r.n, [v.h for v in r.versions]) for r in revisions.revision_history(df, NEWS).collect()]
    assert got == [("1", 2, ["Drone seen", "Drone shot"]), ("3", 2, ["A war", "B"]), ("4", 2, ["War", "Calm"])]
    assert "6" in {r.aid for r in revisions.revision_history(df, NEWS, same_url=True).collect()}
    assert spark.createDataFrame([("https://news.err.ee/123/x",), ("https://else/1",)], "u string").select(revisions.article_id(F.col("u")).alias("a")).collect() == [("123",), (None,)]


def test_timeline(spark):
    d = lambda i: dt.date(2024, 1, i)
    rows = spark.createDataFrame([(d(1), "EE", "b", "u"), (d(1), "LT", "a", "u"), (d(4), "EE", "c", "u")], "d date, code string, h string, u string")
    got = [(r.d.day, r.EE, r.LT, r.total) for r in timeline.daily_counts(rows, ["EE", "LT"]).orderBy("d").collect()]
    assert got == [(1, 1, 1, 2), (2, 0, 0, 0), (3, 0, 0, 0), (4, 1, 0, 1)]
    assert timeline.daily_counts(rows, ["EE"], most=2).count() == 2
    assert timeline.daily_peak(timeline.daily_counts(rows.limit(0), ["EE"])).first().peak == 1


def test_labels(spark):
    one = spark.createDataFrame([(["russia", "russian", "air defence", "air", "tank"],)], "t array<string>")
    assert one.select(terms.apart(F.col("t")).alias("t")).first().t == ["russia", "air defence", "tank"]

    def labels(ranked):
        rows = [(c, i + 1, t) for c, words in ranked.items() for i, t in enumerate(words)]
        return {r.cluster: r.words for r in terms.cluster_labels(spark.createDataFrame(rows, "cluster int, rank int, term string")).collect()}

    assert labels({0: ["defence", "systems", "plan"], 1: ["defence", "airspace"], 3: ["solo"]}) == {0: ["defence", "systems"], 1: ["defence", "airspace"], 3: ["solo"]}
    # "tank" heads two clusters, so it is a facet only where nothing else is left; the stem of an earlier facet isn't used again.
    assert labels({4: ["army", "tank", "plan"], 7: ["navy", "tank"], 9: ["border", "plane", "wall"]}) == {4: ["army", "plan"], 7: ["navy", "tank"], 9: ["border", "wall"]}
    assert labels({0: ["a"] + [f"word{i}" for i in range(9)]}) == {0: ["a", "word0"]}


def test_edits_as_a_report_tells_them(spark):
    from heliograph.vocab import NEWS

    url = "https://news.err.ee/1609/{}"
    rows = [(0, "err_ee", url.format("a"), "Drone seen", "2024-07-01", "2024-07-01_05.00.00"), (1, "err_ee", url.format("b"), "Drone shot down", "2024-07-02", "2024-07-02_05.00.00"), (2, "lrt_lt", "https://lrt.lt/1", "War", "2024-07-02", "2024-07-02_05.00.00")]
    df = spark.createDataFrame(rows, "ord int, source string, url string, headline string, date string, stamp string")
    (got,) = revisions.edits(df, NEWS).collect()
    label = next(s.label for s in NEWS.sources if s.name == "err_ee")
    assert (got.id, got.source, got.n, got.last) == ("1609", label, 2, "2024-07-02_05.00.00")
    assert [tuple(v) for v in got.versions] == [("Drone seen", url.format("a"), "2024-07-01", "01 Jul 07:00"), ("Drone shot down", url.format("b"), "2024-07-02", "02 Jul 07:00")]
    assert [v.t for v in revisions.edits(df.drop("stamp"), NEWS).first().versions] == ["2024-07-01", "2024-07-02"]


def test_elements_left_open_in_dropped_ones():
    assert html.paragraphs("<nav><form>x</nav><article><p>kept</article>") == ["kept"]
    assert html.paragraphs("<article><p>one<aside><p>no</aside> two</p></article>") == ["one two"]
    assert html.paragraphs("<footer><div><p>no</footer><p>yes") == ["yes"]


def test_thirds_round_half_to_even(spark):
    from heliograph.functions.numbers import thirds

    assert [r.x for r in spark.createDataFrame([(0.0625,), (0.1875,), (0.0005,), (-0.0625,)], "x double").select(thirds(F.col("x")).alias("x")).collect()] == [0.062, 0.188, 0.0, -0.062]


def test_a_repeated_run_replaces_its_rows(spark, tmp_path):
    path = str(tmp_path / "a")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "url string, ord int")
    assert archive.append_new(path, rows, "url", "ord", run="one").count() == 2
    # After a crash the same run comes again: what it added is told again, and stands once.
    assert archive.append_new(path, rows, "url", "ord", run="one").count() == 2
    assert archive.append_new(path, rows, "url", "ord", run="two").count() == 0
    assert spark.read.parquet(path).count() == 2


def test_lsa_matches_plain_svd(spark, sf):
    """The plane of the query, up to the signs of its axes."""
    from heliograph.functions.text import word_tokens
    from heliograph.operators import layout
    from heliograph.plans.tables import articles
    from heliograph.vocab import PROSE

    rows = articles(spark, sf).select("ord", F.col("headline").alias("text"))
    n = rows.count()
    counts = terms.term_counts(rows, PROSE.stop)
    w = terms.tfidf(counts, terms.vocabulary_of(counts, n), n).collect()
    ords, names = sorted({r.ord for r in w}), sorted({r.term for r in w})
    m = np.zeros((len(ords), len(names)))
    for r in w:
        m[ords.index(r.ord), names.index(r.term)] = r.w
    u, s, _ = np.linalg.svd(m, full_matrices=False)
    got = {r.ord: r.z for r in layout.lsa(terms.tfidf(counts, terms.vocabulary_of(counts, n), n), n).collect()}
    z = np.array([got[o] for o in ords])
    k = z.shape[1]
    want = u[:, :k] * s[:k]
    for i in range(2):
        assert np.allclose(np.abs(z[:, i]), np.abs(want[:, i]), atol=1e-3)


def test_density_clusters_of_components(spark):
    """Three clouds that differ only beyond the fifth coordinate are told apart."""
    from heliograph.operators import layout

    rng = np.random.default_rng(0)
    v = rng.normal(0, 0.01, (90, 12))
    v[30:60, 8] += 5
    v[60:, 11] += 5
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    got = {r.id: r.cluster for r in clusters.density_clusters(layout.components_of(rows, 5).withColumnRenamed("z", "v")).collect()}
    groups = [{got[i] for i in range(a, a + 30)} - {-1} for a in (0, 30, 60)]
    assert all(groups) and not (groups[0] & groups[1] or groups[1] & groups[2] or groups[0] & groups[2])


def test_tfidf_by_hand(spark):
    texts = ["aa bb bb", "aa cc", "bb cc cc cc", "dd"]
    counts = terms.term_counts(spark.createDataFrame(list(enumerate(texts)), "ord int, text string"), [])
    voc = terms.vocabulary_of(counts, 4)
    got = {(r.ord, r.term): r.w for r in terms.tfidf(counts, voc, 4).collect()}
    idf = np.log(5 / 3) + 1
    a, b = idf, (1 + np.log(2)) * idf
    assert got[0, "aa"] == pytest.approx(a / np.hypot(a, b))
    assert got[0, "bb"] == pytest.approx(b / np.hypot(a, b))
    assert {t for _, t in got} == {"aa", "bb", "cc"}


def test_class_terms_cross_seams(spark):
    rows = spark.createDataFrame([(0, 2, "cc"), (0, 1, "aa bb"), (1, 3, "dd"), (-1, 4, "noise")], "cluster int, ord int, text string")
    got = {(r.cluster, r.term) for r in terms.class_terms(rows, []).collect()}
    assert got == {(0, "aa"), (0, "bb"), (0, "cc"), (0, "aa bb"), (0, "bb cc"), (1, "dd")}


def test_neighbours_match_numpy(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(60, 8))
    v[7] = v[3]
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>").repartition(5)
    got = {(r.id, r["rank"]): r.other for r in similarity.neighbours(rows, rows, 5, block=16).collect()}
    sim = v @ v.T
    np.fill_diagonal(sim, -np.inf)
    for i in range(60):
        order = np.lexsort((np.arange(60), -sim[i].round(12)))[:5]
        assert [got[i, k] for k in range(1, 6)] == order.tolist()
    few = spark.createDataFrame([(1, [1.0, 0.0])], "id long, v array<double>")
    assert similarity.neighbours(few, few).count() == 0


def test_tone_bounds_and_fallback(spark):
    same = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(5)], "id long, v array<double>")
    assert {r.tone for r in similarity.tone(same, [1.0, 0.0], [0.0, 1.0]).collect()} == {0.0}


def test_heatmap_leaves_noise_out_of_cells(spark):
    rows = spark.createDataFrame([(0, "2024-01-01", 0.5), (0, "2024-01-03", 0.25), (9, "2024-01-02", -1.0), (0, "bad", 1.0)], "c int, d string, tone double")
    got = {(r.c, str(r.week)): (r.m, r.n) for r in similarity.tone_heatmap(rows, F.col("c") == 9).collect()}
    assert got == {(0, "2024-01-01"): (0.375, 2), (None, "2024-01-01"): (-0.083, 3)}


def test_renumber_and_palette(spark):
    rows = spark.createDataFrame([(5,), (5,), (7,), (7,), (-1,), (-1,), (-1,), (3,)], "cluster int")
    assert {r.cluster: r.id for r in similarity.renumber(rows).collect()} == {5: 0, 7: 1, 3: 2, -1: 3}
    light, dark = similarity.palette(12)
    assert len(set(light)) == len(set(dark)) == 12 and all(len(c) == 7 for c in light)


def test_embed_only_new(spark):
    rows = spark.createDataFrame([("a", "x"), ("b", "yy"), ("b", "yy")], "url string, text string")
    cache = spark.createDataFrame([("a",)], "url string")
    got = similarity.embed_new(rows, cache, lambda t: np.array([[len(x), 0.0] for x in t])).collect()
    assert [(r.url, list(r.vec)) for r in got] == [("b", [1.0, 0.0])]


def test_leaf_clusters():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 0.1, (20, 2)), rng.normal(5, 0.1, (25, 2)), [[50.0, 50.0], [-40.0, 9.0]]])
    labels = plain.leaf_clusters(x, 6)
    a, b = set(labels[:20]) - {-1}, set(labels[20:45]) - {-1}
    assert a and b and not a & b and set(labels[45:]) == {-1}


def test_density_clusters_match_brute_force(spark, tmp_path):
    """Groups that differ beyond the fifth coordinate only."""
    rng = np.random.default_rng(5)
    v = rng.normal(0, 0.05, (72, 12))
    v[:25, 8] += 3
    v[25:50, 10] -= 3
    v[50:55] += rng.normal(0, 9, (5, 12))
    order = rng.permutation(72)
    spark.createDataFrame([(int(i), v[i].tolist(), 0) for i in order], "vec_id long, embedding array<double>, label int").repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {r.id: r.cluster for r in QUERIES["density_clusters"](spark, str(tmp_path)).collect()}
    c = v - v.mean(0)
    z = c @ np.linalg.svd(c)[2][:5].T
    d = np.sqrt(np.square(z[:, None] - z[None]).sum(-1))

    def parts(ids, under):
        """Connected components of the pairs nearer than a distance."""
        left, out = set(ids), []
        while left:
            todo, one = [left.pop()], set()
            while todo:
                i = todo.pop()
                one.add(i)
                near = {j for j in left if d[i, j] < under}
                left -= near
                todo += near
            out.append(one)
        return out

    def leaves(ids):
        at = ids
        while True:
            under = next(t for t in sorted({d[i, j] for i in at for j in at}, reverse=True) if len(parts(at, t)) > 1)
            large = [p for p in parts(at, under) if len(p) >= 6]
            if len(large) != 1:
                return [x for p in large for x in leaves(p)] or [ids]
            at = large[0]

    wanted = leaves(set(range(72)))
    assert len(wanted) > 2 and sorted(got) == list(range(72))
    assert {frozenset(i for i in got if got[i] == k) for k in set(got.values()) - {-1}} == set(map(frozenset, wanted))


def test_few_rows_are_one_cluster(spark):
    rows = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(11)], "id long, v array<double>")
    assert {r.cluster for r in clusters.density_clusters(rows).collect()} == {0}


def test_lsa_keeps_products(spark):
    w = [(0, "a", 1.0), (1, "b", 1.0), (2, "a", 0.6), (2, "b", 0.8), (3, "c", 0.5)]
    z = {r.ord: np.array(r.z) for r in layout.lsa(spark.createDataFrame(w, "ord int, term string, w double"), 4, most=2).collect()}
    assert z[0] @ z[1] == pytest.approx(0.0, abs=1e-9) and z[0] @ z[2] == pytest.approx(0.6) and np.abs(z[3]).max() == pytest.approx(0.0, abs=1e-9)


def test_lsa_layout_matches_svd(spark, tmp_path):
    """More than 300 terms, and headlines of rare terms only."""
    rng = np.random.default_rng(3)
    name = lambda i: "q" + chr(97 + i // 26) + chr(97 + i % 26) + "z"
    heads = [" ".join(name(i) for i in np.minimum(rng.geometric(0.02, 8), 199)) for _ in range(300)]
    heads += [f"{name(300 + i // 2)} {name(400 + i // 2)}" for i in range(60)] + ["unseen", "", None]
    spark.createDataFrame([(i, h, "en", "s", 0) for i, h in enumerate(heads)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.ord: (r.x, r.y) for r in QUERIES["lsa_layout"](spark, str(tmp_path)).collect()}
    tf = []
    for h in heads:
        w = (h or "").split()
        tf.append(Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:])]))
    df = Counter(t for c in tf for t in c)
    voc = sorted(t for t in df if 2 <= df[t] <= 0.6 * len(heads))
    x = np.array([[(1 + np.log(c[t])) * (np.log((1 + len(heads)) / (1 + df[t])) + 1) if t in c else 0.0 for t in voc] for c in tf])
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    _, _, v = np.linalg.svd(x)
    v = v[:2] * np.sign(v[[0, 1], np.abs(v[:2]).argmax(axis=1)])[:, None]
    assert len(voc) > 300 and sorted(got) == list(range(len(heads)))
    assert np.array([got[i] for i in range(len(heads))]) == pytest.approx(x @ v.T, abs=1e-8)


LONG = "This paragraph is certainly longer than forty characters."


@pytest.mark.parametrize(
    ("page", "wanted"),
    [
        (f"<main><p>{LONG}</p></main>", [LONG]),
        (f"<p>{LONG}</p>", [LONG]),
        (f"<main><p>x</p></main><article><p>{LONG}</p></article>", [LONG]),
        (f'<script>var t="</p><p>no</p>";</script><nav><p>menu</p></nav><p>{LONG}', [LONG]),
        (f"<p><b>{LONG}<br><p>second", [LONG, "second"]),
        (None, []),
        ("", []),
    ],
)
def test_paragraphs(page, wanted):
    assert html.paragraphs(page) == wanted


def test_nested_paragraphs_on_request():
    assert html.paragraphs("<p>a<p>b", nested=True) == ["a b", "b"]


def test_bodies(spark):
    p40, p41 = "x" * 40, "y" * 41
    rows = [(200, f"<p>{p40}</p><p>{p41}</p><p>Please subscribe to our newsletter, it is free of charge</p>"), (404, f"<p>{LONG}</p>"), (200, None), (200, f"<p>{'z' * 6001}</p>")]
    got = [r.body for r in html.article_bodies(spark.createDataFrame(rows, "status int, html string"), NEWS).collect()]
    assert got == [p41, "", "", "z" * 6000]


def test_front_pages(spark):
    rows = [("<div class='news-article big'><a href='https://e/1'>One &amp; two</a></div><div class='other'><a href='/x'>no</a></div>", "s")]
    got = html.front_page_rows(spark.createDataFrame(rows, "html string, scraped_at string"), "err_ee").collect()
    assert [(r.url, r.headline) for r in got] == [("https://e/1", "One & two")]
    assert html.listing_rows("<div class=news><h3> T </h3><a href='/a'>x</a></div>", **html.LISTINGS["lrt_lt"]) == [("https://www.lrt.lt/a", "T")]
    assert html.listing_rows("<article class=list-article>none</article><article class=list-article><a href=/b> B </a></article>", **html.LISTINGS["lsm_lv"]) == [("https://eng.lsm.lv/b", "B")]


def test_report(spark):
    voc = Vocabulary((), (), (Theme(0, "A", "a", 1), Theme(1, "B", "b", 1)), "O", sources=(Source("s", "EE", "S", "https://s", 0),))
    rows = spark.createDataFrame([("u", "h", "s", "2024-01-01", 0, [0, 1])], "url string, headline string, source string, date string, theme int, themes array<int>")
    assert report.tagged_rows(rows, voc).first().all_themes == "A; B"
    assert rows.select(themes.also_tags(F.col("themes"), 0, voc).alias("t")).first().t == "B"
    j = report.payload("now", points=rows.select("headline")).first().json
    assert j == '{"generated":"now","points":[{"headline":"h"}]}' and report.page(j, "<x>__PAYLOAD__</x>") == f"<x>{j}</x>"
    assert spark.range(1).select(report.homes(voc).alias("m")).first().m == {"EE": "https://s"}


def test_nearest_and_extents(spark):
    p = spark.createDataFrame([(1, 0.0, 0.0), (2, 3.0, 0.0), (3, -3.0, 0.0)], "ord int, x double, y double")
    assert similarity.nearest_point(p, 2.9, 0.0).first().ord == 2 and similarity.nearest_point(p, 100.0, 0.0).count() == 0
    e = similarity.extents(p).first()
    assert (e.lo_x, e.hi_x) == (pytest.approx(-3.48), pytest.approx(3.48)) and (e.lo_y, e.hi_y) == (pytest.approx(-0.08), pytest.approx(0.08))
    assert PROSE.labels[-1] == "Other"
