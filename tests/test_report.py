"""Whole reports, fetching and counters on small inputs."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from heliograph.functions import dates
from heliograph.operators import html, layout, metrics, report, similarity
from heliograph.plans.report_plan import run_report, semantic_view, topic_report, write_view
from heliograph.sources.fetch import fetch_pages, get
from heliograph.vocab import NEWS


def test_topic_report(spark, tmp_path):
    heads = ["Drone over the border", "Weather is fine", "NATO troops arrive", "Drone drill with NATO troops", "Putin speaks about drones"]
    rows = [(i, NEWS.sources[i % 3].name, f"u{i}", h, f"2026-07-{10 + i}") for i, h in enumerate(heads)]
    articles = spark.createDataFrame(rows, "ord int, source string, url string, headline string, date string")
    bodies = spark.createDataFrame([("u0", "A drone crossed the border at night near troops."), ("u2", "Troops crossed the border.")], "url string, body string")
    t = topic_report(articles, bodies, NEWS)
    assert t["shares"].filter("source = 'lrt_lt'").first().pct == 50.0 and t["points"].count() == 4
    assert {r.id: r["count"] for r in t["themes"].collect()} == {3: 3, 4: 1, 2: 2, 1: 1}
    top = {r.term: r.n for r in t["keywords"].collect()}
    assert top["drone"] == 3 and top["troop"] == 2
    one = report.payload("now", **{k: t[k] for k in ("shares", "coverage", "themes", "points", "keywords")})
    report.write_report(one, str(tmp_path / "r"))
    assert '"generated":"now"' in spark.read.text(str(tmp_path / "r" / "payload.json")).first().value
    report.write_tagged(articles.withColumn("theme", F.lit(0)).withColumn("themes", F.array(F.lit(0))), NEWS, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first().theme_name == "Ukraine"


def test_report_run_tells_its_counters(spark, tmp_path):
    heads = ["Drone over the border", "Weather is fine", "NATO troops arrive", "Drone drill with NATO troops", None]
    articles = spark.createDataFrame([(i, NEWS.sources[i % 3].name, f"u{i}", h, f"2026-07-{10 + i}") for i, h in enumerate(heads)], "ord int, source string, url string, headline string, date string")
    bodies = spark.createDataFrame([("u0", "A drone crossed the border at night near troops."), ("u2", " ")], "url string, body string")
    lines = []
    found = run_report(articles, bodies, NEWS, str(tmp_path / "r"), "now", log=lines.append)
    assert found["filter"] == {"rows": 5, "topical": 3, "untitled": 1} and found["fetch"] == {"rows": 2, "empty": 1}
    assert found["tagged"] == {"rows": 3} and found["shares"]["rows"] == len(NEWS.sources) and found["points"]["rows"] == 3
    assert "[filter] 5 rows, 3 topical, 1 untitled" in lines
    text = spark.read.text(str(tmp_path / "r" / "payload.json"), wholetext=True).first().value
    import json

    data = json.loads(text)
    counts = [t["count"] for t in data["themes"]]
    assert counts == sorted(counts, reverse=True) and [s["pct"] for s in data["shares"]] == sorted((s["pct"] for s in data["shares"]), reverse=True)
    assert [k["n"] for k in data["keywords"]] == sorted((k["n"] for k in data["keywords"]), reverse=True)
    assert spark.read.text(str(tmp_path / "r" / "content.html")).first().value.startswith("<script")
    (tmp_path / "own.html").write_text("<p>\n__PAYLOAD__</p>\n")
    assert report.page("{}", report.template_of(spark, str(tmp_path / "own.html"))) == "<p>\n{}</p>\n"


def test_tone_cells(spark):
    cells = spark.createDataFrame([(-1.0,), (0.0,), (1.0,), (0.5,), (-7.0,)], "m double")
    got = [(r.m, r.colour, r.ink) for r in report.tone_cells(cells).collect()]
    dark_ink, light_ink = "rgba(0,0,0,.62)", "rgba(255,255,255,.82)"
    assert got == [(-1.0, "#2a78d6", light_ink), (0.0, "#f0efec", dark_ink), (1.0, "#d03b3b", light_ink), (0.5, "#e09594", dark_ink), (-7.0, "#2a78d6", light_ink)]
    assert report.tone_cells(cells, dark=True).first().colour == "#3987e5"


def test_semantic_view(spark, tmp_path):
    rng = np.random.default_rng(0)
    base = np.eye(6)[:2]
    v = np.concatenate([base[i] + rng.normal(0, 0.02, (20, 6)) for i in range(2)])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    vectors = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    rows = [(i, f"2026-07-{1 + i % 20:02d}", "tanks and missiles" if i < 20 else "treaty talks", "h", "s", f"u{i}") for i in range(40)]
    view = semantic_view(spark.createDataFrame(rows, "id long, d string, text string, headline string, source string, url string"), vectors, base[0].tolist(), base[1].tolist(), NEWS)
    points = {r.ord: r for r in view["points"].collect()}
    assert len(points) == 40 and points[0].tone > 0 > points[39].tone and all(0 <= r.iso < 0.1 for r in points.values())
    assert not {r.c for i, r in points.items() if i < 20 and r.cluster != -1} & {r.c for i, r in points.items() if i >= 20 and r.cluster != -1}
    labels = {r.label for r in view["clusters"].collect()}
    assert any("tanks" in x or "missiles" in x for x in labels) and any("treaty" in x or "talks" in x for x in labels)
    assert view["heat"].filter("c is null").agg(F.sum("n")).first()[0] == 40
    write_view(view, str(tmp_path / "v"), "now")
    page = spark.read.text(str(tmp_path / "v" / "page.html"), wholetext=True).first().value
    assert page.startswith("<!DOCTYPE")
    assert '"colour":"#' in page, page[-600:]
    assert '"clusters":[{"id":0' in page, page[page.index('clusters') :][:200]


def test_fetch(spark):
    pages = {"http://a": (200, "<p>" + "x" * 50 + "</p>"), "http://b": (404, None)}
    got = fetch_pages(spark.createDataFrame([("http://a",), ("http://b",), ("http://a",), (None,), ("http://c",)], "url string"), opener=lambda u: pages.get(u, (0, None)), parts=2)
    assert {r.url: r.body for r in html.article_bodies(got, NEWS).collect()} == {"http://a": "x" * 50, "http://b": "", "http://c": ""}
    assert get("file:///etc/hostname") == (0, None)


def test_counters(spark):
    rows, seen = metrics.counted(spark.range(10), even=F.col("id") % 2 == 0)
    rows.collect()
    assert seen.get == {"rows": 10, "even": 5}


def test_stamps_of_a_run(spark):
    at = dt.datetime(2026, 7, 12, 21, 48, 16, tzinfo=dt.timezone.utc)
    assert dates.run_stamps(at) == ("2026-07-12 23:48 Amsterdam", "2026-07-12 23:48:16 CEST (UTC+02:00) · Europe/Amsterdam")
    r = dates.scrape_columns(spark.range(1), at).first()
    assert (r.scrape_date, r.scrape_datetime) == ("2026-07-12", "2026-07-12_21.48.16")
    d = spark.createDataFrame([(dt.date(2024, 1, 5), dt.date(2024, 1, 5)), (dt.date(2024, 1, 5), dt.date(2024, 2, 1))], "a date, b date")
    assert [x.s for x in d.select(dates.span_label(F.col("a"), F.col("b")).alias("s")).collect()] == ["5 Jan 2024", "5 Jan – 1 Feb 2024"]


def test_tsne_keeps_groups_apart():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 0.1, (25, 5)) for c in (0, 4)])
    y = layout.tsne(x)
    a, b = y[:25], y[25:]
    assert np.isfinite(y).all() and np.linalg.norm(a.mean(0) - b.mean(0)) > a.std() + b.std()
    assert layout.tsne(np.zeros((2, 3))).shape == (2, 2)


def test_principal_components(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(50, 4)) * [5, 2, 1, 0.1]
    got = {r.id: r.z for r in layout.components_of(spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, v array<double>"), 2).collect()}
    c = x - x.mean(0)
    v = np.linalg.svd(c)[2][:2].T
    assert np.allclose(np.abs(np.array([got[i] for i in range(50)])), np.abs(c @ v), atol=1e-6)


def test_pixels(spark):
    p = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 1.0)], "ord int, x double, y double")
    got = {r.ord: (round(r.px), round(r.py)) for r in report.in_pixels(p, similarity.extents(p, 0.0), 100, 50).collect()}
    assert got == {1: (0, 50), 2: (100, 0)}


def test_vector_cache(spark, tmp_path):
    import pytest

    from heliograph.sources.vectors import cached_vectors, first_that_works, read_cache

    path = str(tmp_path / "cache")
    rows = spark.createDataFrame([("a", "xx"), ("b", "y")], "url string, text string")
    one = cached_vectors(rows.limit(1), path, "content", "Some/Model v1", lambda t: np.array([[len(x), 0.0] for x in t]))
    assert [(r.url, list(r.vec)) for r in one.collect()] == [("a", [1.0, 0.0])]
    both = cached_vectors(rows, path, "content", "Some/Model v1", lambda t: np.array([[0.0, 3.0] for _ in t]))
    assert {r.url: list(r.vec) for r in both.collect()} == {"a": [1.0, 0.0], "b": [0.0, 1.0]}
    assert read_cache(spark, path, "headline", "some-model-v1").count() == 0 and read_cache(spark, path, "content", "some-model-v1").count() == 2

    def broken():
        raise ImportError("no such library")

    assert first_that_works(broken, lambda: len)("ab") == 2
    with pytest.raises(ImportError):
        first_that_works(broken)


def test_headers_by_longest_prefix():
    from heliograph.sources.fetch import headers_of

    sent = {"https://a.example/": {"Accept": "x"}, "https://a.example/news": {"Accept": "y"}}
    assert headers_of("https://a.example/news/1", sent) == {"Accept": "y"} and headers_of("https://a.example/b", sent) == {"Accept": "x"}
    assert headers_of("https://b.example/", sent) == {}


def test_memberships_and_curve():
    d = np.sort(np.random.default_rng(1).random(14))
    w = layout.memberships(d, np.log2(15))
    assert w[0] == 1 and abs(w.sum() - np.log2(15)) < 1e-3 and (np.diff(w) <= 0).all()
    assert (layout.memberships(np.zeros(5), 2.0) == 1).all()
    x = np.linspace(0.01, 3, 300)
    for least in (0.0, 0.1):
        wanted = np.where(x < least, 1, np.exp(-(x - least)))
        miss = lambda a, b: np.square(1 / (1 + a * x ** (2 * b)) - wanted).sum()
        a, b = layout.curve(least)
        assert all(miss(a, b) <= miss(a * f, b * g) + 1e-9 for f in (0.97, 1, 1.03) for g in (0.97, 1, 1.03))


def test_neighbour_layout_keeps_neighbours(spark):
    rng = np.random.default_rng(5)
    group = np.arange(90) % 3
    v = np.eye(8)[group] + rng.normal(0, 0.15, (90, 8))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    rows = spark.createDataFrame([(i * 7, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    one, two = ({r.id: r.z for r in layout.neighbour_layout(rows, k).collect()} for k in (2, 2))
    assert one == two and set(one) == {i * 7 for i in range(90)}
    z = np.array([one[i * 7] for i in range(90)])
    d = np.square(z[:, None] - z[None]).sum(-1)
    np.fill_diagonal(d, np.inf)
    assert (group[d.argsort(1)[:, :5]] == group[:, None]).mean() > 0.95
    assert {len(r.z) for r in layout.neighbour_layout(rows, 5, 0.0).collect()} == {5}
    for n in (0, 1, 2, 3):
        few = layout.neighbour_layout(rows.filter(f"id < {7 * n}")).collect()
        assert len(few) == n and np.isfinite([x for r in few for x in r.z]).all()
    same = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(20)], "id long, v array<double>")
    assert np.isfinite([x for r in layout.neighbour_layout(same).collect() for x in r.z]).all()
