"""Whole reports: from articles and bodies to tables, and from vectors to the semantic view."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph.operators import clusters as density
from heliograph.operators import layout, metrics, report, revisions, shares, similarity, terms, themes
from heliograph.scratch import settle
from heliograph.vocab import LABEL_STOP, Vocabulary, english_stop_words


def topic_report(articles: DataFrame, bodies: DataFrame, vocabulary: Vocabulary) -> dict[str, DataFrame]:
    """Tables of a report over ``articles(ord, source, url, headline, date)``, with stamp if there is one, and ``bodies(url, body)``.

    Only articles on topic go on; each table is a lazy plan over them. edits
    looks at all articles, as one version on topic is enough.
    """
    stop = sorted({*english_stop_words(), *vocabulary.stop})
    sources = articles.sparkSession.createDataFrame([(s.name, s.rank, s.code, s.label) for s in vocabulary.sources], "source string, rank int, code string, country string")
    topical = themes.on_topic(F.col("headline"), vocabulary)
    share = shares.topic_shares(sources, articles, topical)
    matched = articles.filter(topical).join(bodies, "url", "left").withColumn("body", F.coalesce("body", F.lit("")))
    matched = settle(themes.assign(matched, vocabulary).withColumn("text", report.corpus_text()), "matched")
    n = matched.count()
    weights = settle(terms.weights_of(settle(terms.words_of(matched, stop), "words"), n), "weights")
    placed = matched.join(layout.tsne_plane(layout.lsa(weights, n)), "ord", "left").fillna(0.0, ["x", "y"])
    postings = terms.keyword_postings(matched, Vocabulary(vocabulary.stems, vocabulary.words, vocabulary.themes, stop=tuple(stop), more_stop=vocabulary.more_stop, variants=vocabulary.variants))
    return {
        "shares": share,
        "coverage": shares.coverage(share),
        "themes": themes.theme_counts(matched, vocabulary).join(themes.theme_centroids(placed), "id", "left").join(_top(themes.theme_terms(matched, weights)), "id", "left"),
        "points": report.points(placed),
        "keywords": terms.keyword_articles(postings, terms.keyword_frequency(postings)),
        "tagged": report.tagged_rows(matched, vocabulary),
        "edits": revisions.edits(articles, vocabulary),
        "homes": report.home_rows(articles.sparkSession, vocabulary),
        "colours": _colours(articles.sparkSession, len(vocabulary.labels)),
    }


def run_report(articles: DataFrame, bodies: DataFrame, vocabulary: Vocabulary, folder: str, generated: str, full: str | None = None, log: Callable[[str], None] = print) -> dict[str, dict[str, int]]:
    """Writes topic_report() to a folder as tagged rows, payload and pages, and returns and logs the counters of the run.

    Counters are gathered by the plans that write; no table is read for them.
    """
    seen, of_articles = metrics.counted(articles, topical=themes.on_topic(F.col("headline"), vocabulary), untitled=F.col("headline").isNull())
    had, of_bodies = metrics.counted(bodies, empty=F.coalesce(F.trim("body"), F.lit("")) == "")
    tables = topic_report(seen, had, vocabulary)
    tagged, of_tagged = metrics.counted(tables["tagged"])
    tagged.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{folder}/tagged")
    named = [k for k in ("shares", "coverage", "themes", "points", "keywords", "edits", "homes", "colours") if k in tables]
    kept = {k: metrics.counted(tables[k]) for k in named}
    one = settle(report.payload(generated, full, **{k: t for k, (t, _) in kept.items()}), "payload")
    report.write_report(one, folder)
    found = {"filter": of_articles.get, "fetch": of_bodies.get, "tagged": of_tagged.get} | {k: o.get for k, (_, o) in kept.items()}
    for name, counts in found.items():
        log(f"[{name}] " + ", ".join(f"{n} {k}" for k, n in counts.items()))
    return found


def _colours(spark: SparkSession, k: int) -> DataFrame:
    """id, color and colorDark of k themes."""
    light, dark = similarity.palette(k)
    return spark.createDataFrame(list(zip(range(k), light, dark)), "id int, color string, colorDark string")


def _top(ranked: DataFrame) -> DataFrame:
    return ranked.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda x: x["term"]), ", ").alias("kw"))


def semantic_view(articles: DataFrame, vectors: DataFrame, up: list[float], down: list[float], vocabulary: Vocabulary) -> dict[str, DataFrame]:
    """points, clusters and heat over ``articles(id, d, text, headline, source, url)`` and unit ``vectors(id, v)`` of them."""
    near = settle(similarity.neighbours(vectors, vectors, 14), "near")  # once for all that follows
    plane = layout.plane(layout.neighbour_layout(vectors, 2, 0.1, found=near).withColumnRenamed("id", "ord")).withColumnRenamed("ord", "id")
    iso = similarity.isolation(near)
    low = layout.neighbour_layout(vectors, 5, 0.0, found=near).withColumnRenamed("z", "v")
    raw = settle(density.density_clusters(low), "clusters")
    rows = articles.join(raw, "id")
    stop = sorted({*english_stop_words(), *vocabulary.stop, *vocabulary.more_stop, *LABEL_STOP})
    ranked = terms.class_terms(rows.select("cluster", F.col("id").alias("ord"), "text"), stop)
    numbered = similarity.renumber(raw)
    clusters = report.cluster_table(numbered, terms.cluster_labels(ranked), similarity.palette(numbered.filter("cluster <> -1").count()))
    tone = similarity.tone(vectors, up, down)
    points = rows.join(numbered.withColumnRenamed("id", "c"), "cluster").join(plane, "id").join(iso, "id", "left").join(tone, "id")
    points = points.select(
        F.bround("x", 3).alias("x"), F.bround("y", 3).alias("y"), F.col("headline").alias("h"), F.col("source").alias("s"), "d", F.col("url").alias("u"),
        F.col("id").alias("ord"), "cluster", "c", F.bround("iso", 3).alias("iso"), F.bround("tone", 3).alias("tone"),
    )
    return {"points": points, "clusters": clusters, "heat": similarity.tone_heatmap(points, F.col("cluster") == -1)}


def write_view(view: dict[str, DataFrame], folder: str, generated: str, full: str | None = None) -> None:
    """The semantic view as a page of its own: payload, page and content alone, with the cells of the heat map in colour."""
    cells = report.tone_cells(view["heat"].filter("c is not null"))
    one = settle(report.payload(generated, full, points=view["points"], clusters=view["clusters"], heat=cells), "view")
    report.write_report(one, folder)
