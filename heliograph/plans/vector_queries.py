"""Vectors, tone, clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from heliograph.functions.numbers import sixths
from heliograph.functions.vectors import unit
from heliograph.operators import clusters, layout, report, similarity
from heliograph.plans.registry import query
from heliograph.plans.tables import articles, days, table, vectors

_V = "vec AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"
_UNIT = "list_transform(v, lambda x: x / sqrt(list_dot_product(v, v)))"


@query(f"WITH {_V} SELECT id, floor(list_sum({_UNIT}) * 1000000 + 0.5) / 1000000 AS total, floor({_UNIT}[1] * 1000000 + 0.5) / 1000000 AS first FROM vec")
def vector_normalize(spark, sf_dir):
    rows = vectors(spark, sf_dir).select("id", unit(F.col("v")).alias("u"))
    return rows.select("id", sixths(F.aggregate("u", F.lit(0.0), lambda s, x: s + x)).alias("total"), sixths(F.col("u")[0]).alias("first"))


#: The rows that neighbours are asked for: every fiftieth, against all rows.
_ASKED = f"""{_V}, sims AS (SELECT a.id AS id, b.id AS other, list_dot_product(a.v, b.v) AS sim FROM vec a JOIN vec b ON a.id <> b.id WHERE a.id % 50 = 0),
near AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY sim DESC, other) AS rank, other, sim FROM sims QUALIFY rank <= 5)"""


def _near(spark, sf_dir):
    v = vectors(spark, sf_dir)
    return similarity.neighbours(v, v.filter("id % 50 = 0"))


@query(f"WITH {_ASKED} SELECT id, rank, other, floor(sim * 1000000 + 0.5) / 1000000 AS sim FROM near")
def knn_top5(spark, sf_dir):
    return _near(spark, sf_dir).select("id", F.col("rank").cast("bigint").alias("rank"), "other", sixths(F.col("sim")).alias("sim"))


@query(f"WITH {_ASKED} SELECT id, floor((1 - sim) * 1000000 + 0.5) / 1000000 AS iso FROM near WHERE rank = 1")
def isolation(spark, sf_dir):
    return similarity.isolation(_near(spark, sf_dir)).withColumn("iso", sixths(F.col("iso")))


@query(f"WITH {_ASKED} SELECT id, floor((1 - sim) * 1000000 + 0.5) / 1000000 AS iso FROM near WHERE rank = 1 ORDER BY 1 - sim DESC, id LIMIT 20")
def anomalies_top20(spark, sf_dir):
    return similarity.most_isolated(similarity.isolation(_near(spark, sf_dir))).withColumn("iso", sixths(F.col("iso")))


@query(
    f"WITH {_ASKED}, votes AS (SELECT n.id, v.label AS theirs, count(*) AS votes FROM near n JOIN vec v ON v.id = n.other GROUP BY n.id, v.label) "
    "SELECT s.id, vec.label, theirs AS majority, votes FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY votes DESC, theirs) AS k FROM votes) s JOIN vec USING (id) WHERE k = 1"
)
def neighbour_majority(spark, sf_dir):
    return similarity.neighbour_majority(_near(spark, sf_dir), vectors(spark, sf_dir).select("id", "label"))


def _anchors(spark, sf_dir, label: int) -> list[float]:
    return similarity.centroid(vectors(spark, sf_dir).filter(F.col("label") == label).orderBy("id").limit(5))


def _anchor_sql(label: int, name: str) -> str:
    return f"""{name}0 AS (SELECT unnest({_UNIT}) AS x, generate_subscripts(v, 1) AS i FROM (SELECT v FROM vec WHERE label = {label} ORDER BY id LIMIT 5)),
{name}1 AS (SELECT i, avg(x) AS x FROM {name}0 GROUP BY i), {name} AS (SELECT i, x / (SELECT sqrt(sum(x * x)) FROM {name}1) AS x FROM {name}1)"""


@query(f"WITH {_V}, {_anchor_sql(0, 'up')} SELECT i - 1 AS i, floor(x * 1000000 + 0.5) / 1000000 AS x FROM up")
def anchor_centroid(spark, sf_dir):
    c = _anchors(spark, sf_dir, 0)
    return spark.createDataFrame(list(enumerate(c)), "i bigint, x double").withColumn("x", sixths(F.col("x")))


_TONE = f"""{_V}, {_anchor_sql(0, 'up')}, {_anchor_sql(1, 'down')},
raw AS (SELECT id, list_dot_product(v, (SELECT list(x ORDER BY i) FROM up)) - list_dot_product(v, (SELECT list(x ORDER BY i) FROM down)) AS raw FROM vec),
mid AS (SELECT id, raw - (SELECT median(raw) FROM raw) AS raw FROM raw), scale AS (SELECT quantile_cont(abs(raw), 0.95) AS s FROM mid),
tone AS (SELECT id, greatest(-1, least(1, raw / (SELECT CASE WHEN s = 0 THEN 1 ELSE s END FROM scale))) AS tone FROM mid)"""


def _tone(spark, sf_dir):
    return similarity.tone(vectors(spark, sf_dir), _anchors(spark, sf_dir, 0), _anchors(spark, sf_dir, 1))


@query(f"WITH {_TONE} SELECT id, floor(tone * 1000000 + 0.5) / 1000000 AS tone FROM tone")
def tone_score(spark, sf_dir):
    return _tone(spark, sf_dir).withColumn("tone", sixths(F.col("tone")))


def _toned(spark, sf_dir):
    d = days(spark, sf_dir).select(F.col("event_id").alias("id"), "d")
    labels = vectors(spark, sf_dir).select("id", F.col("label").alias("c"))
    return _tone(spark, sf_dir).join(labels, "id").join(d, "id")


_POINTS = f"""{_TONE}, pts AS (SELECT vec.id, label AS c, CAST(date_trunc('week', ts) AS DATE) AS week, round_even(tone * 1000, 0) / 1000 AS t FROM tone JOIN vec USING (id) JOIN events ON event_id = vec.id)"""


@query(f"WITH {_POINTS} SELECT c, week, round_even(avg(t) * 1000, 0) / 1000 AS m, count(*) AS n FROM pts WHERE c <> 3 GROUP BY c, week")
def tone_heatmap(spark, sf_dir):
    """Cells per cluster and week; cluster 3 stands for noise."""
    return similarity.tone_heatmap(_toned(spark, sf_dir), F.col("c") == 3).filter("c is not null")


@query(f"WITH {_POINTS} SELECT week, round_even(avg(t) * 1000, 0) / 1000 AS m, count(*) AS n FROM pts GROUP BY week")
def tone_weekly(spark, sf_dir):
    """The line over all, noise included."""
    return similarity.tone_heatmap(_toned(spark, sf_dir), F.col("c") == 3).filter("c is null").drop("c")


_INK = "CAST(floor({m} + (CASE WHEN m < 0 THEN {a} ELSE {z} END - {m}) * abs(m) + 0.5) AS INTEGER)"
_RGB = [_INK.format(a=a, m=m, z=z) for a, m, z in ((42, 240, 208), (120, 239, 59), (214, 236, 59))]


@query(
    f"WITH {_POINTS}, cell AS (SELECT c, week, round_even(avg(t) * 1000, 0) / 1000 AS m FROM pts WHERE c <> 3 GROUP BY c, week), rgb AS (SELECT *, {_RGB[0]} AS r, {_RGB[1]} AS g, {_RGB[2]} AS b FROM cell) "
    "SELECT c, week, format('#{:02x}{:02x}{:02x}', r, g, b) AS colour, CASE WHEN 0.299 * r + 0.587 * g + 0.114 * b > 150 THEN 'rgba(0,0,0,.62)' ELSE 'rgba(255,255,255,.82)' END AS ink FROM rgb"
)
def tone_colours(spark, sf_dir):
    """The cells of the heat map in colour, with an ink that reads on it."""
    cells = similarity.tone_heatmap(_toned(spark, sf_dir), F.col("c") == 3).filter("c is not null")
    return report.tone_cells(cells).select("c", "week", "colour", "ink")


@query("WITH s AS (SELECT label AS cluster, count(*) AS size FROM embeddings GROUP BY label) SELECT cluster, row_number() OVER (ORDER BY cluster = 2, size DESC, cluster) - 1 AS id, size FROM s")
def cluster_renumber(spark, sf_dir):
    """Labels by size; label 2 stands for noise and comes last."""
    return similarity.renumber(vectors(spark, sf_dir), "label", noise=2).withColumn("id", F.col("id").cast("bigint"))


_PLANE = f"{_V}, p AS (SELECT id AS ord, v[1] * 100 AS x, v[2] * 100 AS y FROM vec)"


def _plane(spark, sf_dir):
    return vectors(spark, sf_dir).select(F.col("id").alias("ord"), (F.col("v")[0].cast("double") * 100).alias("x"), (F.col("v")[1].cast("double") * 100).alias("y"))


@query(f"WITH {_PLANE}, d AS (SELECT *, (x - 1) * (x - 1) + (y - 2) * (y - 2) AS d2 FROM p) SELECT ord, floor(d2 * 1000000 + 0.5) / 1000000 AS d2 FROM d WHERE d2 < 169 ORDER BY d.d2, ord LIMIT 1")
def nearest_point(spark, sf_dir):
    return similarity.nearest_point(_plane(spark, sf_dir), 1.0, 2.0).select("ord", sixths(F.col("d2")).alias("d2"))


@query(f"WITH {_PLANE}, m AS (SELECT min(x) AS a, max(x) AS b, min(y) AS c, max(y) AS d FROM p) SELECT " + ", ".join(f"floor(({v} {s} 0.08 * ({z} - {a})) * 1000000 + 0.5) / 1000000 AS {n}" for v, s, a, z, n in (("a", "-", "a", "b", "lo_x"), ("b", "+", "a", "b", "hi_x"), ("c", "-", "c", "d", "lo_y"), ("d", "+", "c", "d", "hi_y"))) + " FROM m")
def plane_extents(spark, sf_dir):
    e = similarity.extents(_plane(spark, sf_dir))
    return e.select(*[sixths(F.col(c)).alias(c) for c in ("lo_x", "hi_x", "lo_y", "hi_y")])


@query()
def density_clusters(spark, sf_dir):
    """Leaves of the single-linkage tree over the five leading principal components."""
    v = vectors(spark, sf_dir)
    return clusters.density_clusters(layout.components_of(v, max(1, min(5, v.count() - 2))).withColumnRenamed("z", "v"))


@query()
def neighbour_layout(spark, sf_dir):
    """Vectors on the plane by their neighbour graph."""
    v = vectors(spark, sf_dir).select("id", unit(F.col("v")).alias("v"))
    return layout.plane(layout.neighbour_layout(v).withColumnRenamed("id", "ord"))


@query()
def embed_documents(spark, sf_dir):
    """Vectors of the documents that a cache, here the labels, lacks; by the built-in encoder."""
    rows = articles(spark, sf_dir).select("url", F.col("body").alias("text"))
    cached = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("url"))
    return similarity.embed_new(rows, cached)


def _channel(n: int, s: float, l: float) -> str:  # noqa: E741
    turn = f"fmod({n} + fmod(i * 137.508::DOUBLE, 360) / 30, 12)"
    return f"format('{{:02x}}', CAST(round_even(({l} - {s} * {min(l, 1 - l)} * greatest(-1, least({turn} - 3, 9 - {turn}, 1))) * 255, 0) AS INTEGER))"


def _colour(s: float, l: float) -> str:  # noqa: E741
    return "'#' || " + " || ".join(_channel(n, s, l) for n in (0, 8, 4))


@query(f"SELECT i AS id, {_colour(0.62, 0.46)} AS color, {_colour(0.68, 0.62)} AS color_dark FROM (SELECT CAST(unnest(generate_series(0, count(DISTINCT label) - 1)) AS INTEGER) AS i FROM embeddings)".replace("137.508::DOUBLE", "CAST(137.508 AS DOUBLE)"))
def cluster_palette(spark, sf_dir):
    k = vectors(spark, sf_dir).select("label").distinct().count()
    light, dark = similarity.palette(k)
    return spark.createDataFrame(list(zip(range(k), light, dark)), "id int, color string, color_dark string")
