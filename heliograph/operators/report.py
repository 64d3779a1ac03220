"""Tables that a report shows, and its nested payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph.operators.themes import also_tags, theme_names
from heliograph.vocab import Vocabulary


def corpus_text(headline: str = "headline", body: str = "body") -> Column:
    return F.concat(F.coalesce(F.col(headline), F.lit("")), F.lit(". "), F.coalesce(F.col(body), F.lit("")))


def points(articles: DataFrame) -> DataFrame:
    """Short-named points: x, y to three decimals, theme, themes, headline, source, date, url."""
    return articles.select(
        F.bround("x", 3).alias("x"), F.bround("y", 3).alias("y"), F.col("theme").alias("c"), F.col("themes").alias("cs"),
        F.col("headline").alias("h"), F.col("source").alias("s"), F.col("date").cast("string").alias("d"), F.col("url").alias("u"),
    )


def theme_cards(articles: DataFrame, theme: int, vocabulary: Vocabulary) -> DataFrame:
    """An opened theme card: its articles, newest first, with their other themes."""
    return articles.filter(F.array_contains("themes", theme)).select("ord", "d", "h", also_tags(F.col("themes"), theme, vocabulary).alias("also")).orderBy(F.desc("d"), "ord")


def visible(rows: DataFrame, hidden: list[int], column: str = "c") -> DataFrame:
    return rows.filter(~F.col(column).isin(hidden)) if hidden else rows


def header(articles: DataFrame, generated: str) -> DataFrame:
    """One row: articles, sources, themes, and the day of the stamp."""
    return articles.agg(F.count("*").alias("articles"), F.count_distinct("source").alias("sources"), F.count_distinct("theme").alias("themes")).withColumn("updated", F.substring_index(F.lit(generated), " ", 1))


def bars(frequency: DataFrame, width: float = 100.0) -> DataFrame:
    """frequency with the width of each bar; the most frequent term has all of it."""
    most = frequency.agg(F.greatest(F.lit(1), F.coalesce(F.max("n"), F.lit(0))).alias("most"))
    return frequency.crossJoin(F.broadcast(most)).select("term", "n", (F.col("n") / F.col("most") * width).alias("width"))


def tagged_rows(articles: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """url, headline, source, scrape_date, theme, theme_name, all_themes: one flat row per article."""
    name = theme_names(F.array("theme"), vocabulary)
    return articles.select("url", "headline", "source", F.col("date").cast("string").alias("scrape_date"), "theme", name.alias("theme_name"), theme_names(F.col("themes"), vocabulary).alias("all_themes"))


def write_tagged(articles: DataFrame, vocabulary: Vocabulary, path: str) -> None:
    tagged_rows(articles, vocabulary).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def homes(vocabulary: Vocabulary) -> Column:
    """A map from area code to home page."""
    return F.create_map(*[F.lit(x) for s in vocabulary.sources for x in (s.code, s.home)])


def home_rows(spark: SparkSession, vocabulary: Vocabulary) -> DataFrame:
    """code and home of each source."""
    return spark.createDataFrame([(s.code, s.home) for s in vocabulary.sources], "code string, home string")


#: How the lists of a report are ordered; a minus stands for descending. Others go by their columns.
ORDERS = {"shares": ("-pct",), "themes": ("-count",), "keywords": ("-n",)}


def payload(generated: str, full: str | None = None, orders: dict[str, tuple[str, ...]] = ORDERS, **tables: DataFrame) -> DataFrame:
    """One JSON text: each table as a list of objects, by the columns of its order and then by all. For tables of a report's size.

    ``generated`` and ``full`` are the short and the full stamp of the run.
    """
    one = None
    for name, t in tables.items():
        keys = [(-F.col(c[1:]) if c[0] == "-" else F.col(c)).alias(f"k{i}") for i, c in enumerate(orders.get(name, ())) if c.lstrip("-") in t.columns]
        in_order = F.sort_array(F.collect_list(F.struct(*keys, F.struct(*t.columns).alias("row"))))
        listed = t.agg(F.transform(in_order, lambda x: x["row"]).alias(name))
        one = listed if one is None else one.crossJoin(listed)
    stamps = [F.lit(generated).alias("generated"), *([F.lit(full).alias("generatedFull")] if full else [])]
    return one.select(F.to_json(F.struct(*stamps, *tables)).alias("json"))


def page(json_text: str, template: str, token: str = "__PAYLOAD__") -> str:
    """A template with the payload in place of the token."""
    return template.replace(token, json_text.replace("</", "<\\/"))


def tone_cells(cells: DataFrame, dark: bool = False, tone: str = "m") -> DataFrame:
    """cells with colour and ink: from blue over a neutral middle to red as tone goes from -1 to 1, and black or white, whichever reads on it."""
    # Fixed values, which the report's legend shares.
    low, middle, high = ((57, 135, 229), (56, 56, 53), (208, 59, 59)) if dark else ((42, 120, 214), (240, 239, 236), (208, 59, 59))
    t = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col(tone)))
    parts = [F.floor(m + (F.when(t < 0, a).otherwise(z) - m) * F.abs(t) + 0.5).cast("int") for a, m, z in zip(low, middle, high)]
    light = 0.299 * parts[0] + 0.587 * parts[1] + 0.114 * parts[2]
    return cells.withColumns({"colour": F.format_string("#%02x%02x%02x", *parts), "ink": F.when(light > 150, "rgba(0,0,0,.62)").otherwise("rgba(255,255,255,.82)")})


def in_pixels(points: DataFrame, extents: DataFrame, width: float, height: float) -> DataFrame:
    """points with px and py: x from the left, y from the bottom, scaled to the extents."""
    one = points.crossJoin(F.broadcast(extents))
    px = (F.col("x") - F.col("lo_x")) / (F.col("hi_x") - F.col("lo_x")) * width
    py = height - (F.col("y") - F.col("lo_y")) / (F.col("hi_y") - F.col("lo_y")) * height
    return one.withColumns({"px": px, "py": py}).select(*points.columns, "px", "py")


def cluster_table(renumbered: DataFrame, labels: DataFrame, colours: tuple[list[str], list[str]], noise: int = -1, grey: tuple[str, str] = ("#8f8677", "#847b6c")) -> DataFrame:
    """id, label, keywords, size, color, colorDark of what renumber() and terms.cluster_labels() give; clusters without words are called by their number."""
    words = labels.select("cluster", F.col("words").alias("keywords"))
    light, dark = (F.array(*[F.lit(x) for x in c]) for c in colours)
    is_noise = F.col("cluster") == noise
    named = F.coalesce(F.nullif(F.array_join(F.slice("keywords", 1, 2), " · "), F.lit("")), F.concat(F.lit("topic "), (F.col("id") + 1).cast("string")))
    return renumbered.join(words, "cluster", "left").select(
        "id",
        F.when(is_noise, F.lit("Unclustered")).otherwise(named).alias("label"),
        F.when(is_noise, F.array().cast("array<string>")).otherwise(F.coalesce("keywords", F.array().cast("array<string>"))).alias("keywords"),
        "size",
        F.when(is_noise, F.lit(grey[0])).otherwise(F.get(light, "id")).alias("color"),
        F.when(is_noise, F.lit(grey[1])).otherwise(F.get(dark, "id")).alias("colorDark"),
    )


TEMPLATE = """<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>Report</title></head>
<body><script id="data" type="application/json">__PAYLOAD__</script></body></html>"""


#: The same without a frame of its own, to be put into another page.
CONTENT = """<script id="data" type="application/json">__PAYLOAD__</script>"""


def template_of(spark: SparkSession, path: str) -> str:
    """A template kept as a text file in any store that Spark reads."""
    return spark.read.text(path, wholetext=True).first()[0]


def write_report(payload_row: DataFrame, folder: str, template: str = TEMPLATE, content: str = CONTENT) -> None:
    """payload.json, page.html and content.html in a folder, each one text file in Spark's layout, by way of Spark's writers."""
    text = payload_row.first()[0]
    for name, value in (("payload.json", text), ("page.html", page(text, template)), ("content.html", page(text, content))):
        payload_row.sparkSession.createDataFrame([(value,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/{name}")
