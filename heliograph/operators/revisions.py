"""Articles whose headline changed after publication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliograph.functions.dates import local_label
from heliograph.operators.archive import keep_first
from heliograph.operators.themes import on_topic
from heliograph.vocab import Vocabulary


def article_id(url: Column, pattern: str = r"news\.err\.ee/(\d+)") -> Column:
    """The first group of the pattern, null where it isn't found."""
    return F.nullif(F.regexp_extract(url, pattern, 1), F.lit(""))


def revision_history(rows: DataFrame, vocabulary: Vocabulary | None = None, same_url: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """aid, n, versions and last from ``rows(aid, url, headline, at, ord)``: articles seen under two or more headlines.

    The first row of each url counts (all rows with ``same_url``). Of each
    headline the first sighting is a version, h, u and t and what is to be
    carried along; versions are in order of time, nulls last, ties by ord.
    With a vocabulary, an article stays if any version is on topic. Newest
    change first; ties by aid.
    """
    rows = rows.filter("aid is not null and headline is not null and url is not null").withColumn("unknown", F.col("at").isNull())
    if not same_url:
        rows = keep_first(rows, "url", "unknown", "at", "ord")
    seen = F.struct("unknown", "at", "ord")
    versions = rows.groupBy("aid", "headline").agg(F.min(seen).alias("s"), F.min_by(F.struct("url", *carry), seen).alias("of"))
    version = F.struct(F.col("s.unknown").alias("unknown"), F.col("s.at").alias("at"), F.col("s.ord").alias("ord"), "headline", "of")
    topical = on_topic(F.col("headline"), vocabulary) if vocabulary else F.lit(True)
    found = versions.groupBy("aid").agg(F.array_sort(F.collect_list(version)).alias("v"), F.bool_or(topical).alias("topical")).filter("topical and size(v) >= 2")
    told = F.transform("v", lambda x: F.struct(x["headline"].alias("h"), x["of"]["url"].alias("u"), x["at"].alias("t"), *[x["of"][c].alias(c) for c in carry]))
    return found.select("aid", F.size("v").alias("n"), told.alias("versions"), F.element_at("v", -1)["at"].alias("last")).orderBy(F.desc_nulls_last("last"), "aid")


def revision_steps(rows: DataFrame) -> DataFrame:
    """aid, version (from 1), h and previous: each headline of an article with the one before, from ``rows(aid, headline, at)``."""
    first = rows.groupBy("aid", F.col("headline").alias("h")).agg(F.min("at").alias("t"))
    order = Window.partitionBy("aid").orderBy("t", "h")
    return first.select("aid", F.row_number().over(order).alias("version"), "h", F.lag("h").over(order).alias("previous"))


def edits(articles: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """id, source, n, versions(h, u, d, t) and last of articles on topic whose headline changed.

    From ``articles(ord, source, url, headline, date)`` and, where there is
    one, stamp. source is the label of the first version's, t the time as a
    local label; last is the raw stamp. Only urls with an article's number
    can be followed.
    """
    at = F.coalesce(F.col("stamp"), F.col("date").cast("string")) if "stamp" in articles.columns else F.col("date").cast("string")
    rows = articles.select("ord", "source", "url", "headline", F.col("date").cast("string").alias("d"), at.alias("at"), article_id(F.col("url")).alias("aid"))
    found = revision_history(rows, vocabulary, carry=("d", "source"))
    labels = F.create_map(*[F.lit(x) for s in vocabulary.sources for x in (s.name, s.label)]) if vocabulary.sources else F.create_map().cast("map<string,string>")
    version = lambda x: F.struct(x["h"].alias("h"), x["u"].alias("u"), x["d"].alias("d"), local_label(x["t"]).alias("t"))
    label = F.coalesce(F.try_element_at(labels, F.col("versions")[0]["source"]), F.lit(""))
    return found.select(F.col("aid").alias("id"), label.alias("source"), "n", F.transform("versions", version).alias("versions"), "last")
