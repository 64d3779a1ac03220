"""Topic filter and multi-label themes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliograph.vocab import Vocabulary


def unicode_case(pattern: str) -> str:
    """Java ignores the case of letters beyond ASCII only when told so; other dialects always do."""
    return pattern.replace("(?i)", "(?iu)", 1)


def on_topic(c: Column, vocabulary: Vocabulary) -> Column:
    """Whether a headline has a topic word; null has none."""
    return F.coalesce(c.rlike(unicode_case(vocabulary.topic)), F.lit(False))


def theme_hits(c: Column, vocabulary: Vocabulary) -> Column:
    """How often each theme's pattern occurs, as an array in theme order."""
    text = F.coalesce(c, F.lit(""))
    return F.array(*[F.regexp_count(text, F.lit(unicode_case(t.pattern))) for t in vocabulary.themes])


def assign(rows: DataFrame, vocabulary: Vocabulary, headline: str = "headline", body: str = "body") -> DataFrame:
    """rows with themes (sorted ids) and theme (the primary).

    Themes are those that the headline hits. Without any, the one theme that
    the body hits most, by rank on a tie, then by lower id. Without that,
    the other theme alone. The primary has most headline hits, then body
    hits, then rank, then the lower id.
    """
    n = len(vocabulary.themes)
    # One column per count: each is read several times, so the plan computes it once. Lambdas would repeat the matching.
    hits = {}
    for t in vocabulary.themes:
        hits[f"__h{t.id}"] = F.regexp_count(F.coalesce(F.col(headline), F.lit("")), F.lit(unicode_case(t.pattern)))
        hits[f"__b{t.id}"] = F.regexp_count(F.coalesce(F.col(body), F.lit("")), F.lit(unicode_case(t.pattern)))
    h, b = [F.col(f"__h{t.id}") for t in vocabulary.themes], [F.col(f"__b{t.id}") for t in vocabulary.themes]
    score = [F.struct(h[i].alias("h"), b[i].alias("b"), F.lit(t.rank).alias("r"), F.lit(-i).alias("o")) for i, t in enumerate(vocabulary.themes)]
    members = F.array_compact(F.array(*[F.when(h[i] > 0, F.lit(i)) for i in range(n)]))
    primary = -F.array_max(F.array(*[F.when(h[i] > 0, score[i]) for i in range(n)]))["o"]
    fallback = -F.array_max(F.array(*[F.when(b[i] > 0, score[i]) for i in range(n)]))["o"]
    found = rows.withColumns(hits).withColumn("theme", F.coalesce(primary, fallback, F.lit(n)))
    # All that the headline hits; else the theme alone.
    return found.withColumn("themes", F.when(F.size(members) > 0, members).otherwise(F.array("theme"))).drop(*hits)


def members(rows: DataFrame, vocabulary: Vocabulary, headline: str = "headline", body: str = "body") -> DataFrame:
    """rows with themes as assign() finds them, without the primary: a headline is matched no further than a theme's first hit, a body only where the headline hits none."""
    patterns = [F.lit(unicode_case(t.pattern)) for t in vocabulary.themes]
    text, n = F.coalesce(F.col(body), F.lit("")), len(patterns)
    found = rows.withColumn("__m", F.array_compact(F.array(*[F.when(F.coalesce(F.col(headline), F.lit("")).rlike(unicode_case(t.pattern)), F.lit(i)) for i, t in enumerate(vocabulary.themes)])))
    hits = F.array(*[F.struct(F.regexp_count(text, p).alias("b"), F.lit(t.rank).alias("r"), F.lit(-i).alias("o")) for i, (p, t) in enumerate(zip(patterns, vocabulary.themes))])
    best = F.array_max(hits)
    fallback = F.transform(F.array(best), lambda x: F.when(x["b"] > 0, -x["o"]).otherwise(F.lit(n)))
    return found.withColumn("themes", F.when(F.size("__m") > 0, F.col("__m")).otherwise(fallback)).drop("__m")


# Before an inner explode, Spark filters for arrays that have elements, and so computes them twice; explode_outer doesn't, and themes are never empty.


def theme_counts(assigned: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """id, label and count of members, most first; themes without members are left out."""
    labels = F.array(*[F.lit(x) for x in vocabulary.labels])
    counted = assigned.select(F.explode_outer("themes").alias("id")).groupBy("id").agg(F.count("*").alias("count"))
    return counted.select("id", F.element_at(labels, F.col("id") + 1).alias("label"), "count").orderBy(F.desc("count"), "id")


def theme_terms(assigned: DataFrame, weights: DataFrame, key: str = "ord", k: int | None = 5) -> DataFrame:
    """id, rank, term and mean weight of each theme's top terms (all with None). ``weights(key, term, w)`` is sparse: an absent weight counts as 0.

    Weights that have their row's themes too need no join with the rows.
    """
    member = assigned.select(key, F.explode_outer("themes").alias("id"))
    sizes = member.groupBy("id").agg(F.count("*").alias("n"))
    each = weights.select(F.explode_outer("themes").alias("id"), "term", "w") if "themes" in weights.columns else member.join(weights, key)
    summed = each.groupBy("id", "term").agg(F.sum("w").alias("s")).join(sizes, "id")
    order = Window.partitionBy("id").orderBy(F.desc("mean_w"), "term")
    ranked = summed.withColumn("mean_w", F.col("s") / F.col("n")).withColumn("rank", F.row_number().over(order)).select("id", "rank", "term", "mean_w")
    return ranked if k is None else ranked.filter(F.col("rank") <= k)


def theme_centroids(points: DataFrame) -> DataFrame:
    """id, cx, cy: means to three decimals over ``points(themes, x, y)``."""
    return points.select(F.explode_outer("themes").alias("id"), "x", "y").groupBy("id").agg(F.bround(F.avg("x"), 3).alias("cx"), F.bround(F.avg("y"), 3).alias("cy"))


def theme_names(themes: Column, vocabulary: Vocabulary) -> Column:
    labels = F.array(*[F.lit(x) for x in vocabulary.labels])
    return F.array_join(F.transform(themes, lambda i: F.element_at(labels, i + 1)), "; ")


def also_tags(themes: Column, current: Column | int, vocabulary: Vocabulary) -> Column:
    """The names of an article's other themes."""
    return theme_names(F.array_except(themes, F.array(current if isinstance(current, Column) else F.lit(current))), vocabulary)
