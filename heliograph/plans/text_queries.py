"""Tokens, keywords, themes, TF-IDF, HTML, report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from heliograph.functions.numbers import sixths
from heliograph.functions.text import canonical, letter_runs, slug, without, word_tokens
from heliograph.operators import html, layout, report, terms, themes
from heliograph.plans.registry import query
from heliograph.plans.tables import ARTICLES, articles, table
from heliograph.scratch import settle
from heliograph.vocab import PROSE

_N = len(PROSE.themes)
_STOP = sorted({*PROSE.stop, *PROSE.more_stop})


def _in(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in sorted(words)) + ")"


def _canon(t: str) -> str:
    table_ = " ".join(f"WHEN {t} = '{k}' THEN '{v}'" for k, v in PROSE.variants.items())
    return (
        f"CASE {table_} WHEN length({t}) > 5 AND ends_with({t}, 'ies') THEN left({t}, length({t}) - 3) || 'y' "
        f"WHEN length({t}) > 4 AND ends_with({t}, 's') AND NOT ends_with({t}, 'ss') THEN left({t}, length({t}) - 1) ELSE {t} END"
    )


_POSTINGS = f"""{ARTICLES}, raw AS (SELECT ord, unnest(regexp_extract_all(lower(headline), '[a-z]{{2,}}')) AS t FROM art),
base AS (SELECT ord, {_canon('t')} AS term FROM raw WHERE length(t) >= 3 AND t NOT IN {_in(_STOP)}),
post AS (SELECT DISTINCT ord, term FROM base WHERE length(term) >= 3 AND term NOT IN {_in(_STOP)})"""


@query(f"WITH {ARTICLES}, raw AS (SELECT ord, unnest(regexp_extract_all(lower(headline), '[a-z]{{2,}}')) AS t FROM art) SELECT ord, t AS token, {_canon('t')} AS base, count(*) AS n FROM raw GROUP BY ord, t")
def canonical_tokens(spark, sf_dir):
    rows = articles(spark, sf_dir).select("ord", F.explode_outer(letter_runs(F.col("headline"))).alias("token")).filter("token is not null")
    return rows.groupBy("ord", "token").agg(F.count("*").alias("n")).select("ord", "token", canonical(F.col("token"), PROSE.variants).alias("base"), "n")


_WORDS = "regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}_]+')"


@query(f"WITH {ARTICLES}, raw AS (SELECT ord, unnest({_WORDS.format('body')}) AS t FROM art) SELECT ord, count(*) AS n, count(DISTINCT t) AS kinds FROM raw WHERE regexp_full_match(t, '[a-z]{{2,}}') GROUP BY ord")
def word_token_counts(spark, sf_dir):
    rows = articles(spark, sf_dir).select("ord", F.explode_outer(word_tokens(F.col("body"))).alias("t")).filter("t is not null")
    return rows.groupBy("ord").agg(F.count("*").alias("n"), F.count_distinct("t").alias("kinds"))


@query(f"WITH {_POSTINGS} SELECT term, count(*) AS n FROM post GROUP BY term ORDER BY n DESC, term LIMIT 16")
def keyword_frequency(spark, sf_dir):
    return terms.keyword_frequency(terms.keyword_postings(articles(spark, sf_dir), PROSE))


@query(f"WITH {_POSTINGS} SELECT ord, term FROM post")
def keyword_postings(spark, sf_dir):
    return terms.keyword_postings(articles(spark, sf_dir), PROSE)


@query(f"WITH {_POSTINGS}, top AS (SELECT term, count(*) AS n FROM post GROUP BY term ORDER BY n DESC, term LIMIT 16) SELECT term, n, ord FROM post JOIN top USING (term)")
def keyword_articles(spark, sf_dir):
    posts = terms.keyword_postings(articles(spark, sf_dir), PROSE)
    return terms.keyword_article_rows(posts, terms.keyword_frequency(posts))


@query(f"WITH {_POSTINGS}, f AS (SELECT term, count(*) AS n FROM post GROUP BY term ORDER BY n DESC, term LIMIT 16) SELECT term, n, n / (SELECT max(n) FROM f) * 100.0::DOUBLE AS width FROM f".replace("100.0::DOUBLE", "CAST(100 AS DOUBLE)"))
def keyword_bars(spark, sf_dir):
    return report.bars(terms.keyword_frequency(terms.keyword_postings(articles(spark, sf_dir), PROSE)))


_HITS = f"""{ARTICLES}, hit AS (""" + " UNION ALL ".join(
    f"SELECT ord, source, date, headline, url, {t.id} AS id, {t.rank} AS rk, len(regexp_extract_all(headline, '{t.pattern}')) AS hh, len(regexp_extract_all(body, '{t.pattern}')) AS bb FROM art" for t in PROSE.themes
) + f"""), member AS (SELECT * FROM hit WHERE hh > 0
  UNION ALL SELECT * EXCLUDE k FROM (SELECT *, row_number() OVER (PARTITION BY ord ORDER BY bb DESC, rk DESC, id) AS k FROM hit
    WHERE bb > 0 AND ord NOT IN (SELECT ord FROM hit WHERE hh > 0)) WHERE k = 1),
membership AS (SELECT ord, id, row_number() OVER (PARTITION BY ord ORDER BY hh DESC, bb DESC, rk DESC, id) AS k FROM member
  UNION ALL SELECT ord, {_N} AS id, 1 AS k FROM art WHERE ord NOT IN (SELECT ord FROM member)),
assigned AS (SELECT ord, max(id) FILTER (WHERE k = 1) AS theme, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS themes FROM membership GROUP BY ord)"""
_LABELS = "CASE id " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(PROSE.labels)) + " END"


def _assigned(spark, sf_dir):
    return themes.assign(articles(spark, sf_dir), PROSE)


@query(f"WITH {_HITS} SELECT ord, id, CAST(hh AS BIGINT) AS headline_hits, CAST(bb AS BIGINT) AS body_hits FROM hit")
def theme_hits(spark, sf_dir):
    rows = articles(spark, sf_dir).select("ord", F.posexplode(F.arrays_zip(themes.theme_hits(F.col("headline"), PROSE).alias("h"), themes.theme_hits(F.col("body"), PROSE).alias("b"))).alias("id", "x"))
    return rows.select("ord", "id", F.col("x.h").cast("bigint").alias("headline_hits"), F.col("x.b").cast("bigint").alias("body_hits"))


@query(f"WITH {_HITS} SELECT ord, theme, themes FROM assigned")
def theme_assign(spark, sf_dir):
    return _assigned(spark, sf_dir).select("ord", "theme", F.array_join(F.col("themes").cast("array<string>"), ",").alias("themes"))


@query(f'WITH {_HITS} SELECT id, {_LABELS} AS label, count(*) AS "count" FROM membership GROUP BY id')
def theme_counts(spark, sf_dir):
    return themes.theme_counts(_assigned(spark, sf_dir), PROSE)


@query(f"WITH {_HITS} SELECT theme AS id, count(*) AS n FROM assigned GROUP BY theme")
def theme_primaries(spark, sf_dir):
    return _assigned(spark, sf_dir).groupBy(F.col("theme").alias("id")).agg(F.count("*").alias("n"))


@query(f"WITH {_HITS} SELECT m.ord, coalesce(string_agg({_LABELS}, '; ' ORDER BY id) FILTER (WHERE id <> theme), '') AS also FROM membership m JOIN assigned a ON a.ord = m.ord GROUP BY m.ord")
def also_tags(spark, sf_dir):
    return _assigned(spark, sf_dir).select("ord", themes.also_tags(F.col("themes"), F.col("theme"), PROSE).alias("also"))


@query(f"WITH {_HITS} SELECT m.ord, art.date AS d, art.headline AS h FROM membership m JOIN art ON art.ord = m.ord WHERE m.id = 1")
def theme_cards(spark, sf_dir):
    rows = _assigned(spark, sf_dir).select("ord", F.col("date").alias("d"), F.col("headline").alias("h"), "themes")
    return report.theme_cards(rows, 1, PROSE).drop("also")


@query(f"WITH {_HITS}, named AS (SELECT ord, string_agg({_LABELS}, '; ' ORDER BY id) AS all_themes FROM membership GROUP BY ord) SELECT url, headline, source, CAST(date AS VARCHAR) AS scrape_date, theme, (SELECT {_LABELS} FROM (SELECT a.theme AS id)) AS theme_name, all_themes FROM assigned a JOIN named USING (ord) JOIN art USING (ord)")
def tagged_rows(spark, sf_dir):
    return report.tagged_rows(_assigned(spark, sf_dir), PROSE)


@query(f"WITH {_HITS} SELECT count(*) AS articles, count(DISTINCT source) AS sources, count(DISTINCT theme) AS themes, '2024-02-09' AS updated FROM assigned JOIN art USING (ord)")
def header_counters(spark, sf_dir):
    return report.header(_assigned(spark, sf_dir), "2024-02-09 10:00 Amsterdam")


_TF = f"""{ARTICLES}, w0 AS (SELECT ord, unnest({_WORDS.format('body')}) AS t, generate_subscripts({_WORDS.format('body')}, 1) AS i FROM art),
w AS (SELECT ord, t, row_number() OVER (PARTITION BY ord ORDER BY i) AS i FROM w0 WHERE regexp_full_match(t, '[a-z]{{2,}}') AND t NOT IN {_in(PROSE.stop)}),
g AS (SELECT ord, t AS term FROM w UNION ALL SELECT a.ord, a.t || ' ' || b.t FROM w a JOIN w b ON a.ord = b.ord AND b.i = a.i + 1),
tf AS (SELECT ord, term, count(*) AS tf FROM g GROUP BY ord, term), n AS (SELECT count(*) AS n FROM art),
voc AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM tf GROUP BY term HAVING count(*) >= 2 AND count(*) <= 0.6 * (SELECT n FROM n) ORDER BY cf DESC, term LIMIT 5000)"""


@query(f"WITH {_TF} SELECT term, df, cf FROM voc")
def tfidf_vocabulary(spark, sf_dir):
    rows = articles(spark, sf_dir)
    return terms.vocabulary_of_texts(rows, PROSE.stop, rows.count(), text="body")


def _weights(rows, text="body", keep=()):
    """The rows' words, written down, and their weights."""
    words = settle(terms.words_of(rows, PROSE.stop, text=text, keep=keep), "words")
    return words, terms.weights_of(words, words.count())


_W = f"""{_TF}, raw AS (SELECT ord, term, (1 + ln(tf)) * (ln(CAST(1 + (SELECT n FROM n) AS DOUBLE) / (1 + df)) + 1) AS raw FROM tf JOIN voc USING (term)),
norm AS (SELECT ord, sqrt(sum(raw * raw)) AS norm FROM raw GROUP BY ord), wt AS (SELECT ord, term, raw / norm AS w FROM raw JOIN norm USING (ord))"""


@query(f"WITH {_W} SELECT ord, term, floor(w * 1000000 + 0.5) / 1000000 AS w FROM wt")
def tfidf_weights(spark, sf_dir):
    return _weights(articles(spark, sf_dir))[1].withColumn("w", sixths(F.col("w")))


@query(
    f"""WITH {_W.replace(ARTICLES + ',', _HITS + ',', 1)}, size AS (SELECT id, count(*) AS n FROM membership GROUP BY id),
mean AS (SELECT m.id, wt.term, floor(sum(w) / any_value(size.n) * 1000000 + 0.5) / 1000000 AS mean_w FROM membership m JOIN wt ON wt.ord = m.ord JOIN size ON size.id = m.id GROUP BY m.id, wt.term)
SELECT id, row_number() OVER (PARTITION BY id ORDER BY mean_w DESC, term) AS rank, term, mean_w FROM mean QUALIFY rank <= 5"""
)
def theme_top_terms(spark, sf_dir):
    """Ranked by the mean weight to six decimals, so that both engines see the same ties."""
    from pyspark.sql import Window

    words, weights = _weights(themes.members(articles(spark, sf_dir), PROSE), keep=("themes",))
    every = themes.theme_terms(words, weights, k=None).withColumn("mean_w", sixths(F.col("mean_w")))
    order = Window.partitionBy("id").orderBy(F.desc("mean_w"), "term")
    return every.withColumn("rank", F.row_number().over(order).cast("bigint")).filter("rank <= 5").select("id", "rank", "term", "mean_w")


def _by_lang():
    from pyspark.sql import Window

    return Window.orderBy("lang")


def _languages(spark, sf_dir):
    """lang and cluster, its number by name; written down, so that Spark measures it and joins it without dealing texts by language."""
    langs = articles(spark, sf_dir).select("lang").distinct()
    return settle(langs.withColumn("cluster", F.dense_rank().over(_by_lang())), "languages")


def _lang_classes(spark, sf_dir, langs):
    """Languages as clusters."""
    return articles(spark, sf_dir).join(langs, "lang").select("cluster", "ord", F.col("body").alias("text"))


_CLASS = f"""{ARTICLES}, w0 AS (SELECT lang, ord, unnest({_WORDS.format('body')}) AS t, generate_subscripts({_WORDS.format('body')}, 1) AS i FROM art),
w AS (SELECT lang, t, row_number() OVER (PARTITION BY lang ORDER BY ord, i) AS i FROM w0 WHERE regexp_full_match(t, '[a-z]{{2,}}') AND t NOT IN {_in(PROSE.stop)}),
g AS (SELECT lang, t AS term FROM w UNION ALL SELECT a.lang, a.t || ' ' || b.t FROM w a JOIN w b ON a.lang = b.lang AND b.i = a.i + 1),
x AS (SELECT lang, term, count(*) AS n FROM g GROUP BY lang, term), r AS (SELECT lang, sum(n) AS r FROM x GROUP BY lang), c AS (SELECT term, sum(n) AS c FROM x GROUP BY term),
s AS (SELECT x.lang, x.term, floor(CAST(n AS DOUBLE) / r * ln(1 + CAST((SELECT sum(n) FROM x) AS DOUBLE) / (SELECT count(DISTINCT lang) FROM art) / c) * 100000000 + 0.5) AS score FROM x JOIN r ON r.lang = x.lang JOIN c ON c.term = x.term)"""


@query(f"WITH {_CLASS} SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, term) AS rank, term, CAST(score AS BIGINT) AS score FROM s QUALIFY rank <= 20")
def ctfidf_terms(spark, sf_dir):
    """Top terms of each language as a class; scores in whole hundred-millionths."""
    from pyspark.sql import Window

    langs = _languages(spark, sf_dir)
    found = terms.class_terms(_lang_classes(spark, sf_dir, langs), PROSE.stop, k=None).withColumn("score", F.floor(F.col("score") * 100000000 + 0.5))
    order = Window.partitionBy("cluster").orderBy(F.desc("score"), "term")
    top = found.withColumn("rank", F.row_number().over(order).cast("bigint")).filter("rank <= 20")
    return top.join(langs, "cluster").select("lang", "rank", "term", "score")


@query()
def cluster_labels(spark, sf_dir):
    """Theme and facet of each language."""
    found = terms.cluster_labels(terms.class_terms(_lang_classes(spark, sf_dir, _languages(spark, sf_dir)), PROSE.stop))
    return found.select("cluster", F.array_join("words", " · ").alias("label"))


@query("SELECT page_id, trim(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM pages")
def url_slug(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", slug(F.col("url")).alias("slug"))


@query(f"WITH {ARTICLES}, w AS (SELECT ord, {_WORDS.format('headline')} AS t FROM art) SELECT ord, len(list_filter(t, lambda x: regexp_full_match(x, '[a-z]{{2,}}') AND x NOT IN {_in(PROSE.stop)})) AS words FROM w")
def headline_words(spark, sf_dir):
    return articles(spark, sf_dir).select("ord", F.size(without(word_tokens(F.col("headline")), PROSE.stop)).cast("bigint").alias("words"))


@query(f"WITH {_TF.replace('body', 'headline')} SELECT ord, term, tf FROM tf".replace("text AS headline", "text AS body"))
def headline_ngrams(spark, sf_dir):
    return terms.term_counts(articles(spark, sf_dir), PROSE.stop, text="headline")


@query()
def body_extract(spark, sf_dir):
    """Article bodies of all pages."""
    return html.article_bodies(table(spark, sf_dir, "pages"), PROSE).select("page_id", "url", "body")


@query()
def lsa_layout(spark, sf_dir):
    """Headlines on the first two latent dimensions; one without a term of the vocabulary lies at 0, 0."""
    words, w = _weights(articles(spark, sf_dir), "headline")
    return words.select("ord").join(layout.plane(layout.lsa(settle(w, "weights"), words.count())), "ord", "left").fillna(0.0, ["x", "y"])


@query(
    f"""WITH {_HITS}, {_POSTINGS.replace(ARTICLES + ', ', '', 1)}, t AS (SELECT id, {_LABELS} AS label, count(*) AS n FROM membership GROUP BY id),
k AS (SELECT term, count(*) AS n FROM post GROUP BY term ORDER BY n DESC, term LIMIT 16)
SELECT '{{"generated":"2024-02-09 10:00 Amsterdam","generatedFull":"2024-02-09 10:00:00 CET","themes":[' || (SELECT string_agg('{{"id":' || id || ',"label":' || to_json(label) || ',"count":' || n || '}}', ',' ORDER BY n DESC, id) FROM t) ||
'],"keywords":[' || (SELECT string_agg('{{"term":"' || term || '","n":' || n || '}}', ',' ORDER BY n DESC, term) FROM k) ||
'],"head":[{{"articles":' || count(*) || ',"sources":' || count(DISTINCT source) || ',"themes":' || count(DISTINCT theme) || ',"updated":"2024-02-09"}}]}}' AS json FROM assigned JOIN art USING (ord)"""
)
def report_payload(spark, sf_dir):
    """The nested JSON of a report: theme counts, keywords and coverage."""
    a = _assigned(spark, sf_dir)
    posts = terms.keyword_postings(articles(spark, sf_dir), PROSE)
    return report.payload("2024-02-09 10:00 Amsterdam", "2024-02-09 10:00:00 CET", themes=themes.theme_counts(a, PROSE), keywords=terms.keyword_frequency(posts), head=report.header(a, "2024-02-09 10:00"))
