"""Archive, revisions, shares."""

from __future__ import annotations

from pyspark.sql import functions as F

from heliograph.functions.text import CP1252, CP1252_BYTES, clean_headline, repair_mojibake
from heliograph.operators import archive, revisions, shares
from heliograph.operators.themes import on_topic
from heliograph.plans.registry import query
from heliograph.plans.tables import ARTICLES, articles, table
from heliograph.vocab import PROSE

_TOPIC = PROSE.topic.replace("'", "''")


@query(f"WITH {ARTICLES} SELECT ord, headline FROM art WHERE regexp_matches(headline, '{_TOPIC}')")
def topic_filter(spark, sf_dir):
    return articles(spark, sf_dir).filter(on_topic(F.col("headline"), PROSE)).select("ord", "headline")


def _sources(spark, sf_dir):
    """Every source of documents, and one that has none."""
    there = table(spark, sf_dir, "documents").select("source").distinct()
    return there.union(spark.createDataFrame([("unseen",)], "source string")).withColumn("rank", F.crc32("source"))


_SHARES = f"""{ARTICLES}, src AS (SELECT DISTINCT source FROM documents UNION ALL SELECT 'unseen'),
cnt AS (SELECT source, count(*) FILTER (WHERE regexp_matches(headline, '{_TOPIC}')) AS matched, count(*) AS total,
  CAST(min(date) AS VARCHAR) AS d0, CAST(max(date) AS VARCHAR) AS d1 FROM art GROUP BY source),
shares AS (SELECT source, coalesce(matched, 0) AS matched, coalesce(total, 0) AS total, coalesce(d0, '') AS d0, coalesce(d1, '') AS d1,
  CASE WHEN coalesce(total, 0) > 0 THEN round_even(CAST(matched AS DOUBLE) / total * 100, 1) ELSE CAST(0 AS DOUBLE) END AS pct FROM src LEFT JOIN cnt USING (source))"""


@query(f"WITH {_SHARES} SELECT source, matched, total, d0, d1, pct, CAST(floor(CASE WHEN total > 0 THEN matched * 1000 / total ELSE 0 END) AS BIGINT) AS permille FROM shares")
def topic_share_by_source(spark, sf_dir):
    """With the share in per cent to one decimal, and in whole thousandths, which no rounding rule touches."""
    rows = articles(spark, sf_dir)
    s = shares.topic_shares(_sources(spark, sf_dir), rows, on_topic(F.col("headline"), PROSE))
    permille = F.when(F.col("total") > 0, F.floor(F.col("matched") * 1000 / F.col("total"))).otherwise(0).cast("bigint")
    return s.select("source", "matched", "total", "d0", "d1", "pct", permille.alias("permille"))


@query(
    f"""WITH {_SHARES}, months AS (SELECT 'a' AS x) SELECT min(d0) FILTER (WHERE d0 <> '') AS "from", max(d1) FILTER (WHERE d1 <> '') AS "to",
count(*) FILTER (WHERE total > 0) AS sources FROM shares"""
)
def coverage_window(spark, sf_dir):
    return shares.coverage(shares.topic_shares(_sources(spark, sf_dir), articles(spark, sf_dir), on_topic(F.col("headline"), PROSE)))


@query(f"WITH {ARTICLES} SELECT ord, headline FROM (SELECT *, row_number() OVER (PARTITION BY headline ORDER BY ord) AS k FROM art) WHERE k = 1")
def dedupe_keep_first(spark, sf_dir):
    return archive.keep_first(articles(spark, sf_dir).select("ord", "headline"), "headline", "ord")


@query(
    f"""WITH {ARTICLES}, a AS (SELECT headline, min(ord) AS ord FROM art WHERE ord % 2 = 0 GROUP BY headline),
b AS (SELECT headline, min(ord) AS ord FROM art WHERE ord % 2 = 1 GROUP BY headline)
SELECT headline, ord FROM a UNION ALL SELECT headline, ord FROM b WHERE headline NOT IN (SELECT headline FROM a)"""
)
def insert_only_upsert(spark, sf_dir):
    """Even ids are the archive, odd ids arrive."""
    rows = articles(spark, sf_dir).select("headline", "ord")
    old = archive.keep_first(rows.filter("ord % 2 = 0"), "headline", "ord")
    return archive.upsert_new(old, rows.filter("ord % 2 = 1"), "headline", "ord")


@query(
    """SELECT source, text, doc_id FROM (SELECT source, text, doc_id, row_number() OVER (PARTITION BY source, text ORDER BY doc_id) AS k FROM documents) WHERE k = 1
UNION ALL BY NAME SELECT 'pages' AS source, url, page_id FROM pages"""
)
def union_ragged(spark, sf_dir):
    """Exact repeats within a source once, then another source with other columns; what a source lacks is null."""
    d = table(spark, sf_dir, "documents").groupBy("source", "text").agg(F.min("doc_id").alias("doc_id"))
    p = table(spark, sf_dir, "pages").select(F.lit("pages").alias("source"), "url", "page_id")
    return archive.union_sources([d, p])


@query("SELECT user_id, min(ts) AS ts, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id")
def first_seen(spark, sf_dir):
    from heliograph.streaming.archive import first_seen

    return first_seen(table(spark, sf_dir, "events"), "user_id", "ts", "event_id")


def _versions(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").cast("string").alias("aid"), F.concat_ws("/", "conv_id", "turn").alias("url"), F.col("text").alias("headline"), F.col("turn").alias("at"), F.col("turn").alias("ord"))


_HISTORY = """v AS (SELECT CAST(conv_id AS VARCHAR) AS aid, text AS h, min(turn) AS t FROM conversations WHERE text IS NOT NULL GROUP BY conv_id, text)"""


@query(f"WITH {_HISTORY} SELECT aid, count(*) AS n, string_agg(h, '|' ORDER BY t) AS versions, max(t) AS last FROM v GROUP BY aid HAVING count(*) >= 2")
def revision_history(spark, sf_dir):
    found = revisions.revision_history(_versions(spark, sf_dir))
    return found.select("aid", F.col("n").cast("bigint").alias("n"), F.array_join(F.transform("versions", lambda x: x["h"]), "|").alias("versions"), "last")


@query(f"WITH {_HISTORY}, r AS (SELECT aid FROM v WHERE regexp_matches(h, '{_TOPIC}')) SELECT aid, count(*) AS n FROM v WHERE aid IN (SELECT aid FROM r) GROUP BY aid HAVING count(*) >= 2")
def revisions_on_topic(spark, sf_dir):
    """Articles of which any version is on topic."""
    return revisions.revision_history(_versions(spark, sf_dir), PROSE).select("aid", F.col("n").cast("bigint").alias("n"))


@query(f"WITH {_HISTORY} SELECT aid, h, lag(h) OVER (PARTITION BY aid ORDER BY t) AS previous, row_number() OVER (PARTITION BY aid ORDER BY t) AS version FROM v")
def revision_steps(spark, sf_dir):
    """Each version with the one before."""
    return revisions.revision_steps(_versions(spark, sf_dir).filter("headline is not null")).withColumn("version", F.col("version").cast("bigint"))


@query(f"WITH {ARTICLES} SELECT ord, regexp_replace(regexp_replace(headline || chr(160) || chr(9), chr(65533), ' ', 'g'), '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g') AS headline FROM art")
def clean_headlines(spark, sf_dir):
    rows = articles(spark, sf_dir)
    return rows.select("ord", clean_headline(F.concat(F.col("headline"), F.lit(" \t"))).alias("headline"))


@query(f"WITH {ARTICLES} SELECT ord, regexp_replace(headline, '[ÁÍÏÐÝ]', '', 'g') AS headline FROM art")
def mojibake_repair(spark, sf_dir):
    """Headlines whose UTF-8 was misread as cp1252 are repaired to what they were, but for letters with a byte that cp1252 lacks."""
    rows = articles(spark, sf_dir)
    broken = F.translate(F.decode(F.encode("headline", "UTF-8"), "ISO-8859-1"), "".join(chr(int(x, 16)) for x in CP1252_BYTES.split()), CP1252)
    return rows.select("ord", repair_mojibake(broken).alias("headline"))


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def not_in_cache(spark, sf_dir):
    """Documents that a cache, here the labels, lacks."""
    return archive.lacking(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT l_orderkey, l_linenumber, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def relevant_rows(spark, sf_dir):
    """Rows whose key is in a set of relevant keys: a semi join."""
    few = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(few, "o_custkey", "left_semi")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return items.join(orders, items["l_orderkey"] == orders["o_orderkey"]).select("l_orderkey", "l_linenumber", "o_custkey")


@query(f"WITH {ARTICLES} SELECT source AS code, count(*) AS total, 0.15 + 0.85 * CAST(count(*) % 100 AS DOUBLE) / 100 AS opacity, '' AS home FROM art GROUP BY source UNION ALL SELECT 'XX', 0, 0.15, 'https://example.org'")
def map_shading(spark, sf_dir):
    """Areas with their share and home page, defaults where either is missing."""
    counted = articles(spark, sf_dir).groupBy(F.col("source").alias("code")).agg(F.count("*").alias("total"))
    s = counted.select("code", (F.col("total") % 100).cast("double").alias("pct"), F.lit(0).alias("matched"), "total")
    areas = counted.select("code").union(spark.createDataFrame([("XX",)], "code string"))
    return shares.map_fill(areas, s, spark.createDataFrame([("XX", "https://example.org")], "code string, home string")).select("code", "total", "opacity", "home")
