"""URL filtering by a rule list and by association rules that FP-growth mines from labelled URLs, in DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliograph.llm.common import discard, settle

MIN_SUPPORT, MIN_CONFIDENCE, MIN_LIFT, MIN_ROWS = 0.002, 0.7, 1.5, 15
#: Antecedents have at most so many tokens. Sets of more tokens than WIDTH are mined in pieces.
RULE_TOKENS, WIDTH = 3, 12
#: The rules are broadcast while they are no more than this; each has at most RULE_TOKENS hashes.
BROADCAST_RULES = 100_000


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule (host, path, verdict) that fits, as struct<rule, verdict>; null where none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def tokens_of(url: Column) -> Column:
    """Distinct tokens: scheme, each host label, the host's registered end, path words without digits, query fields, a fragment."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    named = lambda kind, words: F.transform(F.filter(words, lambda x: x != ""), lambda x: F.concat(F.lit(kind + "="), x))
    end = F.array_join(F.slice(F.reverse(labels), 1, 2), ".")
    return F.array_distinct(
        F.concat(
            F.array(F.concat(F.lit("scheme="), F.lower(F.split_part(url, F.lit("://"), F.lit(1))))),
            named("host", labels),
            F.array(F.concat(F.lit("end="), end)),
            named("path", F.filter(F.split(F.lower(path), "[^a-z0-9]+"), lambda x: ~x.rlike("[0-9]"))),
            named("query", F.split(query, "&")),
            F.array(F.when(F.instr(url, "#") > 0, F.lit("fragment")).otherwise(F.lit("no fragment"))),
        )
    )


def _transactions(rows: DataFrame, width: int, rule_tokens: int) -> DataFrame:
    """items: the sets of tokens, those of more than ``width`` tokens split so that any rule_tokens of a set are together in one of its pieces.

    FP-growth finds all subsets of what occurs together, so a set must not be
    wide. A wide one is cut into parts, and each union of rule_tokens parts is
    a piece of at most ``width`` tokens. What pieces count is no support;
    mine_rules counts again.
    """
    part = max(1, width // rule_tokens)
    few = rows.filter(F.size("tokens") <= width).select("tokens")
    many = rows.filter(F.size("tokens") > width).select("tokens", F.ceil(F.size("tokens") / part).cast("int").alias("parts")).withColumn("chosen", F.array().cast("array<int>"))
    for k in range(rule_tokens):
        after = F.coalesce(F.try_element_at("chosen", F.lit(-1)), F.lit(-1)) + 1
        # Room is left for the parts that are still to be chosen.
        many = many.withColumn("next", F.explode(F.sequence(after, F.col("parts") - F.lit(rule_tokens - k)))).withColumn("chosen", F.concat("chosen", F.array("next"))).drop("next")
    pieces = many.select(F.flatten(F.transform("chosen", lambda i: F.slice("tokens", i * part + 1, part))).alias("tokens"))
    return few.unionByName(pieces).select(F.col("tokens").alias("items"))


def mine_rules(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT, min_rows: int = MIN_ROWS, rule_tokens: int = RULE_TOKENS, width: int = WIDTH
) -> DataFrame:
    """tokens, confidence, support and lift of the rules tokens -> block, from ``labelled(url, bad)``.

    FP-growth mines the token sets of blocked URLs over all their frequent
    tokens. How often each set of rule_tokens tokens at most occurs, in
    blocked and in all URLs, is then counted over the whole token sets, so
    that support, confidence and lift are exact. A token that all labelled
    URLs have can raise no confidence and is left out. Rules that add tokens
    to another rule without raising its confidence are pruned. Without
    labelled rows there are no rules.
    """
    spark = labelled.sparkSession
    none = spark.createDataFrame([], "tokens array<string>, confidence double, support double, lift double")
    rows = settle(labelled.filter("url is not null and bad is not null").select(tokens_of(F.col("url")).alias("tokens"), F.col("bad").cast("int").alias("bad")), "labelled")
    n, bad = rows.agg(F.count("*"), F.coalesce(F.sum("bad"), F.lit(0))).first()
    need = max(1, math.ceil(max(min_support, min(1.0, min_rows / n)) * n)) if n else 1
    if bad < need:
        return none
    single = rows.select(F.explode("tokens").alias("token"), "bad").groupBy("token").agg(F.count("*").alias("n"), F.sum("bad").alias("b"))
    often = settle(single.filter((F.col("b") >= need) & (F.col("n") < n)).select("token", "n"), "often")  # at most tokens / min_support
    # The frequent tokens of each row, the rarest first. Equal rows are one, with how many they are.
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    kept = numbered.select("row", "bad", F.explode("tokens").alias("token")).join(often, "token").groupBy("row", "bad").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "token"))), lambda x: x["token"]).alias("tokens"))
    sets = settle(kept.groupBy("tokens").agg(F.count("*").alias("n"), F.sum("bad").alias("b")), "sets")
    baskets = settle(_transactions(sets.filter("b > 0").select("tokens", F.explode(F.sequence(F.lit(1), F.col("b")))), width, rule_tokens), "baskets")
    pieces = baskets.count()
    if not pieces:
        return none
    mined = FPGrowth(itemsCol="items", minSupport=max(0.0, (need - 0.5) / pieces), minConfidence=1.0).fit(baskets).freqItemsets
    found = settle(mined.filter(F.size("items") <= rule_tokens).select(F.array_sort("items").alias("tokens")), "mined")
    # Counted again, over whole sets, each by its first token.
    asked = sets.withColumn("first", F.explode("tokens")).join(found.select(F.col("tokens").alias("rule"), F.col("tokens")[0].alias("first")), "first").filter(F.size(F.array_except("rule", "tokens")) == 0)
    counted = asked.groupBy("rule").agg(F.sum("n").alias("n"), F.sum("b").alias("b")).filter(F.col("b") >= need)
    confidence = F.col("b") / F.col("n")
    rules = counted.select(F.col("rule").alias("tokens"), confidence.alias("confidence"), (F.col("b") / F.lit(n)).alias("support"), (confidence / F.lit(bad / n)).alias("lift"))
    rules = settle(rules.filter((F.col("confidence") >= min_confidence) & (F.col("lift") >= min_lift)), "rules")
    discard(rows, often, sets, baskets, found)
    # A rule stands if none of its parts, which have rule_tokens at most, is as confident.
    parts = F.filter(F.flatten(F.array(F.transform("tokens", lambda x: F.array_except("tokens", F.array(x))), F.transform("tokens", lambda x: F.array(x)))), lambda p: (F.size(p) > 0) & (F.size(p) < F.size("tokens")))
    shorter = rules.select(F.explode(parts).alias("part"), "tokens", "confidence")
    beaten = shorter.join(rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("c")), "part").filter("c >= confidence").select("tokens").distinct()
    return rules.join(beaten, "tokens", "left_anti")


def score_urls(pages: DataFrame, rules: DataFrame, broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """page_key and confidence of the best rule for each row of ``pages(page_key, tokens)`` that one fits.

    The inverted index lists each rule under the rarest of its tokens that
    the rules know, so a URL meets only rules that it shares that token with.
    """
    h = lambda t: F.xxhash64(t)
    rules = rules.select("tokens", "confidence", F.monotonically_increasing_id().alias("rule_id"))
    use = rules.select("rule_id", F.explode("tokens").alias("token"))
    spread = use.groupBy("token").agg(F.count("*").alias("n"))
    anchor = use.join(spread, "token").groupBy("rule_id").agg(F.min_by("token", F.struct("n", "token")).alias("token"))
    index = settle(rules.join(anchor, "rule_id").select(h(F.col("token")).alias("th"), F.transform("tokens", h).alias("needs"), "confidence"), "index")
    if index.count() <= broadcast_rules:
        index = F.broadcast(index)
    asked = pages.select("page_key", F.transform("tokens", h).alias("has")).withColumn("th", F.explode("has"))
    return asked.join(index, "th").filter(F.size(F.array_except("needs", "has")) == 0).groupBy("page_key").agg(F.max("confidence").alias("confidence"))


def judge_urls(pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str, str]], **mining) -> DataFrame:
    """page_id, url, host, path, rule, verdict and confidence of every row of ``pages(page_id, url)``.

    The longest rule of the list (host, path, verdict) that fits decides;
    else the mined rules, which block where one fits; else allow. A null
    url, or one without ``://``, has an empty host and path, fits no listed
    rule and is allowed. Equal urls are judged once. Repeated rows each
    give a row; other columns are ignored; an empty table gives no rows.
    """
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"))
    mined = mine_rules(labelled, **mining)
    asked = pages.filter(F.instr("url", "://") > 0).select(F.col("url").alias("page_key")).distinct().withColumn("tokens", tokens_of(F.col("page_key")))
    scores = score_urls(asked, mined).select(F.col("page_key").alias("url"), "confidence")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    found = pages.withColumns({"host": host, "path": path}).withColumn("r", rule_of(F.col("host"), F.col("path"), rules)).join(scores, "url", "left")
    verdict = F.coalesce("r.verdict", F.when(F.col("confidence").isNotNull(), "block").otherwise("allow"))
    return found.select("page_id", "url", "host", "path", F.col("r.rule").alias("rule"), verdict.alias("verdict"), "confidence")
