"""One query per operator: the operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph.llm import decontam, fim, langid, merkle, mixing, neardup, oracles, outliers, quality, sessions, substrings, tokens, toxicity, url_rules
from heliograph.llm.common import read

URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def labelled_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """url and bad of pages whose document has labels. The number that ends a page's path is the doc_id of its text; low quality and toxic are bad."""
    labels = read(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).alias("bad"))
    number = F.try_to_number(F.nullif(F.regexp_extract("url", r"://[^/?#]*/[^?#]*?(\d{1,18})(?:\.html)?/?(?:[?#]|$)", 1), F.lit("")), F.lit("9" * 18)).cast("bigint")
    return read(spark, sf_dir, "pages").select("url", number.alias("doc_id")).join(labels, "doc_id").select("url", "bad")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


def op3_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as records at offset page_id, against a replica with known damage: altered where page_id % 97 = 13, lost where page_id % 89 = 21."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    primary = pages.select(F.col("page_id").alias("offset"), merkle.record_text(F.col("url"), F.col("html")).alias("record"))
    html = F.when(F.col("page_id") % 97 == 13, F.concat(F.lit("#"), F.substring("html", 2, 1 << 30))).otherwise(F.col("html"))
    replica = pages.filter("page_id % 89 <> 21").select(F.col("page_id").alias("offset"), merkle.record_text(F.col("url"), html).alias("record"))
    return merkle.audit(primary, replica).withColumnRenamed("offset", "page_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(read(spark, sf_dir, "pages"), labelled_urls(spark, sf_dir), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(decontam.find_overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judge(read(spark, sf_dir, "documents")).drop("distance")


def op8_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    import public_tokenizers

    return tokens.count_tokens(read(spark, sf_dir, "documents"), Path(public_tokenizers.path(tokenizer)).read_text(encoding="utf-8"))


def document_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled good weighs 2, labelled bad a half; all others 1 by default."""
    return read(spark, sf_dir, "labels").filter("quality is not null").select("doc_id", F.when(F.col("quality") == 1, 2.0).otherwise(0.5).alias("weight"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), document_weights(spark, sf_dir)).drop("source")


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.find_duplicates(read(spark, sf_dir, "documents"), size=3, similarity=0.85)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(fim.rearrange(read(spark, sf_dir, "documents")))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeats(read(spark, sf_dir, "documents")).select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user, batch, second and value of the turns, drawn from checksums of conv_id and turn; two users in eight conversations."""
    c, h = F.crc32(F.col("conv_id").cast("string")), F.crc32(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")))
    turns = read(spark, sf_dir, "conversations").filter("conv_id is not null and turn is not null").select("conv_id", "turn", c.alias("c"), h.alias("h"))
    turns = turns.selectExpr("2 * ((conv_id - pmod(conv_id, 8)) div 8) + c % 2 as user", "(c div 2) % 7200 + 300 * turn + h % 600 as second", "h div 600 as g", "h as value")
    return turns.selectExpr("user", "(second - pmod(second, 1800)) div 1800 + case when g % 3 = 0 then g % 4 else 0 end as batch", "second", "value")


def op13_late_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.versions(session_events(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_language_id": op2_language_id,
    "op3_warc_fixity": op3_warc_fixity,
    "op4_toxicity": op4_toxicity,
    "op5_url_filters": op5_url_filters,
    "op6_decontamination": op6_decontamination,
    "op7_quality_rules": op7_quality_rules,
    "op8_token_counts": op8_token_counts,
    "op9_mixing": op9_mixing,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_late_sessions": op13_late_sessions,
}
ORACLES: dict[str, str] = {
    "op3_warc_fixity": oracles.WARC_FIXITY,
    "op5_url_filters": oracles.url_filters(URL_RULES, url_rules.MIN_SUPPORT, url_rules.MIN_CONFIDENCE, url_rules.MIN_LIFT, url_rules.MIN_ROWS),
    "op6_decontamination": oracles.DECONTAMINATION,
    "op9_mixing": oracles.MIXING,
    "op10_minhash_near_dedup": oracles.NEAR_DEDUP,
    "op11_fill_in_middle": oracles.FILL_IN_MIDDLE,
    "op12_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op13_late_sessions": oracles.LATE_SESSIONS,
}
