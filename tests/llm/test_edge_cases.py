"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import random

import pytest
from pyspark.sql import functions as F

from heliograph.llm import decontam, langid, merkle, mixing, neardup, outliers, quality, tokens, toxicity, url_rules

LONG = "lorem ipsum dolor sit amet " * 40_000
SCHEMA = "doc_id long, text string, lang string, source string, score string, size string, kept string, __s string, node string"
PLAIN = "The quick brown fox jumps over the lazy dog near the river bank today. "
ROWS = [
    (1, PLAIN * 6, "en", "a"), (1, PLAIN * 6, "en", "a"), (2, None, None, None), (3, "", "en", "a"), (4, "   \n\t ", "en", None), (5, "... 123 !!!", "de", "b"),
    (6, LONG, "la", "b"), (None, "some words without an id", "en", "a"), (8, PLAIN * 6, "en", "b"), (9, "ein zwei", "de", "b"), (10, "\u00e9\u00e8 \U0001f600 <|endoftext|> \u4e2d\u6587", "fr", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "clash", "clash", "clash", "clash", "clash") for r in ROWS], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 0), (3, None, None), (5, 0, 1), (8, 1, 0), (None, 1, 1), (99, 0, 0), (9, 7, 7)], "doc_id long, quality int, toxic int")


def no_rows(df):
    return df.limit(0)


def test_quality(docs, labels):
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got) and {r.predicted for r in got} <= {0, 1}
    assert quality.classify(no_rows(docs), labels).count() == 0
    none = quality.classify(docs, no_rows(labels)).collect()
    assert {r.score for r in none} == {0.5} and {r.predicted for r in none} == {0}
    assert quality.keep_good(docs, docs, no_rows(labels)).count() == 0 and quality.keep_good(docs, docs, labels).columns == docs.columns


def test_language(docs):
    got = {(r.doc_id, r.lang_pred, r.score) for r in langid.identify(docs, texts=5).collect()}
    assert {(i, p) for i, p, _ in got if p == "und"} == {(2, "und"), (3, "und"), (4, "und"), (5, "und")}
    assert {s for _, p, s in got if p == "und"} == {0.0}
    assert langid.identify(no_rows(docs)).count() == 0
    assert {r.lang_pred for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_toxicity(docs, labels):
    got = toxicity.score_toxicity(docs, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score_toxicity(no_rows(docs), labels).count() == 0
    assert {r.score for r in toxicity.score_toxicity(docs, no_rows(labels)).collect()} == {0.0}


def test_merkle(spark):
    a = [(1, "x"), (1, "x"), (2, None), (None, "n"), (70, "y"), (-3, "z"), (5000, "far")]
    b = [(1, "x"), (2, ""), (None, "n"), (70, "other"), (-3, "z"), (9, "new")]
    f = lambda rows: spark.createDataFrame([(*r, "clash") for r in rows], "offset long, record string, digest string")
    got = {(r.offset, r.status) for r in merkle.audit(f(a), f(b)).collect()}
    assert got == {(1, "corrupt"), (2, "intact"), (None, "intact"), (70, "corrupt"), (-3, "intact"), (5000, "missing"), (9, "extra")}
    assert {r.status for r in merkle.audit(f(a), f(a)).collect()} == {"intact"}
    assert merkle.audit(f([]), f([])).count() == 0
    assert {r.status for r in merkle.audit(f(a), f([])).collect()} == {"missing"} and {r.status for r in merkle.audit(f([]), f(b)).collect()} == {"extra"}


def test_merkle_descends_differing_branches_only(spark):
    n = merkle.RANGE * merkle.FANOUT**2
    rows = spark.range(n).select(F.col("id").alias("offset"), F.concat(F.lit("r"), F.col("id").cast("string")).alias("record"))
    worse = rows.withColumn("record", F.when(F.col("offset") == 5000, F.lit("other")).otherwise(F.col("record")))
    held = [merkle.digests(t) for t in (rows, worse)]
    seen = []
    found = merkle.differing(*[merkle.tree(h) for h in held], seen)
    assert [r.node for r in found.collect()] == [5000 // merkle.RANGE] and seen[0] == 1 and max(seen) == merkle.FANOUT and len(seen) >= 3
    # Records that trade places leave the sums of their hashes as they were, but not the leaf.
    swapped = rows.withColumn("record", F.when(F.col("offset") == 3, F.lit("r4")).when(F.col("offset") == 4, F.lit("r3")).otherwise(F.col("record")))
    assert {(r.offset, r.status) for r in merkle.audit(rows, swapped).filter("status <> 'intact'").collect()} == {(3, "corrupt"), (4, "corrupt")}


def test_merkle_of_many_records_at_one_offset(spark):
    rows = spark.range(20_000).select(F.lit(None).cast("long").alias("offset"), F.col("id").cast("string").alias("record"))
    got = {r.status for r in merkle.audit(rows, rows.repartition(7)).collect()}
    assert got == {"intact"} and {r.status for r in merkle.audit(rows, rows.filter("record <> '77'")).collect()} == {"corrupt"}


def test_warc_files_round_trip(spark, tmp_path):
    bodies = ["plain", "with\r\n\r\nWARC/1.1\r\nblank lines", "", "\u00e9\u4e2d" * 5]
    rows = spark.createDataFrame([(i, f"http://h/{i}", b) for i, b in enumerate(bodies)], "offset long, url string, html string")
    records = rows.select("offset", merkle.record_text(F.col("url"), F.col("html")).alias("record"))
    merkle.write_warc(records.coalesce(1), str(tmp_path / "w"))
    back = sorted((r.file, r.offset, bytes(r.record)) for r in merkle.read_warc(spark, str(tmp_path / "w")).collect())
    assert [r for *_, r in back] == [r.record.encode() for r in records.orderBy("offset").collect()]
    for name, at, record in back:
        content = open(name.removeprefix("file:"), "rb").read()
        assert content[at : at + len(record) + 4] == record + b"\r\n\r\n"
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.warc").write_bytes(b"WARC/1.1\r\nContent-Length: 2\r\n\r\nab\r\n\r\nno record")
    assert sorted((r.offset, bytes(r.record)) for r in merkle.read_warc(spark, str(tmp_path / "bad")).collect())[1] == (37, b"no record")


def test_urls(spark):
    rules = [("com", "/", "allow"), ("a.com", "/en/", "block")]
    urls = [(1, "http://B.a.COM/en/x"), (1, "http://B.a.COM/en/x"), (2, None), (3, ""), (4, "no scheme"), (5, "http://xa.com/en/"), (6, "https://a.com"), (7, "x://y?://z"), (8, "http://h/" + "p/" * 20_000), (9, "://")]
    pages = spark.createDataFrame([(*u, "clash", "clash") for u in urls], "page_id long, url string, host string, verdict string")
    none = spark.createDataFrame([], "url string, bad boolean")
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_rules.judge_urls(pages, none, rules).orderBy("page_id").collect()]
    assert got[:2] == [(1, "b.a.com", "/en/x", "a.com/en/", "block")] * 2
    assert [g[1:] for g in got[2:5]] == [("", "", None, "allow")] * 3
    assert got[5][1:] == ("xa.com", "/en/", "com/", "allow") and got[6][1:] == ("a.com", "", None, "allow") and got[7][1:3] == ("y", "")
    assert got[8][1] == "h" and len(got[8][2]) == 40_001 and got[9][1:] == ("", "", None, "allow")
    assert url_rules.judge_urls(no_rows(pages), none, rules).count() == 0


def test_decontamination(spark, docs):
    bench = spark.createDataFrame([("i", "Quick Brown"), ("j", None), (None, "the lazy dog"), ("k", ""), ("i", "quick brown"), ("l", "absent words")], "item_id string, text string")
    got = {r.doc_id: r for r in decontam.report(decontam.find_overlaps(docs, bench)).collect()}
    # "the lazy dog" has no item id: a hit, but of no item.
    assert got[1].n_hit == 12 + 18 and got[1].n_items == 1 and got[2].n_words == 0 and not got[3].contaminated and not got[6].contaminated
    assert decontam.report(decontam.find_overlaps(docs, no_rows(bench))).filter("contaminated").count() == 0
    assert decontam.report(decontam.find_overlaps(no_rows(docs), bench)).count() == 0
    kept = decontam.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 3


def test_outliers(docs):
    got = {r.doc_id: r for r in outliers.judge(docs).collect()}
    assert got[2].n_words == 0 and got[2].base_failed and not got[2].kept and got[4].word_chars == 0 and got[6].n_words == 200_000 and got[6].base_failed
    assert outliers.judge(docs).count() == len(ROWS) and outliers.judge(no_rows(docs)).count() == 0
    assert outliers.judge(docs, least=1).count() == len(ROWS)
    assert outliers.keep_good(docs).columns == docs.columns


def test_tokens(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(str(path))
    wanted = sorted((i is None, i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in ROWS if i is not None)
    spec = open(path, encoding="utf-8").read()
    got = tokens.count_tokens(docs, spec).collect()
    assert sorted((False, r.doc_id, r.n_bytes, r.n_tokens) for r in got if r.doc_id is not None) == wanted and len(got) == len(ROWS)
    assert tokens.count_tokens(no_rows(docs), spec).count() == 0
    # With next to nothing broadcast, the shuffle gives the same.
    assert sorted(map(str, tokens.count_tokens(docs, spec, head_pieces=1).collect())) == sorted(map(str, got))


def test_tokens_of_texts_whose_short_hashes_are_equal(spark):
    """Under a null and a repeated id; F.hash gives the two texts of each pair the same 32 bits."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(str(path))
    pairs = [(5, 151709, 0, 335349), (3, 157328, 0, 256662), (2, 70226, 5, 224782), (0, 85232, 3, 262426)]
    texts = [f"{'word ' * k}n{i}" for a, b, c, d in pairs for k, i in ((a, b), (c, d))] + [f"text {i}" for i in range(200)]
    rows = spark.createDataFrame([(i, t) for i in (None, 7) for t in texts], "doc_id long, text string").repartition(3)
    assert rows.select(F.hash("text")).distinct().count() == len(texts) - len(pairs)
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in tokens.count_tokens(rows, open(path, encoding="utf-8").read()).collect())
    assert got == sorted((i, len(t), len(tok.encode(t, add_special_tokens=False).ids)) for i in (0, 7) for t in texts)


def test_tokens_of_long_and_frequent_pieces(spark):
    """Pieces of more than NAME_LENGTH characters, in the head and in the shuffle, and 200,000 rows without an id."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, spec = Tokenizer.from_file(str(path)), open(path, encoding="utf-8").read()
    texts = ["-" * 300 + " x", "=" * 49 + " y " + "-" * 300, "z" * 5000, "z" * 5000 + "q", "-" * 48]
    want = sorted((len(t), len(tok.encode(t, add_special_tokens=False).ids)) for t in texts * 3)
    for head in (1, tokens.HEAD_PIECES):
        rows = spark.createDataFrame([(None, t) for t in texts * 3], "doc_id long, text string")
        assert sorted((r.n_bytes, r.n_tokens) for r in tokens.count_tokens(rows, spec, head_pieces=head).collect()) == want
    many = spark.range(200_000, numPartitions=8).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("a"), F.col("id").cast("string")).alias("text"))
    got = tokens.count_tokens(many, spec).agg(F.count("*"), F.sum("n_bytes")).first()
    assert tuple(got) == (200_000, 200_000 + sum(len(str(i)) for i in range(200_000)))


CLASHING = ["__s", "__key", "__lang", "__d", "__k", "row", "text_key", "text_key_2", "s", "failed", "key", "feeds", "k_lang", "d2", "loc", "precision", "_maybe", "_word", "_place", "_bits", "kept", "copies", "doc_id_2", "a.b"]


def test_filters_keep_columns_of_any_name(spark, labels):
    """Every operator that passes rows on gives back the values of all columns."""
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcdefghij") * rng.randrange(2, 6) + rng.choice("klmnop") for _ in range(90)) + (" end The" if k == 4 else "") for k in range(8)]
    rows = [(i, texts[i % 8], "en", "s") for i in range(80)] + [(None, None, None, None), (200, None, "en", "s"), (201, "", "en", "s")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    d = d.withColumns({c: F.concat_ws(":", F.lit(c), F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit("-")))) for c in CLASHING}).repartition(3).cache()
    bench = spark.createDataFrame([("i", "end the")], "item_id string, text string")
    given = {tuple(r) for r in d.collect()}
    for kept in (outliers.keep_good(d, least=8), neardup.keep_first(d), decontam.drop_contaminated(d, bench), quality.keep_good(d, d, labels, threshold=0.0)):
        assert kept.columns == d.columns and 0 < kept.count() and {tuple(r) for r in kept.collect()} <= given
    assert {r.doc_id for r in decontam.drop_contaminated(d, bench).collect()} == {r.doc_id for r in d.collect() if "end The" not in (r.text or "")}


def test_ties(spark):
    """Scores at a threshold, distances at a cut, and documents of equal similarity have a defined side."""
    d = spark.createDataFrame([(i, PLAIN * 2, "en", "s") for i in range(70)], "doc_id long, text string, lang string, source string")
    assert quality.classify(d, spark.createDataFrame([], "doc_id long, quality int"), threshold=0.5).filter("predicted = 1").count() == 70
    assert outliers.judge(d).filter("not base_failed").filter("not kept").count() == 0
    same = spark.createDataFrame([(5, "a b c d e"), (3, "a b c d e"), (4, "A B C D E")], "doc_id long, text string")
    assert [r.doc_id for r in neardup.keep_first(same).collect()] == [3]
    four_of_five = spark.createDataFrame([(1, "a b c d e f g h"), (2, "a b c d e f g h i")], "doc_id long, text string")
    assert neardup.find_duplicates(four_of_five, 5, 0.8).filter("component_id = 1").count() == 2


def test_mixing(spark, docs):
    got = mixing.mix(docs).collect()
    assert len(got) == len(ROWS) and all(0 <= r.taken <= 2 * r.size for r in got)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(5)).collect()))
    assert mixing.mix(no_rows(docs)).count() == 0
    blank = docs.withColumn("text", F.lit(None).cast("string"))
    assert {(r.size, r.taken) for r in mixing.mix(blank).collect()} == {(0, 0)}
    w = spark.createDataFrame([(1, 100.0), (1, 0.1), (None, 1.0)], "doc_id long, weight double")
    assert mixing.mix(docs, w).count() == len(ROWS)


def test_near_duplicates(docs):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.find_duplicates(docs, 3, 0.85).collect()}
    assert got[8][1:] == (1, False) and got[1][1:] == (1, True) and got[2] == (0, 2, True) and got[4] == (0, 4, True) and got[9][0] == 1 and got[None][1:] == (None, True)
    assert neardup.find_duplicates(docs, 3, 0.85).count() == len(ROWS) and neardup.find_duplicates(no_rows(docs)).count() == 0
    kept = neardup.keep_first(docs, 3, 0.85)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 5, 6, None, 9, 10]))
