"""How the work of a query is dealt out, and how much of it there is."""

import re
import zlib

import numpy as np

from heliograph.operators import encode, terms, weights
from heliograph.plans.registry import QUERIES
from heliograph.scratch import settle


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_language_is_one_task(spark, sf):
    """Neither texts nor terms are dealt by their class to be joined, also where the tables are more than Spark broadcasts."""
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        top = plan(QUERIES["ctfidf_terms"](spark, sf))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    assert set(re.findall(r"(\w+Join) \[(?:cluster|lang)#\d+\], \[", top)) == {"BroadcastHashJoin"}


def test_encoder_cuts_a_text_at_once(monkeypatch):
    """Pieces are not hashed one by one, only whole words; vectors are those of a plain sum over pieces."""
    from collections import Counter

    calls = []
    monkeypatch.setattr(encode, "crc32", lambda b: calls.append(b) or zlib.crc32(b))
    texts = ["a", "", "Tank tanks the tank", "straße ÄÖ İstanbul the", "x" * 300 + " the a a", "tanks", "漢字仮名交 𝒳𝒴𝒵𝒳𝒴𝒵"]
    encoder = encode.PieceEncoder()
    got = encoder(texts)
    assert len(calls) == sum(len(set(re.findall(r"[^\W_]+", t.lower()))) for t in texts)
    assert (encoder(texts[::-1])[::-1] == got).all()
    for text, v in zip(texts, got):
        found = Counter()
        for w in re.findall(r"[^\W_]+", text.lower()):
            found.update([f"<{w}>"] + [f"<{w}>"[i : i + k] for k in (3, 4, 5) if len(w) + 2 > k for i in range(len(w) + 3 - k)])
        plain = sum((np.sqrt(c) * encoder.projection[zlib.crc32(p.encode()) % encoder.buckets].astype(float) for p, c in found.items()), np.zeros(64))
        assert np.allclose(plain / (np.linalg.norm(plain) or 1.0), v, atol=1e-6)


def test_terms_are_counted_within_their_row(spark):
    """No term is shuffled to be counted in its text; keys that come back, null and empty texts count as before."""
    rows = spark.createDataFrame([(1, "aa bb aa bb"), (1, "bb cc"), (2, ""), (3, None), (None, "dd"), (4, "dd dd dd")], "ord long, text string")
    got = {(r.ord, r.term): r.tf for r in terms.term_counts(rows, []).collect()}
    assert got == {(1, "aa"): 2, (1, "bb"): 3, (1, "cc"): 1, (1, "aa bb"): 2, (1, "bb aa"): 1, (1, "bb cc"): 1, (None, "dd"): 1, (4, "dd"): 3, (4, "dd dd"): 2}
    assert "Exchange" not in plan(terms.term_counts(rows.filter("ord > 1"), []))


def test_terms_of_classes_are_dealt_once(spark):
    """From the counts on, terms are shuffled once, not once for their sums and again to be joined with them."""
    rows = spark.createDataFrame([(0, 1, "aa bb"), (1, 2, "bb cc")], "cluster int, ord int, text string")
    assert plan(terms.class_terms(rows, [], k=None)).count("hashpartitioning(term") == 1
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000000")
    try:
        assert not re.findall(r"Join \[term", plan(terms.class_terms(rows, [], k=None)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)


def test_texts_are_matched_once(spark, sf):
    """Words and themes of theme_top_terms are written down together; weights neither match texts again nor are joined with rows."""
    top = plan(QUERIES["theme_top_terms"](spark, sf))
    assert "regexp_extract_all" not in top and not re.findall(r"Join \[ord", top)


def test_vocabulary_and_weights_by_number(spark):
    """Against counts of all terms: ties at the end of the vocabulary, words too frequent for it, few words, null and empty texts."""
    rng = np.random.default_rng(2)
    names = [f"{a}{b}" for a in "abcdef" for b in "uvwxyz"]
    texts = [" ".join(["au", *rng.choice(names, rng.integers(0, 14), p=np.arange(36, 0, -1) / 666)]) for _ in range(90)] + ["", None, "  ", "only only", "Zz\nzz 9 zz"]
    rows = spark.createDataFrame(list(enumerate(texts)) + [(None, "au bv bv")], "ord long, text string")
    n = rows.count()
    words = terms.words_of(rows, ["fz"])
    counts = settle(terms.term_counts(rows, ["fz"]), "counts")
    for bounds in ({"most": 1}, {"most": 7}, {"most": 40}, {"most": 300}, {}, {"most": None}, {"most": 60, "min_df": 1, "max_share": 1.0}, {"min_df": 80}):
        want = terms.vocabulary_of(counts, n, **bounds)
        assert sorted(terms.vocabulary_of_words(words, n, **bounds).collect()) == sorted(want.collect())
        wanted = {(r.ord, r.term): r.w for r in terms.tfidf(counts.join(want.select("term"), "term", "left_semi"), want, n).collect()}
        got = {(r.ord, r.term): r.w for r in terms.weights_of(words, n, **bounds).collect()}
        assert got.keys() == wanted.keys() and np.allclose([got[k] for k in wanted], list(wanted.values()), atol=1e-12)
    twice = rows.unionByName(rows.limit(30))
    want = terms.vocabulary_of(terms.term_counts(twice, []), n, most=40)
    assert sorted(terms.vocabulary_of_texts(twice, [], n, most=40).collect()) == sorted(want.collect())


def test_pieces_of_batches(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(weights, "PIECE", 3)
    rows = [["a", "b"], [], ["b"], ["c", "a", "a", "d"], None, ["d"], []]
    batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string()))], ["t"])
    got = [(part.num_rows, [(r, words[c].as_py()) for r, c in zip(row.tolist(), code.tolist())]) for part, row, code, words in weights._pieces([batch.slice(0, 0), batch, batch.slice(3, 2)])]
    assert sum(len(x) for _, x in got) == 12 and len(got) > 3 and all(r < n for n, x in got for r, _ in x)
    assert [w for _, x in got for _, w in x] == list("abbcaad" "dcaad")


def test_members_are_the_themes_assigned(spark, sf):
    from heliograph.operators import themes
    from heliograph.plans.tables import articles
    from heliograph.vocab import NEWS, PROSE

    odd = spark.createDataFrame([(1, None, None), (2, "", "ung the the tion"), (3, "Schön THE", "tion"), (4, "x", None), (5, None, "tion the"), (6, "x", "kyiv nato İ")], "ord long, headline string, body string")
    for rows, vocabulary in ((articles(spark, sf), PROSE), (odd, PROSE), (odd, NEWS)):
        want = {r.ord: r.themes for r in themes.assign(rows, vocabulary).collect()}
        assert {r.ord: r.themes for r in themes.members(rows, vocabulary).collect()} == want


def test_length_is_computed_once_a_vector(spark):
    from pyspark.sql import functions as F

    from heliograph.functions.vectors import unit

    rows = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, None), (4, [])], "id long, v array<float>").select("id", unit(F.col("v")).alias("u"))
    assert {r.id: r.u for r in rows.collect()} == {1: [0.6, 0.8], 2: [0.0, 0.0], 3: None, 4: []}
    assert not re.search(r"/ CASE WHEN \(\w*\(*SQRT", plan(rows), re.I)


def test_products_of_lsa_do_not_read_rows(spark, monkeypatch):
    """While singular vectors are found, the rows of the matrix are out of reach; what is found is that of an SVD."""
    from pathlib import Path

    from heliograph.operators import layout

    rng = np.random.default_rng(11)
    n, m = 200, 150
    x = np.where(rng.random((n, m)) < 0.1, rng.random((n, m)), 0.0)
    x[:, 7] = 0.3
    written = {}
    monkeypatch.setattr(layout, "settle", lambda df, tag: written.setdefault(tag, settle(df, tag)))
    found = layout.leading

    def apart(product, *args):
        there = Path(written["matrix"]._settled_at.removeprefix("file://"))
        aside = there.rename(f"{there}-aside")
        try:
            return found(product, *args)
        finally:
            aside.rename(there)

    monkeypatch.setattr(layout, "leading", apart)
    rows = spark.createDataFrame([(int(i), f"t{j:03d}", float(x[i, j])) for i, j in zip(*x.nonzero())], "ord int, term string, w double")
    got = {r.ord: np.array(r.z) for r in layout.lsa(rows, n, most=5).collect()}
    v = np.linalg.svd(x)[2][:5]
    v = v * np.sign(v[np.arange(5), np.abs(v).argmax(axis=1)])[:, None]
    assert np.allclose(np.stack([got[i] for i in range(n)]), x @ v.T, atol=1e-8)


def test_lsa_of_many_terms_multiplies_rows(spark, monkeypatch):
    """Where a matrix of terms by terms would take too much, none is made."""
    from heliograph.operators import layout

    rng = np.random.default_rng(12)
    w = [(i, f"t{j}", float(rng.random() + 0.1)) for i in range(80) for j in sorted(rng.choice(70, 9, replace=False))]
    rows = spark.createDataFrame(w, "ord int, term string, w double")
    want = {r.ord: r.z for r in layout.lsa(rows, 80, most=4).collect()}
    monkeypatch.setattr(layout, "MOST_SQUARE", 8 * 70 * 70 - 1)
    monkeypatch.setattr(layout, "_square", None)
    got = {r.ord: r.z for r in layout.lsa(rows, 80, most=4).collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[i], want[i], atol=1e-8) for i in want)


def test_tiles_of_terms_by_terms(monkeypatch):
    """Rows and pairs that are cut anywhere, terms in any order, tiles that don't go up in the terms, empty batches."""
    from types import SimpleNamespace

    import pyarrow as pa

    from heliograph.operators import layout

    rng = np.random.default_rng(13)
    m, x = 23, np.where(rng.random((40, 23)) < 0.3, rng.random((40, 23)) - 0.3, 0.0)
    x[0], x[1] = 1.0, np.eye(23)[4]
    x[:, 9:12] = 0.0
    each = [rng.permutation(np.flatnonzero(r)) for r in x]
    kind = pa.schema([("ord", pa.int64()), ("terms", pa.list_(pa.int32())), ("ws", pa.list_(pa.float64()))])
    batch = pa.RecordBatch.from_pydict({"ord": list(range(40)), "terms": [e.tolist() for e in each], "ws": [r[e].tolist() for r, e in zip(x, each)]}, kind)
    q = rng.normal(size=(m, 3))
    for side, pairs, entries in ((5, 1, 1), (23, 30, 20), (8, 1 << 18, 1 << 14), (64, 100, 7)):
        for name, value in (("TILE", side), ("PAIRS", pairs), ("ENTRIES", entries)):
            monkeypatch.setattr(layout, name, value)
        strips = [*layout._crossed(iter([batch.slice(0, 0), batch.slice(0, 17)]), m), *layout._crossed(iter([batch.slice(17, 20), batch.slice(37)]), m), *layout._crossed(iter([]), m)]
        tiles = list(layout._tiles(iter(strips), m))
        got = np.zeros((m, 3))
        for part in (tiles[:1], tiles[1:], []):
            for b in layout._tiles_times(iter(part), SimpleNamespace(value=q)):
                for a, z in zip(b.column("a").to_pylist(), b.column("x").to_pylist()):
                    got[a * side : (a + 1) * side] += np.frombuffer(z).reshape(-1, 3)
        assert np.allclose(got, x.T @ x @ q, atol=1e-12)
        z = [r for b in layout._projected(iter([batch.slice(3, 0), batch]), SimpleNamespace(value=q), "ord") for r in b.to_pylist()]
        assert [r["ord"] for r in z] == list(range(40)) and np.allclose([r["z"] for r in z], x @ q, atol=1e-12)
