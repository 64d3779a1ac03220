"""Each operator against a plain version of what it computes."""

import itertools
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from heliograph.llm import langid, mixing, neardup, outliers, quality, queries, tokens, toxicity, url_rules
from heliograph.llm.common import fold, read


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_agrees_with_sql(spark, sf, con, name):
    from tests.test_queries import same

    same(queries.QUERIES[name](spark, sf), con, queries.ORACLES[name])


def test_token_counts(spark, sf):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    texts = {r.doc_id: r.text for r in read(spark, sf, "documents").collect()}
    got = queries.op8_token_counts(spark, sf).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in got} == {i: (len(t.encode()), n := len(tok.encode(t, add_special_tokens=False).ids), n > 512) for i, t in texts.items()}


def test_pretokens_of_odd_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    spec = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    tok, split = tokens._tools(spec)
    plain = Tokenizer.from_str(spec)
    rng = random.Random(2)
    letters = "abZ é'sß'll 12½²\n\t \u00a0\u2003\u3000\u0085\u200b中文ъ😀#–…<|endoftext|>\x1c\x00ªº"
    for _ in range(3000):
        t = "".join(rng.choice(letters) for _ in range(rng.randrange(25)))
        pieces, special = split(t)
        assert sum(len(tok.encode(p, add_special_tokens=False).ids) for p in pieces) + special == len(plain.encode(t, add_special_tokens=False).ids), repr(t)


def _plain_statistics(t):
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", t or "") if x]
    tri = Counter(zip(w, w[1:], w[2:]))
    hit = {j for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in (t or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(hit)


def test_word_hashes_tell_words_apart(monkeypatch):
    from heliograph.llm import decontam

    rng = random.Random(4)
    texts = [decontam.plain(" ".join(rng.choice(["a", "b", "ab", "ba", "é", "12", "x" * 70, "y" * 200]) + rng.choice(["", ",", " -- "]) for _ in range(rng.randrange(40)))) for _ in range(60)] + [b"", b"   ", b"z" * 500]
    want = [(i, w) for i, t in enumerate(texts) for w in t.split()]
    whole = decontam.word_hashes(texts)
    for piece in (1 << 17, 64):  # in pieces that some words are longer than
        monkeypatch.setattr(decontam, "PIECE", piece)
        owner, h = decontam.word_hashes(texts)
        assert owner.tolist() == [i for i, _ in want] and (h == whole[1]).all()
        assert len({*zip([w for _, w in want], h.tolist())}) == len({w for _, w in want}) == len({*h.tolist()})
    assert decontam.word_hashes([])[0].size == decontam.word_hashes([b""])[0].size == 0


def test_benchmark_far_larger_than_the_filter(spark, monkeypatch):
    """With a filter of 64 bits nearly every shingle passes; results stay the same."""
    from heliograph.llm import common, decontam

    rng = random.Random(9)
    items = [(f"i{k}", " ".join(rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(rng.choice([3, 9, 14])))) for k in range(60)]
    docs = [(k, " ".join([rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(30)] + (items[k % 60][1].split() if k % 3 == 0 else []) + ["end"])) for k in range(90)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")
    key = lambda t: sorted(map(str, t.collect()))
    got = decontam.find_overlaps(d, b)
    plain = []
    for i, t in docs:
        w, hit, ids = t.split(), set(), set()
        for name, text in items:
            x = text.split()
            k = min(10, len(x))
            for a in range(len(x) - k + 1):
                for at in range(len(w) - k + 1):
                    if w[at : at + k] == x[a : a + k]:
                        hit |= {*range(at, at + k)}
                        ids.add(name)
        plain.append((i, len(w), len(hit), sorted(ids)))
    assert sorted((r.doc_id, r.n_words, sum(s.stop - s.start for s in r.spans), r["items"]) for r in got.collect()) == plain
    first = key(got)
    for module in (common, decontam):
        monkeypatch.setattr(module, "FILTER_BITS", 64)
    assert key(decontam.find_overlaps(d, b)) == first
    assert {r.doc_id for r in decontam.drop_contaminated(d, b).collect()} == {i for i, _, n, _ in plain if not n}


def test_statistics(spark, sf):
    odd = ["a b c a b c", "a a a a", "x\u00a0y z", "l\n l\nl\n\n", "é é é\x0bé", "", None, "# <b> |", "a b a b a b"]
    for t in odd + [r.text for r in read(spark, sf, "documents").collect()]:
        assert outliers.statistics(t)[:5] == _plain_statistics(t), t


def _plain_mcd(q, floors):
    """(loc, precision) of whole-number rows, by the steps in numpy from each start."""
    n, p = q.shape
    x, found = q / outliers.GRID, []

    def model(rows, share):
        m = len(rows)
        loc = rows.sum(0) / m / outliers.GRID
        cov = (rows.T @ rows / m / outliers.GRID**2 - np.outer(loc, loc)) * share / outliers.chi2_cdf(outliers.chi2_quantile(share, p), p + 2)
        cov += np.diag(np.maximum(np.diag(cov), np.square(floors)) - np.diag(cov))
        return loc, np.linalg.inv(cov), np.linalg.slogdet(cov)[1]

    distances = lambda loc, prec: np.einsum("ij,jk,ik->i", x - loc, prec, x - loc)
    at = np.percentile(q, [100 * f for f in outliers.QUANTILES], axis=0)
    for (a, b), (lo, hi), factor in outliers.STARTS:
        loc, prec = (at[a] + at[b]) / 2 / outliers.GRID, np.diag(1 / np.maximum((at[hi] - at[lo]) / factor / outliers.GRID, floors) ** 2)
        for _ in range(outliers.STEPS):
            level = np.ceil(np.log2(distances(loc, prec) + 2.0**-20) * outliers.LEVELS)
            loc, prec, spread = model(q[level <= np.sort(level)[int(np.ceil(outliers.SHARE * n)) - 1]], outliers.SHARE)
        found.append((spread, len(found), loc, prec))
    _, _, loc, prec = min(found, key=lambda f: f[:2])
    return model(q[distances(loc, prec) <= outliers.chi2_quantile(outliers.REWEIGHTED, p)], outliers.REWEIGHTED)[:2]


def test_robust_models_match_numpy(spark):
    rng = np.random.default_rng(0)
    n, p, floors = 400, 3, (0.1, 0.1, 0.1)
    x = rng.normal(size=(n, p)) @ np.array([[1, 0.4, 0], [0, 1, 0.2], [0, 0, 0.5]])
    x[:40] += 9
    q = np.round(x * outliers.GRID).astype(np.int64)
    rows = spark.createDataFrame([("k", *r) for r in q.tolist()], "key string, a long, b long, c long")
    loc, prec = _plain_mcd(q, floors)
    for parts in (1, 7):  # however the rows are dealt
        got = outliers.fit(rows.repartition(parts), ["a", "b", "c"], floors).first()
        assert np.allclose(got.loc, loc, atol=1e-9) and np.allclose(np.array(got.precision).reshape(p, p), prec, rtol=1e-7)
    assert np.abs(loc).max() < 0.3  # the 10 % far away didn't move it


@pytest.mark.parametrize("least", [outliers.LEAST_ROWS, 34])
def test_quality_rules_query_matches_brute_force(spark, least):
    """Every column of the query; and of the operator where some groups have models of their own and others not."""
    sf = "/root/testdata/sf0.01"
    docs = read(spark, sf, "documents").select("doc_id", "text", "lang", "source").collect()
    stats, vector = {}, {}
    for r in docs:
        t = r.text or ""
        s = _plain_statistics(t)
        chars, lines = max(1, s[1]), max(1, len([x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]))
        upper, marks = sum("A" <= c <= "Z" for c in t), sum(c in outliers._MARKS.decode() for c in t)
        v = [np.log(max(s[1] / max(1, s[0]), 0.5)), np.log1p(100 * s[2] / chars), s[3] / lines, s[4] / max(1, s[0]), upper / chars, np.log1p(10 * marks / chars)]
        stats[r.doc_id], vector[r.doc_id] = s, np.floor(np.array(v) * outliers.GRID + 0.5)
    failed = {i: s[0] < 50 or 100 * s[4] > 50 * s[0] for i, s in stats.items()}
    passed = [r for r in docs if not failed[r.doc_id]]
    models = {}

    def model(name, rows):
        if name not in models:
            models[name] = _plain_mcd(np.array([vector[r.doc_id] for r in rows]), outliers.FLOORS)
        return models[name]

    want, levels = {}, Counter()
    for r in docs:
        group, lang = [x for x in passed if (x.lang, x.source) == (r.lang, r.source)], [x for x in passed if x.lang == r.lang]
        level = next((k for k, rows in enumerate((group, lang, passed)) if len(rows) >= least))
        loc, prec = model([("g", r.lang, r.source), ("l", r.lang), "all"][level], (group, lang, passed)[level])
        d = vector[r.doc_id] / outliers.GRID - loc
        levels[level] += 1
        want[r.doc_id] = (*stats[r.doc_id], failed[r.doc_id], not failed[r.doc_id] and d @ prec @ d <= outliers.chi2_quantile(1 - outliers.TAIL, len(d)))
    got = {r.doc_id: tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")) for r in (queries.op7_quality_rules(spark, sf) if least == outliers.LEAST_ROWS else outliers.judge(read(spark, sf, "documents"), least)).collect()}
    assert got == want and (least == outliers.LEAST_ROWS or len(levels) > 1) and any(not k and not f for *_, f, k in want.values())


def test_chi2():
    assert outliers.chi2_quantile(0.95, 1) == pytest.approx(3.8415, abs=1e-3) and outliers.chi2_quantile(0.99, 5) == pytest.approx(15.0863, abs=1e-3)


def test_outliers_are_rejected_and_clean_texts_kept(spark):
    rng = random.Random(3)
    say = lambda n: " ".join(rng.choice(["word", "other", "river", "plain", "speech", "is", "of", "tree", "quiet", "lamp"]) + rng.choice(["", "s", "ed", "ly"]) for _ in range(n)) + "."
    rows = [(i, say(rng.randrange(60, 300)), "en", "s") for i in range(300)] + [(1000 + i, " ".join(w + "$$$" for w in say(120).split()), "en", "s") for i in range(5)]
    got = {r.doc_id: r.kept for r in outliers.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).filter("not base_failed").collect()}
    assert not any(got[i] for i in got if i >= 1000) and np.mean([got[i] for i in got if i < 1000]) > 0.98


def _near_rows(seed, groups, size):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"w{rng.randrange(4000)}" for _ in range(60)]
        for _ in range(size):
            w = base[:]
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = f"v{rng.randrange(50)}"
            rows.append((len(rows), " ".join(w)))
    return rows


def _plain_components(rows, size, threshold):
    sets = {i: frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if (w := t.lower().split()) else frozenset() for i, t in rows}
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 1000 * both >= 1000 * threshold * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            top[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("block", [4, 512])
def test_near_duplicates_of_diffuse_groups(spark, block):
    """Large groups in which many pairs lie just above and below the similarity, with blocks that large groups exceed."""
    rows = _near_rows(5, 3, 60)
    got = {r.doc_id: r.component_id for r in neardup.find_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 0.85, block=block).collect()}
    assert got == _plain_components(rows, 3, 0.85)


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 440)]
    got = {r.node: r.root for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    top = {}
    for a, b in edges:
        top.setdefault(a, {a}), top.setdefault(b, {b})
        if top[a] is not top[b]:
            top[a] |= top[b]
            for x in top[b]:
                top[x] = top[a]
    assert got == {n: min(s) for n, s in top.items() if len(s) > 1}


def test_bands_and_bounds():
    r = neardup.band_rows(0.85)
    assert (1 - 0.85**r) ** (256 // r) <= neardup.BAND_MISS
    least = neardup.least_matches(0.85)
    assert least == sorted(least) and least[-1] < 0.85 * 256
    rng = np.random.default_rng(0)
    found = rng.binomial(1, 0.8506, (4000, 256)).reshape(4000, -1, neardup.BATCH).sum(2).cumsum(1)
    assert (found >= np.array(least)).all(1).mean() > 0.999  # pairs at the similarity survive


def test_targets(spark):
    sizes = {"a": 10, "b": 1000, "c": 500, "d": 7, "e": 4000}
    rows = spark.createDataFrame([(k, 1, v) for k, v in sizes.items()] + [(None, 1, 300)], "source string, n_docs long, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    every = [*sorted(sizes), None]
    size, w = np.array([*(sizes[k] for k in every[:-1]), 300.0]), np.array([3, 1, 2, 3, 1, 2.0])
    target, full = np.zeros(6), np.zeros(6, bool)
    while True:  # the excess is shared again until none is above
        target = np.where(full, 2 * size, (1.5 * size.sum() - 2 * size[full].sum()) * w / w[~full].sum())
        if not (target > 2 * size + 1e-9).any():
            break
        full |= target > 2 * size
    assert [got[k] for k in every] == pytest.approx(target.tolist())


def test_mix_follows_order_of_keys(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 37)), "ab"[i % 5 == 0]) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = df.select("doc_id", F.when(F.col("doc_id") % 2 == 0, 40.0).otherwise(0.01).alias("weight"))
    got = {r.doc_id: r for r in mixing.mix(df, weights, bucket_rows=16).collect()}
    keys = {r.doc_id: r.k for r in df.join(weights, "doc_id").select("doc_id", mixing.sampling_key(mixing.chance(F.col("doc_id"), F.col("text"), 17), F.col("weight")).alias("k")).collect()}
    for s in "ab":
        own = [r for r in got.values() if r.source == s]
        left = own[0].target - int(own[0].target / own[0].source_size) * own[0].source_size
        epochs, ahead = int(own[0].target / own[0].source_size), 0
        for r in sorted(own, key=lambda r: keys[r.doc_id]):
            assert r.taken == r.size * (epochs + (ahead + r.size / 2 <= left and left > 0))
            ahead += r.size
        assert abs(sum(r.taken for r in own) - own[0].target) <= 19
    extra = [r.doc_id % 2 == 0 for r in got.values() if r.source == "a" and r.taken > int(r.target / r.source_size) * r.size]
    assert extra and np.mean(extra) > 0.9  # heavier documents are taken sooner, as much as their weights say


def test_buckets_of_null_and_repeated_ids_are_even(spark):
    """A third of the rows without an id, a third under one id, and weights from 0.001 to 1000."""
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, 7).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("w "), F.col("id").cast("string")).alias("text"), F.lit("s").alias("source"))
    weights = df.select("doc_id", F.pow(F.lit(10.0), F.col("doc_id") % 7 - 3).alias("weight"))
    keys = df.join(weights.groupBy("doc_id").agg(F.max("weight").alias("weight")), "doc_id", "left").select(mixing.sampling_key(mixing.chance(F.col("doc_id"), F.col("text"), 17), F.coalesce("weight", F.lit(1.0))).alias("k"))
    assert keys.distinct().count() == 6000
    got = mixing.mix(df, weights, bucket_rows=64).collect()
    assert len(got) == 6000 and abs(sum(r.taken for r in got) - got[0].target) <= 2


def test_mined_rules_match_brute_force(spark):
    rng = random.Random(7)
    urls = [(f"http://{rng.choice(['a', 'b', 'c'])}.{rng.choice(['x', 'y'])}.org/{rng.choice(['en', 'de', 'fr'])}/p?{rng.choice(['k=1', 'k=2'])}",) for _ in range(800)]
    rows = [(u, rng.random() < (0.9 if "a.y" in u and "/de" in u else 0.8 if "c.x" in u else 0.1)) for (u,) in urls]
    df = spark.createDataFrame(rows, "url string, bad boolean")
    got = {tuple(r.tokens): r.confidence for r in url_rules.mine_rules(df, min_rows=15).collect()}
    each = [(frozenset(r.t), r.bad) for r in df.select(url_rules.tokens_of(F.col("url")).alias("t"), "bad").collect()]
    n, share = len(each), np.mean([b for _, b in each])
    least = max(url_rules.MIN_SUPPORT, 15 / n)
    count, bad = Counter(), Counter()
    for t, b in each:
        for k in (1, 2, 3):
            for c in itertools.combinations(sorted(t), k):
                count[c] += 1
                bad[c] += b
    found = {c: bad[c] / count[c] for c in count if bad[c] >= least * n and bad[c] / count[c] >= url_rules.MIN_CONFIDENCE and bad[c] / count[c] / share >= url_rules.MIN_LIFT}
    found = {c: x for c, x in found.items() if not any(found.get(s, -1) >= x for k in range(1, len(c)) for s in itertools.combinations(c, k))}
    assert got == pytest.approx(found) and found
    pages = df.select(F.col("url").alias("page_key"), url_rules.tokens_of(F.col("url")).alias("tokens")).distinct()
    scores = {r.page_key: r.confidence for r in url_rules.score_urls(pages, url_rules.mine_rules(df, min_rows=15)).collect()}
    shuffled = url_rules.score_urls(pages, url_rules.mine_rules(df, min_rows=15), broadcast_rules=0)
    assert {r.page_key: r.confidence for r in shuffled.collect()} == scores
    plain = {r.page_key: max((x for c, x in found.items() if set(c) <= set(r.tokens)), default=None) for r in pages.collect()}
    assert scores == pytest.approx({k: v for k, v in plain.items() if v is not None})


def test_rules_of_urls_with_many_frequent_tokens(spark):
    """Twenty frequent path words a URL: the commonest ones make rules, too."""
    rng = random.Random(11)
    words = [chr(97 + i) * 3 for i in range(22)]
    rows = []
    for _ in range(300):
        own = [w for w in words if rng.random() < 0.8]
        rows.append((f"http://h.org/{'/'.join(own)}", rng.random() < (0.6 if {*words[-3:]} <= {*own} else 0.05)))
    rows += [(f"http://h.org/zz/{'/'.join(words[:3])}", True)] * 20
    df = spark.createDataFrame(rows, "url string, bad boolean")
    got = {tuple(r.tokens): r.confidence for r in url_rules.mine_rules(df, min_rows=10, min_confidence=0.3, min_lift=1.1).collect()}
    each = [(frozenset(r.t), r.bad) for r in df.select(url_rules.tokens_of(F.col("url")).alias("t"), "bad").collect()]
    n, share = len(each), np.mean([b for _, b in each])
    count, bad = Counter(), Counter()
    for t, b in each:
        for k in (1, 2, 3):
            for c in itertools.combinations(sorted(t), k):
                count[c] += 1
                bad[c] += b
    found = {c: bad[c] / count[c] for c in count if bad[c] >= max(url_rules.MIN_SUPPORT, 10 / n) * n and bad[c] / count[c] >= 0.3 and bad[c] / count[c] / share >= 1.1}
    found = {c: x for c, x in found.items() if not any(found.get(s, -1) >= x for k in range(1, len(c)) for s in itertools.combinations(c, k))}
    assert got == pytest.approx(found) and {1, 2, 3} <= set(map(len, found)) and min(len(t) for t, _ in each[:300]) > 12


def test_url_query(spark, sf):
    got = queries.op5_url_filters(spark, sf).collect()
    pages = {r.page_id: r.url for r in read(spark, sf, "pages").collect()}
    assert len(got) == len(pages)
    for r in got:
        rest = pages[r.page_id].partition("://")[2]
        cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
        path = rest[cut:].split("?")[0].split("#")[0]
        fits = [(len(h + p), h + p, v) for h, p, v in queries.URL_RULES if (r.host == h or r.host.endswith("." + h)) and path.startswith(p)]
        assert (r.host, r.path) == (rest[:cut].lower(), path)
        assert r.rule == (max(fits)[1] if fits else None) and (not fits or r.verdict == max(fits)[2])


def test_votes_match_brute_force():
    rng = random.Random(0)
    clean = [" ".join(rng.choice(["tree", "river", "stone", "is", "of", "green"]) for _ in range(40)) + "." for _ in range(60)]
    junk = [t.upper().replace(" ", "!! ") for t in clean[:25]]
    pack = lambda t: quality.pack(quality.term_counts(t))
    model = quality.learn([pack(t) for t in clean + junk], np.array([1] * 60 + [0] * 25), 0.7)
    got = model.scores(clean[:5] + junk[:5] + ["", " \n"], block=3)
    k = min(quality.NEIGHBOURS, 85)
    weight = {1: 0.7 / (60 / 85), 0: 0.3 / (25 / 85)}
    for t, s in zip(clean[:5] + junk[:5], got):
        v = model.embed(quality.term_counts(t)[None])[0]
        sim = model.vectors @ v
        near = np.argsort(-sim)[:k]
        votes = [max(sim[i], 0) * weight[int(model.labels[i])] for i in near]
        assert s == pytest.approx(sum(x for x, i in zip(votes, near) if model.labels[i] == 1) / sum(votes), abs=0.02)
    assert got[:5].min() > 0.9 and got[5:10].max() < 0.3 and got[10] == got[11] == 0.7


def test_quality_query_matches_brute_force(spark, sf):
    """Scores of the query by a full decomposition and a sort of all similarities."""
    texts = {r.doc_id: r.text or "" for r in read(spark, sf, "documents").collect()}
    folds = {r.doc_id: r.f for r in read(spark, sf, "documents").select("doc_id", fold(F.col("doc_id")).alias("f")).collect()}
    known = {r.doc_id: r.quality for r in read(spark, sf, "labels").filter("quality is not null").collect()}
    ids = [i for i in sorted(texts) if i in known and folds[i] != 2]
    # The prior counts all labels outside the held-out fold, of rows without a text, too.
    prior = np.mean([y for i, y in known.items() if folds.get(i) != 2])
    y = np.array([known[i] for i in ids])
    count = {i: quality.term_counts(t).astype(float) for i, t in texts.items()}
    df = (np.stack([count[i] for i in ids]) > 0).sum(0)
    idf = np.where(df >= quality.LEAST_TEXTS, np.log((1 + len(ids)) / (1 + df)) + 1, 0)

    def weigh(c, among):
        x = np.sqrt(np.where(among, c, 0) / max(np.where(among, c, 0).sum(), 1)) * idf
        return x / (np.linalg.norm(x) or 1)

    own = np.stack([weigh(count[i], df >= quality.LEAST_TEXTS) for i in ids])
    basis = np.linalg.svd(own, full_matrices=False)[2][: quality.DIMENSIONS].T
    unit = lambda v: v / n if (n := np.linalg.norm(v)) > 1e-6 else v * 0
    vectors = np.stack([unit(v @ basis) for v in own])
    per = {1: prior / y.mean(), 0: (1 - prior) / (1 - y.mean())}
    got = {r.doc_id: (r.held_out, r.score, r.predicted) for r in queries.op1_quality_classifier(spark, sf).collect()}
    assert got.keys() == texts.keys()
    off = []
    for i, c in count.items():
        # A text's own counts are scaled by all its terms.
        x = np.sqrt(c / max(c.sum(), 1)) * idf
        sim = vectors @ unit((x / (np.linalg.norm(x) or 1)) @ basis)
        near = np.argsort(-sim, kind="stable")[: quality.NEIGHBOURS]
        votes = [max(sim[k], 0) * per[y[k]] for k in near]
        score = sum(v for v, k in zip(votes, near) if y[k] == 1) / sum(votes) if sum(votes) > 0 else prior
        assert got[i][0] == (folds[i] == 2) and got[i][2] == int(got[i][1] >= 0.7)
        off.append(abs(score - got[i][1]))
    assert np.median(off) < 1e-3 and np.mean(np.array(off) < 0.05) > 0.97


def test_language_query_matches_brute_force(spark, sf):
    """Predictions of the query by loops over windows and filters, with the network that it learns."""
    docs = read(spark, sf, "documents")
    net = langid.train(docs)
    e, w, span = net.p["E"].astype(float), net.p["W"].astype(float), langid._SPAN
    got = {r.doc_id: r for r in queries.op2_language_id(spark, sf).collect()}
    for r in docs.orderBy("doc_id").limit(40).collect():
        if not any(c.isalpha() for c in r.text or ""):
            assert got[r.doc_id].lang_pred == "und"
            continue
        data, total = r.text.encode(), np.zeros(len(net.languages))
        for at in range(0, len(data), langid.WINDOW):
            part = data[at : at + langid.WINDOW]
            x = np.concatenate([e[list(part)], np.zeros((langid.WINDOW + span - 1 - len(part), langid.EMBEDDING))])
            x[len(part) : langid.WINDOW] = e[0]
            top = np.max([x[t : t + span].ravel() @ w for t in range(langid.WINDOW)], axis=0)
            z = np.maximum(top + net.p["b"], 0) @ net.p["V"] + net.p["c"]
            total += len(part) * (z - np.log(np.exp(z).sum()))
        p = np.exp(total / len(data) - (total / len(data)).max())
        assert got[r.doc_id].lang_pred == net.languages[int(p.argmax())] and abs(got[r.doc_id].score - p.max() / p.sum()) < 1e-3


def test_every_language_is_learned(spark):
    """More languages than a bound on their number would hold; each has texts in the sample."""
    rows = [(100 * k + i, f"{chr(97 + k % 26)}{chr(97 + k // 26)} " * 30, f"l{k}") for k in range(60) for i in range(8)]
    net = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), texts=3)
    assert len(net.languages) == 60


def test_convolution_matches_loops():
    net = langid.ByteNet(["a", "b", "c"], seed=1)
    x, _ = langid.windows_of(b"some bytes \xc3\xa9 to look at")
    e, w = net.p["E"], net.p["W"]
    padded = np.concatenate([e[x[0]], np.zeros((langid._SPAN - 1, langid.EMBEDDING))])
    top = np.max([padded[t : t + langid._SPAN].ravel() @ w for t in range(x.shape[1])], axis=0)
    z = np.maximum(top + net.p["b"], 0) @ net.p["V"] + net.p["c"]
    assert np.allclose(net.log_probabilities(x)[0], z - np.log(np.exp(z).sum()), atol=1e-4)
    long = b"abc def " * 9000
    assert net.predict(long)[0] == net.predict_many([long, b"x"])[0][0]


def _chain_rows(seed, n=600):
    rng = random.Random(seed)
    words = [f"n{i}" for i in range(80)]
    texts, y = [], []
    for _ in range(n):
        t = [rng.choice(words) for _ in range(30)]
        bad = rng.random() < 0.3
        if bad:
            for w in rng.choice([["idiot", "moron"], ["scum", "trash"], ["vileness", "filth"]]):
                t[rng.randrange(30)] = w
        texts.append(" ".join(t))
        y.append(int(bad))
    return texts, y


def test_chain_learns_from_earlier_categories(spark):
    texts, y = _chain_rows(4)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(y)), "doc_id long, toxic int")
    words, x, toxic = toxicity.sample_features(docs, labels)
    inside = [i for i, r in enumerate(docs.select(fold(F.col("doc_id")).alias("f")).collect()) if r.f != 2]
    assert toxic.tolist() == [y[i] for i in inside]
    assert all({w for w, one in zip(words, row) if one} == {*words} & toxicity.features_of(texts[i]) for row, i in zip(x, inside))
    # The words by a plain count.
    sets = [toxicity.features_of(texts[i]) for i in inside]
    n, n1, rank = len(sets), sum(toxic), []
    for w in set().union(*sets):
        c, bad = sum(w in s for s in sets), sum(w in s for s, t in zip(sets, toxic) if t)
        a, b = bad + 0.5, c - bad + 0.5
        if c >= toxicity.LEAST_TEXTS:
            rank.append((-abs(np.log(a / (n1 + 1.5 - a)) - np.log(b / (n - n1 + 1.5 - b))) / np.sqrt(1 / a + 1 / b), w))
    assert {*words} == {w for _, w in sorted(rank)[: toxicity.FEATURES]}
    chain = toxicity.learn(words, x, toxic)
    p = chain.probabilities(["n1 idiot moron n2", "n1 n2 n3", "", None, "n5 vilenesses filthy n6"])
    assert p[0, -1] > 0.5 and p[1:4, -1].max() < 0.45 and p[4, -1] > 0.5 and p[0, :-1].argmax() != p[4, :-1].argmax()
    assert [len(w) for w in chain.weights] == [len(chain.words) + 1 + k for k in range(len(chain.names))]


def test_chain_matches_plain_version():
    """Every model of the chain, recomputed with out-of-fold predictions of the categories before it."""
    rng = np.random.default_rng(0)
    x = (rng.random((240, 12)) < 0.3).astype(np.uint8)
    y = ((x[:, 0] & x[:, 1]) | x[:, 2]).astype(int)
    chain = toxicity.learn([bytes([97 + i]) for i in range(12)], x, y, kinds=2, folds=4, seed=3)
    kinds = toxicity.kinds_of(x.astype(np.float32), y.astype(np.float32), 2)
    assert (kinds[y == 1] >= 0).all() and (kinds[y == 0] == -1).all() and np.bincount(kinds[kinds >= 0])[0] * 2 >= y.sum()
    of = np.random.default_rng(3).permutation(240) % 4
    sigmoid = lambda z: 1 / (1 + np.exp(-z))

    def plain(rows, target, ridge):
        full, w = np.c_[rows, np.ones(len(rows))], np.zeros(rows.shape[1] + 1)
        v, reach = w.copy(), 0.25 * (rows**2).sum(1).mean() + 0.25 + ridge
        w[-1] = v[-1] = np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3))
        for k in range(toxicity.STEPS):
            g = full.T @ (sigmoid(full @ v) - target) / len(target) + ridge * np.append(v[:-1], 0)
            after = v - g / reach
            v, w = after + k / (k + 3) * (after - w), after
        return w

    best = None
    for ridge in toxicity.RIDGES:
        w = plain(x[of != 0].astype(float), y[of != 0], ridge)
        p = sigmoid(x[of == 0] @ w[:-1] + w[-1])
        loss = -(y[of == 0] * np.log(p) + (1 - y[of == 0]) * np.log(1 - p)).mean()
        best = min(best, (loss, ridge)) if best else (loss, ridge)
    rows = x.astype(float)
    for k in range(3):
        target = y if k == 2 else (kinds == k).astype(int)
        assert np.allclose(chain.weights[k], plain(rows, target, best[1]), atol=2e-3)
        outside = np.zeros(240)
        for f in range(4):
            w = plain(rows[of != f], target[of != f], best[1])
            outside[of == f] = sigmoid(rows[of == f] @ w[:-1] + w[-1])
        rows = np.c_[rows, outside]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r for r in read(spark, sf, "labels").collect()}
    q = [(labels[r.doc_id].quality, r.score, r.predicted) for r in queries.op1_quality_classifier(spark, sf).filter("held_out").collect() if r.doc_id in labels]
    assert np.mean([a == c for a, _, c in q]) > 0.95
    docs = {r.doc_id: r for r in read(spark, sf, "documents").withColumn("f", fold(F.col("doc_id"))).collect()}
    l = queries.op2_language_id(spark, sf).collect()  # noqa: E741
    assert all(r.held_out == (docs[r.doc_id].f == 2) for r in l)
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in l if r.held_out]) > 0.95
    t = [(labels[r.doc_id].toxic, r.toxic) for r in queries.op4_toxicity(spark, sf).collect() if r.doc_id in labels and docs[r.doc_id].f == 2]
    assert np.mean([bool(a) == b for a, b in t]) > 0.9 and not any(b for a, b in t if not a)


def test_labels_and_sources_are_no_inputs(spark, sf):
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    held = fold(F.col("doc_id")) == 2
    other = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    key = lambda df: sorted(map(str, df.collect()))
    assert key(langid.identify(docs, 50)) == key(langid.identify(other, 50))
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert key(quality.classify(docs, labels)) == key(quality.classify(other, turned))


def test_toxicity_query_by_hand(spark, sf):
    """The columns of the query, each text's chain reckoned category by category from its words."""
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    chain = toxicity.train(docs, labels)
    want = {}
    for r in docs.collect():
        there = toxicity.features_of(r.text)
        x, earlier = [float(w in there) for w in chain.words], []
        for w in chain.weights:
            z = float(np.dot([*x, *earlier, 1.0], np.asarray(w, float)))
            earlier.append(1 / (1 + np.exp(-z)))
        want[r.doc_id] = earlier
    got = queries.op4_toxicity(spark, sf).collect()
    assert len(got) == len(want) and len({r.doc_id for r in got}) == len(want)
    for r in got:
        p = want[r.doc_id]
        assert np.allclose([r.p_kind_1, r.p_kind_2, r.p_kind_3, r.score], p, atol=1e-4) and (r.toxic == (p[-1] >= 0.5) or abs(p[-1] - 0.5) < 1e-4)
