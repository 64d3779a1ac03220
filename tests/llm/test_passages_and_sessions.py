"""Fill-in-middle, substring removal and late sessions against plain versions, and on odd rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliograph.llm import fim, sessions, substrings

CLASH = "text_key long, row string, kept string, n long, form string, id string"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def documents(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash", "clash", 2, "clash", "clash") for r in rows], f"doc_id long, text string, {CLASH}").repartition(3)


# Fill-in-middle


def plain_fim(doc_id, text):
    text = text or ""
    d = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(d[8 * k : 8 * k + 8], 16) for k in range(4))
    u = UNIT.findall(text)
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    x, y, z = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(u), "plain", None, None, text
    if h4 % 100 < 80:
        return len(u), "spm", len(x), len(y), f"<S>{z}<P>{x}<M>{y}"
    return len(u), "psm", len(x), len(y), f"<P>{x}<S>{z}<M>{y}"


def test_fim_on_odd_texts(spark):
    rng = random.Random(4)
    odd = [None, "", " ", "\n\t ", "one", " lead", "trail ", "a<P>b", "<S>", "x <M> y", "<P <S <M ends <", "> P> starts <P", " no break  wide ", "\U0001f600 中文 é", "w " * 50_000, "\x0b\x0c\x1c mixed \x85"]
    rows = [(i, t) for i, t in enumerate(odd * 12)] + [(None, "without an id here"), (7, None), (7, None)]
    rows += [(1000 + i, "".join(rng.choice("ab <>PSM\n\té") for _ in range(rng.randrange(60)))) for i in range(200)]
    found = fim.rearrange(documents(spark, rows)).withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in found), key=str)
    assert got == sorted(((i, *plain_fim(i, t), t or "") for i, t in rows), key=str)
    assert {r.form for r in found} == {"plain", "spm", "psm"}
    assert fim.rearrange(documents(spark, rows[:1]).limit(0)).count() == 0


def test_end_offsets_keep_no_units():
    text = "  a bb  ccc\n"
    ends = [m.end() for m in UNIT.finditer(text)]
    assert fim.count_units(text) == len(ends) == 4
    for i in range(5):
        for j in range(i, 5):
            assert fim.end_offsets(text, i, j) == ([0, *ends][i], [0, *ends][j])


# Substrings


def plain_removal(texts, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    n = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {p for i in range(len(w) - window + 1) if n[tuple(w[i : i + window])] > 1 for p in range(i, i + window)}
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def test_anchors_depend_on_the_window_alone():
    rng = np.random.default_rng(1)
    for trial in range(60):
        most = int(rng.integers(1, 5))
        hashed = lambda m: substrings._mix(rng.integers(0, most, m).astype(np.uint64) + np.uint64(7))  # noqa: E731, B023
        common = hashed(60)
        pieces = [np.concatenate([hashed(int(rng.integers(0, 200))), common, hashed(int(rng.integers(0, 200)))]) for _ in range(4)] + [common]
        for rounds in (0, 1, 2, 4, 7):
            name, place = substrings.anchors(pieces, 35, rounds)
            names, places, i = defaultdict(set), defaultdict(list), 0
            for p in pieces:
                for k in range(len(p) - 34):
                    names[p[k : k + 35].tobytes()].add(int(name[i]))
                    places[p[k : k + 35].tobytes()].append(int(place[i]))
                    i += 1
            assert i == len(name)
            assert all(len(x) == 1 for x in names.values())  # one name wherever a window stands
            assert all(len(set(x)) == len(x) for x in places.values())  # at different places


def test_rounds_shorten_and_name_alike():
    rng = np.random.default_rng(2)
    x = substrings._mix(rng.integers(0, 50, 4000).astype(np.uint64))
    name, _ = substrings.anchors([x, x], 35, 4)
    assert (name[: len(name) // 2] == name[len(name) // 2 :]).all() and 10 < len(set(name.tolist())) < len(name) // 8


def found_of(docs, **options):
    return sorted(((r["row"]["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in substrings.repeats(docs, **options).collect()), key=str)


@pytest.mark.parametrize("vocabulary", [1, 2, 40])
def test_removal_matches_brute_force(spark, vocabulary):
    rng = random.Random(vocabulary)
    text = lambda n: [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
    passages = [text(n) for n in (9, 10, 11, 25, 80)]
    texts = []
    for _ in range(60):
        w = text(rng.randrange(25 if vocabulary < 3 else 60))
        for _ in range(rng.randrange(3)):
            w += rng.choice(passages) + text(rng.randrange(4))
        texts.append(rng.choice([" ", "\n", " \t"]).join(w))
    texts += texts[:3] + texts[:1] * 5
    docs = documents(spark, list(enumerate(texts)))
    want = sorted(((i, *x) for i, x in enumerate(plain_removal(texts, 10))), key=str)
    assert found_of(docs, window=10) == want
    assert found_of(docs, window=10, piece=16) == want  # pieces make no difference


def test_removal_on_odd_rows(spark, monkeypatch):
    long = " ".join(f"v{i * i % 7919}" for i in range(30_000))
    same = " ".join(f"s{i}" for i in range(50))
    rows = [(1, same), (1, same), (None, same), (2, None), (3, ""), (4, " \n"), (5, "few words"), (5, "few words"), (6, long), (7, "the " * 9000), (8, " ".join(f"u{i}" for i in range(35))), (9, "head " + same.replace("s49", "end") + " tail")]
    want = sorted(((i, *x) for (i, _), x in zip(rows, plain_removal([t for _, t in rows], 35))), key=str)
    docs = documents(spark, rows)
    assert found_of(docs) == want
    monkeypatch.setattr(substrings, "HOT", 1)  # copies are many only where all rows are copies
    assert found_of(docs) == want
    left = substrings.remove_repeats(docs)
    assert left.columns == docs.columns and sorted(r.text for r in left.collect()) == sorted(k for *_, k in want)
    assert substrings.repeats(docs.limit(0)).count() == 0


# Sessions


def plain_versions(events, gap):
    by_user = defaultdict(list)
    for user, batch, second, value in events:
        if None not in (user, batch, second):
            by_user[user].append((second, batch, value or 0))
    out = []
    for user, rows in by_user.items():
        standing, made = [], []
        for now in sorted({b for _, b, _ in rows}):
            session, all_ = [], []
            for r in sorted(x for x in rows if x[1] <= now):
                if session and r[0] - session[-1][0] > gap:
                    all_.append(session)
                    session = []
                session.append(r)
            for s in [*all_, session]:
                if not any(b == now for _, b, _ in s):
                    continue
                inside = [v for v in standing if s[0][0] <= v[2] and v[3] <= s[-1][0]]
                for v in inside:
                    v[8:10] = now, s[0][0]
                    standing.remove(v)
                made.append([user, now, s[0][0], s[-1][0], len(s), sum(b == now for _, b, _ in s), len(inside), sum(x for *_, x in s), None, None])
                standing.append(made[-1])
        out += made
    return sorted(map(tuple, out), key=str)


def event_rows(spark, events):
    return spark.createDataFrame([(*e, 0, "clash") for e in events], "user long, batch long, second long, value long, n long, block string").repartition(3)


def version_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize(("gap", "span", "range_", "late"), [(240, 1 << 14, 40_000, 3), (240, 512, 9000, 6), (5, 16, 700, 4), (3, 8, 60, 30), (0, 4, 40, 5)])
def test_sessions_match_a_replay(spark, gap, span, range_, late):
    """Small blocks, so that sessions cross many borders of several grids."""
    rng = random.Random(gap * span)
    events = [(rng.choice([0, 0, 0, 1, 2, 2**60]), rng.randrange(late), rng.randrange(-range_ // 2, range_), rng.randrange(1 << 32)) for _ in range(400)]
    want = plain_versions(events, gap)
    got = sessions.versions(event_rows(spark, events), gap, span)
    assert got.columns == ["user", "batch", "start_s", "end_s", "n_events", "n_new", "n_retracted", "h_sum", "retracted_batch", "retracted_start_s"]
    assert version_rows(got) == want
    assert gap == 0 or any(v[6] > 1 for v in want)


def test_sessions_on_odd_rows(spark):
    events = [(1, 0, 10, 5), (1, 0, 10, 5), (1, 0, 250, None), (1, 1, 491, 1), (1, 2, 400, 2), (None, 0, 1, 1), (2, None, 1, 1), (3, 0, None, 1), (4, 5, -100, 7), (4, 4, 140, 1), (4, 6, 141, 1)]
    got = sessions.versions(event_rows(spark, events))
    assert version_rows(got) == plain_versions(events, 240)
    assert version_rows(sessions.versions(event_rows(spark, events).limit(0))) == []
    assert [(r.user, r.start_s, r.end_s) for r in sessions.standing(got).orderBy("user").collect()] == [(1, 10, 491), (4, -100, 141)]
    assert sorted((r.user, r.start_s, r.end_s) for r in sessions.standing(got, 1).collect()) == [(1, 10, 250), (1, 491, 491)]


def test_one_user_is_no_one_task(spark):
    """Of one user's dense events, no block holds more than its stretch of time."""
    events = [(1, t // 1800, t, 1) for t in range(0, 200_000, 100)]
    got = sessions.versions(event_rows(spark, events))
    assert version_rows(got) == plain_versions(events, 240)


def test_resolve_takes_extents():
    """Extents that cover each other, as blocks hand them on."""
    rows = sessions.resolve([0, 1, 0, 2], [0, 0, 50, 90], [10, 60, 55, 95], [2, 3, 1, 1], [1, 2, 4, 8], 5)
    assert [v[:10] for v in rows] == [[0, 0, 10, 2, 2, 0, 1, 1, 1, 0], [0, 50, 55, 1, 1, 0, 4, 4, 1, 0], [1, 0, 60, 6, 3, 2, 7, 2, None, None], [2, 90, 95, 1, 1, 0, 8, 8, None, None]]
