"""Truth tables of the text, date and number expressions."""

import math

import pytest
from pyspark.sql import functions as F

from heliograph.functions import dates, numbers, text
from heliograph.functions.vectors import dot, unit
from heliograph.vocab import NEWS


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ("LietuvÃ¡", "Lietuvá"),
        ("Kaunas Å½algiris", "Kaunas Žalgiris"),
        ("Vilniusâ€™ plan", "Vilnius’ plan"),
        ("Åland ferry", "land ferry"),
        ("â€”dash ąčę Ã¶", "—dash  ö"),
        (None, ""),
        ("", ""),
        ("plain", "plain"),
        ("Žalgiris ąčę", "Žalgiris ąčę"),
    ],
)
def test_mojibake(spark, given, wanted):
    assert one(spark, given, text.repair_mojibake) == wanted


def test_mojibake_like_python(spark):
    import random

    rng = random.Random(4)
    letters = "abÃÅÂâ€™½¡ąčę öäü\u0081\u008dž–€\t"
    rows = ["".join(rng.choice(letters) for _ in range(rng.randrange(12))) for _ in range(300)]
    marked = lambda s: any(m in s for m in text.MOJIBAKE_MARKS)
    wanted = [s.encode("cp1252", "ignore").decode("utf-8", "ignore") if marked(s) else s for s in rows]
    got = [r.y for r in spark.createDataFrame([(i, s) for i, s in enumerate(rows)], "i int, x string").orderBy("i").select(text.repair_mojibake(F.col("x")).alias("y")).collect()]
    assert got == wanted


def test_clean_headline(spark):
    assert one(spark, "  a�b\t\n", text.clean_headline) == "a b"


@pytest.mark.parametrize(
    ("given", "wanted"),
    [("drones", "drone"), ("russian", "russia"), ("series", "sery"), ("crisis", "crisi"), ("lies", "lies"), ("flies", "flie"), ("belarus", "belarus"), ("press", "press"), ("embassies", "embassy")],
)
def test_canonical(spark, given, wanted):
    assert one(spark, given, lambda c: text.canonical(c, NEWS.variants)) == wanted


def test_tokenisers(spark):
    s = "Zaporižžia war covid19 foo_bar"
    assert one(spark, s, text.word_tokens) == ["war"]
    assert one(spark, s, text.letter_runs) == ["zapori", "ia", "war", "covid", "foo", "bar"]
    assert one(spark, "Nõmme", text.letter_runs) == ["mme"]


def test_ngrams(spark):
    f = lambda c: text.ngrams(c)
    assert one(spark, ["a", "b", "c"], f, "array<string>") == ["a", "b", "c", "a b", "b c"]
    assert one(spark, ["a"], f, "array<string>") == ["a"]
    assert one(spark, [], f, "array<string>") == []


def test_slug(spark):
    assert one(spark, "--BAAI/bge large_EN v1.5!", text.slug) == "baai-bge-large-en-v1-5"


def test_stamps(spark):
    assert one(spark, "2026-07-12_21.48.16", dates.local_label) == "12 Jul 23:48"
    assert one(spark, "2026-01-12_21.48.16", dates.local_label) == "12 Jan 22:48"
    assert one(spark, "2026-07-12 at noon", dates.local_label) == "2026-07-12"
    assert str(one(spark, "2026-07-12", dates.week_start)) == "2026-07-06"
    assert str(one(spark, "2026-07-06", dates.week_start)) == "2026-07-06"
    assert one(spark, "12.7.2026", dates.week_start) is None


def test_percent_rounds_to_even(spark):
    rows = [(m, t) for t in range(0, 60) for m in range(t + 1)]
    got = spark.createDataFrame(rows, "m int, t int").select("m", "t", numbers.percent(F.col("m"), F.col("t")).alias("p")).collect()
    assert all(r.p == (round(r.m / r.t * 100, 1) if r.t else 0.0) for r in got)


def test_vectors(spark):
    assert one(spark, [3.0, 4.0], unit, "array<float>") == [0.6, 0.8]
    assert one(spark, [0.0, 0.0], unit, "array<float>") == [0.0, 0.0]
    assert math.isclose(one(spark, [1.0, 2.0], lambda c: dot(c, c), "array<double>"), 5.0)


def test_quantiles_are_exact(spark):
    import numpy as np

    from heliograph.functions.quantiles import quantile

    rng = np.random.default_rng(0)
    for values in ([1.0, 2.0, 3.0, 4.0], [5.0], rng.normal(size=3000).tolist(), [0.0] * 900 + [1.0] * 100, rng.integers(0, 7, 2000).astype(float).tolist()):
        rows = spark.createDataFrame([(v,) for v in [*values, None]], "v double").repartition(4)
        for p in (0.0, 0.5, 0.95, 1.0):
            assert quantile(rows, "v", p, few=50) == pytest.approx(float(np.quantile(values, p)))
    assert quantile(rows.limit(0), "v", 0.5) is None
