"""Quality rules: robust multivariate outliers among statistics of texts.

The minimum covariance determinant is found per group by concentration
steps from several starts: distances, their h-quantile, and the moments of
the rows within it, each an aggregation over all rows. No group is
collected. Statistics are whole multiples of 1/GRID and distances are
ranked on a grid, so that counts and sums are exact: the result depends
neither on how rows are partitioned nor on the order in which they are added.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliograph.llm.common import discard, settle, small_batches

_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_ALL = (*_BASE, "n_lines", "n_upper", "n_marks")
_BLANKS = b"\t\n\x0b\x0c\r "
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_MARKS = b"!?.,;:|=\"'()[]{}#*$%&<>/\\_-+~^@`"
#: Least standard deviation of each component of the vector, in its own unit; most groups have none in some.
FLOORS = (0.12, 0.5, 0.12, 0.1, 0.12, 0.15)
SHARE, STEPS, LEAST_ROWS, TAIL = 0.75, 4, 64, 1e-4
#: Statistics are multiples of 1 / GRID; the cut among distances is at one of LEVELS places in each doubling.
GRID, LEVELS = 1024, 64
#: Rows within this quantile of the steps' result give the final estimate.
REWEIGHTED = 0.975
#: Starts as (quantiles whose mean is the centre, quantiles whose distance over the given factor is the spread).
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)
STARTS = (((2, 2), (1, 3), 1.349), ((1, 3), (0, 4), 3.290))


def statistics(text: str | None) -> tuple[int, ...]:
    """The counts of _ALL for one text."""
    if not text:
        return (0,) * len(_ALL)
    b = text.encode("utf-8", "surrogatepass")
    w = b.split()
    n = len(w)
    chars = len(text) - (len(b) - len(b.translate(None, _BLANKS)))
    lines = [x for x in b.split(b"\n") if x.strip(_BLANKS)]
    seen = Counter(zip(w, w[1:], w[2:]))
    repeated = 0
    if len(seen) < n - 2:
        end = 0
        for i, x in enumerate(zip(w, w[1:], w[2:])):
            if seen[x] > 1:
                repeated += i + 3 - max(i, end)
                end = i + 3
    dropped = lambda of: len(b) - len(b.translate(None, of))
    return n, chars, dropped(_SYMBOLS), len(lines) - len(set(lines)), repeated, len(lines), dropped(_UPPER), dropped(_MARKS)


def _statistics_udf() -> Column:
    @F.pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in _ALL]))
    def stats(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([statistics(t) for t in texts], columns=list(_ALL))

    return stats


def _vector(s: Column) -> list[Column]:
    """Mean word length, symbols, repeated lines, repeated words, capitals and marks, as logarithms or shares, in multiples of 1 / GRID."""
    per = lambda a, b: s[a].cast("double") / F.greatest(s[b], F.lit(1))
    exact = [
        F.log(F.greatest(per("word_chars", "n_words"), F.lit(0.5))),
        F.log1p(100 * per("n_symbols", "word_chars")),
        per("n_dup_lines", "n_lines"),
        per("n_repeat_words", "n_words"),
        per("n_upper", "word_chars"),
        F.log1p(10 * per("n_marks", "word_chars")),
    ]
    return [F.floor(x * GRID + 0.5).cast("bigint") for x in exact]


def chi2_cdf(x: float, k: float) -> float:
    """By the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, h = k / 2, x / 2
    term = total = 1 / a
    i = a
    while term > total * 1e-16:
        i += 1
        term *= h / i
        total += term
    return total * math.exp(-h + a * math.log(h) - math.lgamma(a))


def chi2_quantile(p: float, k: float) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return high


def _models(batches: Iterator[pd.DataFrame], p: int, floors: tuple[float, ...], share: float) -> Iterator[pd.DataFrame]:
    """Location, precision matrix and its determinant's logarithm from the sums of a group's selected rows."""
    at = np.triu_indices(p)
    scale = share / chi2_cdf(chi2_quantile(share, p), p + 2)
    for b in batches:
        out = []
        for key, start, n, s, q in zip(b["key"], b["start"], b["n"], b["sums"], b["products"]):
            loc = np.asarray(s, float) / n / GRID
            cov = np.zeros((p, p))
            cov[at] = np.asarray(q, float) / n / GRID**2 - np.outer(loc, loc)[at]
            cov = (cov + np.triu(cov, 1).T) * scale
            d = np.diag(cov)
            grown = np.maximum(d, np.square(floors))
            cov = cov + np.diag(grown - d)
            out.append((key, start, loc.tolist(), np.linalg.pinv(cov, hermitian=True).ravel().tolist(), float(np.linalg.slogdet(cov)[1])))
        yield pd.DataFrame(out, columns=["key", "start", "loc", "precision", "spread"])


_MODEL = "key string, start int, loc array<double>, precision array<double>, spread double"


def _distance(v: list[Column], loc: Column, precision: Column) -> Column:
    p = len(v)
    d = [x / float(GRID) - loc[i] for i, x in enumerate(v)]
    return reduce(lambda a, b: a + b, [d[i] * d[j] * precision[i * p + j] * (1 if i == j else 2) for i in range(p) for j in range(i, p)])


def _moments(rows: DataFrame, v: list[str]) -> DataFrame:
    p = len(v)
    return rows.groupBy("key", "start").agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(v[i]) for i in range(p)]).alias("sums"),
        F.array(*[F.sum(F.col(v[i]) * F.col(v[j])) for i in range(p) for j in range(i, p)]).alias("products"),
    )


def _starts(rows: DataFrame, v: list[str], floors: tuple[float, ...]) -> DataFrame:
    """Centres and diagonal precisions from quantiles, which are exact: each statistic has as many values as the grid allows, however many rows there are."""
    q = rows.groupBy("key").agg(*[F.percentile(x, list(QUANTILES)).alias(x) for x in v])
    p, made = len(v), []
    for k, ((a, b), (lo, hi), factor) in enumerate(STARTS):
        loc = [(F.col(x)[a] + F.col(x)[b]) / (2.0 * GRID) for x in v]
        spread = [F.greatest((F.col(x)[hi] - F.col(x)[lo]) / (factor * GRID), F.lit(f)) for x, f in zip(v, floors)]
        precision = [1 / (spread[i] * spread[i]) if i == j else F.lit(0.0) for i in range(p) for j in range(p)]
        made.append(F.struct(F.lit(k).alias("start"), F.array(*loc).alias("loc"), F.array(*precision).alias("precision"), F.lit(0.0).alias("spread")))
    return q.select("key", F.explode(F.array(*made)).alias("m")).select("key", "m.*")


def fit(rows: DataFrame, v: list[str], floors: tuple[float, ...] = FLOORS, share: float = SHARE, steps: int = STEPS) -> DataFrame:
    """key, loc, precision of the MCD of each key's rows. ``rows`` has key and the columns ``v`` in multiples of 1 / GRID, and is read several times.

    Of the starts, the one whose steps end in the least determinant counts, of equal ones the first.
    """
    p = len(v)
    of = partial(_models, p=p, floors=floors)
    model = settle(_starts(rows, v, floors), "start")
    for _ in range(steps):  # a concentration step: the share of rows nearest to the centre
        near = rows.join(model.drop("spread"), "key").select("key", "start", *v, _distance([F.col(x) for x in v], F.col("loc"), F.col("precision")).alias("d2"))
        near = near.withColumn("level", F.ceil(F.log2(F.col("d2") + 2.0**-20) * LEVELS))
        counts = near.groupBy("key", "start", "level").agg(F.count("*").alias("n"))
        one = W.partitionBy("key", "start")
        counts = counts.withColumns({"below": F.sum("n").over(one.orderBy("level")), "all": F.sum("n").over(one)})
        cut = counts.filter(F.col("below") >= F.ceil(share * F.col("all"))).groupBy("key", "start").agg(F.min("level").alias("cut"))
        inside = near.join(cut, ["key", "start"]).filter("level <= cut")
        old, model = model, settle(_moments(inside, v).mapInPandas(partial(of, share=share), _MODEL), "model")
        discard(old)
    best = model.groupBy("key").agg(F.min_by(F.struct("loc", "precision"), F.struct("spread", "start")).alias("m")).select("key", "m.*")
    near = rows.join(best, "key").withColumn("start", F.lit(0)).filter(_distance([F.col(x) for x in v], F.col("loc"), F.col("precision")) <= chi2_quantile(REWEIGHTED, p))
    found = settle(_moments(near, v).mapInPandas(partial(of, share=REWEIGHTED), _MODEL).select("key", "loc", "precision"), "model")
    discard(model)
    return found


def _keys(sizes: DataFrame, least: int) -> DataFrame:
    """lang, source, key and feeds: the model that judges the group, and those that learn from it.

    A group with enough rows has a model of its own. A smaller one is judged
    by that of all rows of its language, or if those are too few, of all rows.
    """
    lang = sizes.groupBy(F.col("lang").alias("of_lang")).agg(F.sum("n").alias("in_lang"), F.min("n").alias("smallest"))
    every = lang.agg(F.coalesce(F.sum("in_lang"), F.lit(0)).alias("n"), F.min("in_lang").alias("smallest")).first()
    named = lambda level, *cols: F.to_json(F.struct(F.lit(level).alias("level"), *cols))
    group, own_lang = F.col("n") >= least, F.col("in_lang") >= least
    for_all = F.when(F.lit(every.n >= least), named("all"))
    key = F.when(group, named("group", "lang", "source")).when(own_lang, named("lang", "lang")).otherwise(for_all)
    feeds = [F.when(group, named("group", "lang", "source")), F.when(own_lang & (F.col("smallest") < least), named("lang", "lang")), for_all if every.n and every.smallest < least else F.lit(None).cast("string")]
    tagged = sizes.join(lang, F.col("lang").eqNullSafe(F.col("of_lang")))
    return tagged.select("lang", "source", key.alias("key"), F.array_compact(F.array(*feeds)).alias("feeds"))


def _with_keys(rows: DataFrame, keys: DataFrame, *wanted: str) -> DataFrame:
    """rows with the wanted columns of their group. Only a column lang, a column source and names without clashes are asked of rows."""
    k = keys.select(F.col("lang").alias("k_lang"), F.col("source").alias("k_source"), *wanted)
    return rows.join(k, F.col("lang").eqNullSafe(F.col("k_lang")) & F.col("source").eqNullSafe(F.col("k_source"))).drop("k_lang", "k_source")


def _counted(docs: DataFrame, *carried: Column) -> DataFrame:
    """lang, source, s (the counts), failed (the fixed rules) and what is carried along."""
    failed = (F.col("s.n_words") < 50) | (100 * F.col("s.n_repeat_words") > 50 * F.col("s.n_words"))
    rows = small_batches(docs).select(F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), _statistics_udf()(F.col("text").cast("string")).alias("s"), *carried)
    return rows.withColumn("failed", failed)


def _fitted(counted: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(keys, models) from rows with lang, source, s and failed; read several times."""
    v = [f"v{i}" for i in range(len(FLOORS))]
    passed = counted.filter(~F.col("failed"))
    keys = settle(_keys(counted.groupBy("lang", "source").agg(F.count_if(~F.col("failed")).alias("n")), least), "keys")
    rows = _with_keys(passed.select("lang", "source", *[c.alias(n) for n, c in zip(v, _vector(F.col("s")))]), keys, "feeds")
    rows = settle(rows.select(F.explode("feeds").alias("key"), *v), "vectors")
    models = fit(rows, v)
    discard(rows)
    return keys, models


def _judged(counted: DataFrame, keys: DataFrame, models: DataFrame, tail: float) -> DataFrame:
    """counted with d2 (null without a model) and kept."""
    found = _with_keys(counted, keys, "key").join(models, "key", "left").withColumn("d2", _distance(_vector(F.col("s")), F.col("loc"), F.col("precision")))
    kept = ~F.col("failed") & (F.coalesce("d2", F.lit(0.0)) <= chi2_quantile(1 - tail, len(FLOORS)))
    return found.withColumn("kept", kept)


def judge(docs: DataFrame, least: int = LEAST_ROWS, tail: float = TAIL) -> DataFrame:
    """doc_id, the counts, base_failed, kept and distance of every row of ``docs(doc_id, text, lang, source)``.

    A null or blank text has no words and fails; a very long one is read
    whole. Languages and sources that are null form groups like any other. A
    group of fewer than ``least`` rows that pass the fixed rules is judged by
    the model of all rows of its language, or where those are fewer, of all
    rows; where even those are fewer, the fixed rules decide alone and
    distance is null. Rows at the cut are within it. Repeated rows each give
    a row; other columns are ignored; an empty table gives no rows.
    """
    counted = settle(_counted(docs, F.col("doc_id")), "statistics")
    keys, models = _fitted(counted, least)
    return _judged(counted, keys, models, tail).select("doc_id", *[F.col(f"s.{c}").alias(c) for c in _BASE], F.col("failed").alias("base_failed"), "kept", F.sqrt("d2").alias("distance"))


def keep_good(docs: DataFrame, least: int = LEAST_ROWS, tail: float = TAIL) -> DataFrame:
    """The rows of ``docs`` that judge() keeps, with all their columns."""
    keys, models = _fitted(settle(_counted(docs), "statistics"), least)
    return _judged(_counted(docs, F.struct("*").alias("row")), keys, models, tail).filter("kept").select("row.*")
