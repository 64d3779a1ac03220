"""Toxicity by a classifier chain of linear models over the words and stems that a text holds.

Categories are predicted one after the other. The model of a category sees
the words and the probabilities of all categories before it; in training
these are out-of-fold predictions, so that a later model learns from errors
like those that it will meet. The labels say only whether a text is toxic,
so the kinds of toxicity that come before it in the chain are learned:
clusters of the toxic training texts by the words that set them apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliograph.llm.common import discard, fold, settle, small_batches, text_of
from heliograph.llm.decontam import words_of

#: So many kinds of toxicity come before the last category in the chain.
KINDS = 3
LAST = "toxic"
#: So many labelled texts of each label are learned from at most; so many words are features; so many folds.
SAMPLE, FEATURES, FOLDS = 3000, 800, 5
#: Lengths in bytes of the beginnings of words.
STEMS = (4, 5, 6)
#: A feature is in so many texts at least. The ridge is the one of these that predicts a fold of the training texts best.
LEAST_TEXTS, RIDGES, STEPS = 4, (1e-4, 3e-4, 1e-3, 3e-3), 300


def features_of(text: str | None) -> set[bytes]:
    """The words of a text, and the beginnings of its longer words, marked: inflected and compound forms share them."""
    words = set(words_of(text))
    return words.union(*({b"^" + w[:k] for w in words if len(w) > k} for k in STEMS))


@dataclass
class Chain:
    names: list[str]
    words: dict[bytes, int]
    weights: list[np.ndarray] = field(default_factory=list)

    def presence(self, text: str | None) -> np.ndarray:
        return np.fromiter((self.words[w] for w in self.words.keys() & features_of(text)), np.int64)

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        """A row per text, a column per category."""
        at = [self.presence(t) for t in texts]
        p, rows = np.zeros((len(texts), len(self.names))), np.repeat(np.arange(len(texts)), [len(a) for a in at])
        flat = np.concatenate(at) if at else np.zeros(0, np.int64)
        n = len(self.words)
        for k, w in enumerate(self.weights):
            z = np.bincount(rows, w[flat], minlength=len(texts)) + p[:, :k] @ w[n : n + k] + w[-1]
            p[:, k] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return p


def fit_linear(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = STEPS) -> np.ndarray:
    """Weights of a logistic regression with a bias last, by accelerated gradient steps."""
    w = np.zeros(x.shape[1] + 1, np.float32)
    v = w.copy()
    reach = 0.25 * float(np.square(x).sum(1).mean() + 1) + ridge
    w[-1] = v[-1] = np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))
    for k in range(steps):
        error = predict(x, v) - y
        g = np.append(x.T @ error, error.sum()) / len(y) + ridge * np.append(v[:-1], 0)
        after = v - g.astype(np.float32) / reach
        v = after + (k / (k + 3)) * (after - w)
        w = after
    return w


def predict(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


def kinds_of(x: np.ndarray, y: np.ndarray, kinds: int = KINDS) -> np.ndarray:
    """The kind, 0 to kinds - 1, of each row with y = 1, and -1 for the others: clusters by direction.

    A feature weighs by how much more of the rows with y = 1 have it. The
    first centre is the mean of all, each further one the row farthest from
    those before; then means and nearest centres alternate. Kinds are
    numbered by falling size.
    """
    share, other = (x[y == 1].sum(0) + 0.5) / (y.sum() + 1), (x[y == 0].sum(0) + 0.5) / (len(y) - y.sum() + 1)
    rows = x[y == 1] * np.maximum(np.log(share / other), 0)
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=-1, keepdims=True), 1e-9)
    rows = unit(rows)
    centres = unit(rows.mean(0))[None]
    while len(centres) < kinds:
        centres = np.concatenate([centres, rows[[(rows @ centres.T).max(1).argmin()]]])
    for _ in range(20):
        own = (rows @ centres.T).argmax(1)
        centres = unit(np.stack([rows[own == k].mean(0) if (own == k).any() else centres[k] for k in range(kinds)]))
    order = np.argsort(-np.bincount(own, minlength=kinds), kind="stable")
    found = np.full(len(y), -1)
    found[y == 1] = np.argsort(order)[own]
    return found


def learn(words: list[bytes], x: np.ndarray, toxic: np.ndarray, kinds: int = KINDS, folds: int = FOLDS, seed: int = 11) -> Chain:
    """The chain from a row per text, a column per word, and the labels."""
    y = toxic.astype(np.float32)
    n = len(y)
    x = np.concatenate([x.astype(np.float32), np.zeros((n, kinds), np.float32)], 1)
    fold_of = np.random.default_rng(seed).permutation(n) % folds
    of = kinds_of(x[:, : len(words)], y, kinds)
    chain = Chain([*(f"kind_{k + 1}" for k in range(kinds)), LAST], {w: i for i, w in enumerate(words)})

    def loss(ridge: float) -> float:
        inside = fold_of != 0
        p = np.clip(predict(x[~inside, : len(words)], fit_linear(x[inside, : len(words)], y[inside], ridge)), 1e-6, 1 - 1e-6)
        return float(-(y[~inside] * np.log(p) + (1 - y[~inside]) * np.log(1 - p)).mean())

    ridge = min(RIDGES, key=loss) if 0 < (fold_of != 0).sum() < n else RIDGES[0]
    for k, name in enumerate(chain.names):
        width, target = len(words) + k, y if name == LAST else (of == k).astype(np.float32)
        if name != LAST:
            for f in range(folds):
                inside = fold_of != f
                if inside.any() and (~inside).any():
                    x[~inside, width] = predict(x[~inside, :width], fit_linear(x[inside, :width], target[inside], ridge))
        chain.weights.append(fit_linear(x[:, :width], target, ridge))
    return chain


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        sets = [list(features_of(t)) for t in b["text"]]
        yield pd.DataFrame({"doc_id": b["doc_id"], "toxic": b["toxic"], "features": sets})


def sample_features(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES) -> tuple[list[bytes], np.ndarray, np.ndarray] | None:
    """(words, presence, labels) of the labelled texts of ``docs`` whose fold isn't 2; None unless both labels occur.

    Of each label the ``sample`` ids with the lowest hash are used, and of
    equal texts one. An id with several labels counts as toxic if one is,
    one with several texts by all their words. Texts stay with the
    executors: the driver gets at most ``features`` words, and a bit for
    each word and text.
    """
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 2)).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    order = F.md5(F.col("doc_id").cast("string")), "doc_id"
    first = lambda rows, n: reduce(DataFrame.unionByName, [rows.filter(F.col("toxic") == x).orderBy(*order).limit(n) for x in (0, 1)])
    few = small_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("text is not null").join(F.broadcast(first(known, 2 * sample)), "doc_id")
    few = few.groupBy(F.xxhash64("text").alias("key"), "text").agg(F.max("toxic").alias("toxic"), F.min("doc_id").alias("doc_id"))
    rows = settle(few.mapInPandas(_features, "doc_id long, toxic int, features array<binary>"), "features")
    ids = settle(first(rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), sample), "ids")
    n, n1 = ids.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < n1 < n:
        return None
    held = settle(rows.select("doc_id", F.explode("features").alias("feature")).join(F.broadcast(ids), "doc_id").distinct(), "held")
    # Words by how surely their share differs between labels.
    a, b = F.col("bad") + 0.5, F.col("n") - F.col("bad") + 0.5
    odds = F.log(a / (n1 + 1.5 - a)) - F.log(b / (n - n1 + 1.5 - b))
    counts = held.groupBy("feature").agg(F.count("*").alias("n"), F.sum("toxic").alias("bad")).filter(F.col("n") >= LEAST_TEXTS)
    words = [bytes(r.feature) for r in counts.orderBy((F.abs(odds) / F.sqrt(1 / a + 1 / b)).desc(), "feature").limit(features).collect()]
    spark = docs.sparkSession
    place = F.broadcast(spark.createDataFrame([(bytearray(w), i) for i, w in enumerate(words)], "feature binary, place int"))
    per = ids.join(held.join(place, "feature").groupBy("doc_id").agg(F.collect_list("place").alias("places")), "doc_id", "left")
    found = sorted((r.doc_id, r.toxic, r.places or []) for r in per.collect())
    discard(rows, ids, held)
    x = np.zeros((len(found), len(words)), np.uint8)
    for i, (_, _, places) in enumerate(found):
        x[i, places] = 1
    return words, x, np.array([t for _, t, _ in found])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain | None:
    """The chain that sample_features() of ``docs(doc_id, text)`` and ``labels(doc_id, toxic)`` give; None unless both labels occur."""
    found = sample_features(docs, labels, sample)
    return learn(*found) if found else None


def chain_udf(docs: DataFrame, chain: Chain) -> Column:
    """A column from ``text``: a struct of each category's probability."""
    shared = small_batches(docs).sparkSession.sparkContext.broadcast(chain)

    @F.pandas_udf(T.StructType([T.StructField(c, T.DoubleType()) for c in chain.names]))
    def categories(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(shared.value.probabilities(texts.tolist()), columns=shared.value.names)

    return categories(text_of(F.col("text")))


def score_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = 0.5) -> DataFrame:
    """doc_id, a probability for each category, score (that of the last) and toxic of every row of ``docs(doc_id, text)``.

    Whole texts are read, however long. A null or wordless text gets what
    the biases alone give. If the labels don't hold both values, all
    probabilities are 0. A score at the threshold is toxic; features that
    tie for the last place go by their bytes. Repeated rows each give a row;
    other columns are ignored; an empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    chain = train(docs, labels, sample)
    kinds = [f"kind_{k + 1}" for k in range(KINDS)]
    found = chain_udf(docs, chain) if chain else F.struct(*[F.lit(0.0).alias(c) for c in (*kinds, LAST)])
    rows = docs.select("doc_id", found.alias("p"))
    return rows.select("doc_id", *[F.col(f"p.{c}").alias(f"p_{c}") for c in kinds], F.col(f"p.{LAST}").alias("score"), (F.col(f"p.{LAST}") >= threshold).alias("toxic"))
