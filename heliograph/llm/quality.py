"""Quality classifier: votes of the nearest labelled documents in a latent-semantic space.

A text becomes weighted term counts, projected onto the leading singular
vectors of a labelled sample. The labelled vectors are broadcast; every
document is compared with all of them, block by block, and its most similar
neighbours vote with their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliograph.llm.common import discard, fold, settle, small_batches, text_of

#: At most so many labelled texts of each label are learned from; so the broadcast is SAMPLE * 2 vectors of DIMENSIONS numbers and a projection of TERMS by DIMENSIONS.
SAMPLE, DIMENSIONS, NEIGHBOURS = 1500, 48, 25
#: Terms that fewer of the labelled texts hold have no place in the projection.
LEAST_TEXTS = 2
THRESHOLD = 0.7

#: Character classes: 0 blank, 1 line end, 2 lower case, 3 upper case, 4 digit, 5 beyond ASCII, 6-15 signs by kind.
_CLASS = np.full(256, 15, np.uint16)
for _c, _of in enumerate((b" \t\x0b\x0c\r", b"\n", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", bytes(range(128, 256)), b".", b",", b"!?", b"|", b"#*", b"$%&", b"<>", b"=:;_/\\@", b"'\"()[]{}")):
    _CLASS[list(_of)] = _c
_GRAMS, _SHAPES = 16**3, 24
TERMS = _GRAMS + 3 * _SHAPES


def term_counts(text: str) -> np.ndarray:
    """Counts of the terms of a text: triples of character classes, and graded shares of repeated words and lines and of distinct words."""
    b = text.encode("utf-8", "surrogatepass")
    out = np.zeros(TERMS, np.float32)
    if not b.strip():
        return out
    c = _CLASS[np.frombuffer(b, np.uint8)]
    if len(c) > 2:
        out[:_GRAMS] = np.bincount((c[:-2] << 8) | (c[1:-1] << 4) | c[2:], minlength=_GRAMS)
    w = b.split()
    lines = [x for x in b.split(b"\n") if x.strip()]
    shares = (
        sum(map(bytes.__eq__, w, w[1:])) / len(w),
        1 - len(set(w)) / len(w) if len(w) > 20 else 0,
        1 - len(set(lines)) / len(lines),
    )
    weight = 0.5 * len(c)
    for k, s in enumerate(shares):  # a share is a term up to each grade that it reaches
        grade = int(s * (_SHAPES - 1) + 0.5)
        out[_GRAMS + k * _SHAPES : _GRAMS + k * _SHAPES + grade] = weight / _SHAPES
    return out


@dataclass
class Neighbours:
    """What is broadcast: term weights, projection, labelled vectors and labels, and the share of label 1."""

    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def embed(self, counts: np.ndarray) -> np.ndarray:
        return _unit(_weigh(counts, self.idf) @ self.projection)

    def scores(self, texts: list[str], block: int = 256) -> np.ndarray:
        """The similarity-weighted vote, label 0 and 1 weighing as in the corpus; the share of label 1 for a text without terms."""
        out = np.empty(len(texts))
        k = min(NEIGHBOURS, len(self.labels))
        share = self.labels.mean()
        per_label = np.where(self.labels == 1, self.prior / max(share, 1e-9), (1 - self.prior) / max(1 - share, 1e-9))
        for i in range(0, len(texts), block):
            v = self.embed(np.stack([term_counts(t) for t in texts[i : i + block]]))
            sim = v @ self.vectors.T
            near = np.argpartition(-sim, k - 1, axis=1)[:, :k]
            s = np.maximum(np.take_along_axis(sim, near, 1).astype(float), 0) * per_label[near]
            total = s.sum(1)
            out[i : i + block] = np.divide((s * self.labels[near]).sum(1), total, out=np.full(len(v), self.prior), where=total > 0)
        return np.clip(out, 0.0, 1.0)


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, n, out=np.zeros_like(x), where=n > 1e-6)


def _weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = counts / np.maximum(counts.sum(1, keepdims=True), 1)
    np.sqrt(x, out=x)
    x *= idf
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, n, out=x, where=n > 0)


def pack(counts: np.ndarray) -> bytes:
    """The places and values of the counts that aren't 0: a few kB a text however long it is, 6 bytes a term at most."""
    at = np.flatnonzero(counts)
    return at.astype(np.uint16).tobytes() + counts[at].astype(np.float32).tobytes()


def unpack(packs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(terms, counts): the terms that LEAST_TEXTS of the packed texts hold, and a row per text with their counts."""
    places = [np.frombuffer(p, np.uint16, len(p) // 6) for p in packs]
    df = np.bincount(np.concatenate(places).astype(np.int64), minlength=TERMS) if packs else np.zeros(TERMS, np.int64)
    terms = np.flatnonzero(df >= min(LEAST_TEXTS, max(1, len(packs))))
    column = np.full(TERMS, -1)
    column[terms] = np.arange(len(terms))
    counts = np.zeros((len(packs), len(terms)), np.float32)
    for i, (p, at) in enumerate(zip(packs, places)):
        to = column[at]
        counts[i, to[to >= 0]] = np.frombuffer(p, np.float32, len(at), 2 * len(at))[to >= 0]
    return terms, counts


def learn(packs: list[bytes], labels: np.ndarray, prior: float, dimensions: int = DIMENSIONS, seed: int = 3) -> Neighbours:
    """The model of packed term counts with their labels; ``prior`` is the share of label 1."""
    terms, x = unpack(packs)
    weights = (np.log((1 + len(packs)) / (1 + (x > 0).sum(0))) + 1).astype(np.float32)
    x = _weigh(x, weights)
    # Randomised subspace iteration for the leading right singular vectors.
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(x.T @ rng.normal(size=(len(packs), min(dimensions + 12, len(packs)))).astype(np.float32))[0]
    for _ in range(6):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    idf, projection = np.zeros(TERMS, np.float32), np.zeros((TERMS, min(dimensions, vt.shape[0])), np.float32)
    idf[terms], projection[terms] = weights, (q @ vt.T)[:, :dimensions]
    vectors = _unit(x @ projection[terms])
    return Neighbours(idf, projection, vectors, labels.astype(np.float32), prior)


def _pack_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame({"doc_id": b["doc_id"], "quality": b["quality"], "terms": [pack(term_counts(t)) for t in b["text"]]})


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Neighbours | None:
    """From rows of ``docs(doc_id, text)`` whose fold isn't 2, labelled by ``labels(doc_id, quality)``; None without any.

    Of each label the ``sample`` ids with the lowest hash are used. An id
    with several labels counts by the highest; other labels than 0 and 1
    and ids that are null are left out.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 2))
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("quality").cast("int").alias("quality"))
    sizes = {r.quality: r.n for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    order = F.md5(F.col("doc_id").cast("string")), "doc_id"
    first = lambda rows, n: reduce(DataFrame.unionByName, [rows.filter(F.col("quality") == x).orderBy(*order).limit(n) for x in sorted(sizes)])
    # At most 4 * sample ids, so the broadcast is bounded. Some of them may have no text.
    few = small_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("text is not null").join(F.broadcast(first(known, 2 * sample)), "doc_id")
    few = few.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    # Texts stay with the executors; the driver gets at most sample packs of counts of each label.
    packs = settle(few.mapInPandas(_pack_batches, "doc_id long, quality int, terms binary"), "terms")
    rows = [(r.quality, bytes(r.terms)) for r in first(packs, sample).collect()]
    discard(packs)
    return learn([t for _, t in rows], np.array([y for y, _ in rows]), sizes.get(1, 0) / sum(sizes.values())) if rows else None


def score_udf(docs: DataFrame, model: Neighbours | None) -> Column:
    """A column from ``text``: the score, 0.5 for every text if there is no model."""
    if model is None:
        return F.lit(0.5)
    shared = small_batches(docs).sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores([t or "" for t in texts]))

    return score(text_of(F.col("text")))


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs(doc_id, text)``.

    Null and blank texts, and those that no labelled text resembles, get the
    share of label 1 among the labels; without labels every score is 0.5. A
    very long text is read whole. Of neighbours that tie for the last place,
    any may vote, the same in every run over the same labels. A null doc_id
    counts as the empty text in the fold. Repeated rows each give a row;
    other columns are ignored; an empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    score = score_udf(docs, train(docs, labels, sample))
    rows = docs.select("doc_id", (fold(F.col("doc_id")) == 2).alias("held_out"), score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labelled: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, that a model of ``labelled(doc_id, text)`` predicts 1 for."""
    return docs.filter(score_udf(docs, train(labelled, labels, sample)) >= threshold)
