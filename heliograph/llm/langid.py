"""Language identification by a byte convolutional network, trained in numpy.

Bytes are embedded; filters of several widths run over fixed-length windows,
the maximum of each filter over a window goes to a softmax. A text's
language is the one with the highest mean log-probability over all its
windows, each weighted by the bytes it covers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliograph.llm.common import discard, fold, settle, small_batches, text_of

WINDOW, WIDTHS, FILTERS, EMBEDDING = 256, (2, 3, 4), 16, 8
#: Per language at most so many labelled texts are trained on, with so many windows of each.
TEXTS, WINDOWS_PER_TEXT, EPOCHS, BATCH = 400, 4, 12, 64
#: Of all languages together at most so many texts, but LEAST_TEXTS of each, whatever the number of languages.
ALL_TEXTS, LEAST_TEXTS = 20_000, 8
#: The sizes of the languages are broadcast while they are no more than this.
BROADCAST_LANGUAGES = 50_000
UNDETERMINED = "und"
_SPAN = max(WIDTHS)


def windows_of(data: bytes, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(windows of byte values, bytes in each). The last is filled up with zeros."""
    n = max(1, -(-len(data) // window))
    x = np.zeros(n * window, np.uint8)
    x[: len(data)] = np.frombuffer(data, np.uint8)
    sizes = np.full(n, window)
    sizes[-1] = len(data) - (n - 1) * window
    return x.reshape(n, window), sizes


def _patches(e: np.ndarray) -> np.ndarray:
    """(n, window, span * embedding): what the filters see at each place; zeros beyond the end."""
    n, t, d = e.shape
    padded = np.zeros((n, t + _SPAN - 1, d), np.float32)
    padded[:, :t] = e
    view = np.lib.stride_tricks.as_strided(padded, (n, t, _SPAN * d), padded.strides[:2] + padded.strides[2:])
    return np.ascontiguousarray(view)


class ByteNet:
    """The network. Parameters: E (256, d), W (span * d, filters of all widths), b, V (filters, languages), c."""

    def __init__(self, languages: list[str], seed: int = 5):
        rng = np.random.default_rng(seed)
        d, f = EMBEDDING, FILTERS * len(WIDTHS)
        self.languages = languages
        # Filters narrower than the span see zeros beyond their width.
        self.mask = np.concatenate([np.repeat((np.arange(_SPAN) < w).astype(np.float32), d)[:, None].repeat(FILTERS, 1) for w in WIDTHS], 1)
        self.p = {
            "E": rng.normal(0, 0.5, (256, d)).astype(np.float32),
            "W": (rng.normal(0, 0.35, (_SPAN * d, f)) * self.mask).astype(np.float32),
            "b": np.zeros(f, np.float32),
            "V": rng.normal(0, 0.2, (f, len(languages))).astype(np.float32),
            "c": np.zeros(len(languages), np.float32),
        }
        self.p["E"][0] = 0

    def log_probabilities(self, x: np.ndarray, keep: bool = False):
        p = self.p
        patches = _patches(p["E"][x])
        maps = patches.reshape(-1, patches.shape[2]) @ p["W"]
        maps = maps.reshape(len(x), x.shape[1], -1)
        top = maps.max(axis=1)
        pooled = np.maximum(top + p["b"], 0)  # the same as the maximum of rectified maps
        z = pooled @ p["V"] + p["c"]
        z -= z.max(1, keepdims=True)
        logs = z - np.log(np.exp(z).sum(1, keepdims=True))
        return (logs, pooled, maps.argmax(axis=1), patches) if keep else logs

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01, seed: int = 6) -> None:
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, d = 0, EMBEDDING
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), BATCH):
                at = order[i : i + BATCH]
                xb, yb = x[at], y[at]
                logs, pooled, where, patches = self.log_probabilities(xb, keep=True)
                dz = np.exp(logs)
                dz[np.arange(len(at)), yb] -= 1
                dz /= len(at)
                dp = (dz @ self.p["V"].T) * (pooled > 0)
                seen = np.take_along_axis(patches, where[:, :, None], axis=1)  # (n, filters, span * d)
                dw = np.einsum("nf,nfk->kf", dp, seen) * self.mask
                dseen = dp[:, :, None] * self.p["W"].T[None]
                de = np.zeros_like(self.p["E"])
                for s in range(_SPAN):
                    place = where + s
                    inside = place < x.shape[1]
                    byte = np.where(inside, np.take_along_axis(xb, np.minimum(place, x.shape[1] - 1), 1), 0)
                    np.add.at(de, byte, dseen[:, :, s * d : (s + 1) * d] * inside[:, :, None])
                de[0] = 0
                grads = {"E": de, "W": dw, "b": dp.sum(0), "V": pooled.T @ dz, "c": dz.sum(0)}
                step += 1
                now = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
                for k, g in grads.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v2[k] = 0.999 * v2[k] + 0.001 * g * g
                    self.p[k] -= (now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)

    def predict(self, data: bytes, chunk: int = 128) -> tuple[str, float]:
        """Language and its probability from all windows of a text, in chunks of bounded size."""
        total = np.zeros(len(self.languages))
        for i in range(0, max(1, len(data)), chunk * WINDOW):
            x, sizes = windows_of(data[i : i + chunk * WINDOW])
            total += sizes @ self.log_probabilities(x).astype(float)
        z = total / max(1, len(data))
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.languages[best], float(p[best])

    def predict_many(self, texts: list[bytes], chunk: int = 128) -> list[tuple[str, float]]:
        """predict() of many texts, whose windows share the batches."""
        xs, sizes, owner = [], [], []
        out: list = [None] * len(texts)
        for i, t in enumerate(texts):
            if len(t) > chunk * WINDOW:
                out[i] = self.predict(t, chunk)
            else:
                x, s = windows_of(t)
                xs.append(x)
                sizes.append(s)
                owner.append(np.full(len(s), i))
        if xs:
            x, size, own = np.concatenate(xs), np.concatenate(sizes), np.concatenate(owner)
            total = np.zeros((len(texts), len(self.languages)))
            for i in range(0, len(x), chunk):
                np.add.at(total, own[i : i + chunk], size[i : i + chunk, None] * self.log_probabilities(x[i : i + chunk]))
            for i in np.unique(own):
                z = total[i] / max(1, len(texts[i]))
                p = np.exp(z - z.max())
                p /= p.sum()
                out[i] = self.languages[int(p.argmax())], float(p.max())
        return out


def train(docs: DataFrame, texts: int = TEXTS, seed: int = 5) -> ByteNet | None:
    """A network from rows of ``docs(doc_id, text, lang)`` whose fold isn't 2; None if none has a language and a letter.

    Of each language the ``texts`` rows with the lowest hash of id and seed
    are used; where languages are many, fewer of each. Every language that
    occurs is learned.
    """
    rows = docs.filter((fold(F.col("doc_id")) != 2) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.select(F.col("lang").cast("string").alias("lang"), "text", F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.lit(str(seed)))).alias("h"))
    # Of a text, only what it is learned from goes on.
    cut = WINDOWS_PER_TEXT * WINDOW
    rows = rows.select("lang", "h", F.array(*[F.substring("text", 1, cut), F.expr(f"substring(text, 1 + length(text) div 2, {cut})")]).alias("parts"))
    # The lowest hashes of each language without ordering all of them in one task: a share that leaves enough, then a window.
    sizes = settle(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    many = sizes.count()
    texts = min(texts, max(LEAST_TEXTS, ALL_TEXTS // max(1, many)))
    share = F.least(F.lit(1.0), F.lit(4.0 * texts) / F.col("n"))
    u = F.conv(F.substring("h", 1, 8), 16, 10).cast("double") / float(1 << 32)
    few = rows.join(F.broadcast(sizes) if many <= BROADCAST_LANGUAGES else sizes, "lang").filter(u < share)
    few = few.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h", "parts"))).filter(F.col("k") <= texts)
    found = few.select("lang", "h", "parts").collect()
    discard(sizes)
    if not found:
        return None
    languages = sorted({r.lang for r in found})
    xs, ys = [], []
    for r in sorted(found, key=lambda r: (r.lang, r.h)):
        for part in r.parts:
            data = part.encode("utf-8", "surrogatepass")
            if data:
                x, sizes_ = windows_of(data)
                x = x[sizes_ >= min(32, len(data))][:WINDOWS_PER_TEXT]
                xs.append(x)
                ys.append(np.full(len(x), languages.index(r.lang)))
                # Short texts occur too: the start of a window stands for them.
                short = np.zeros_like(x[:1])
                short[:, : 48] = x[:1, : 48]
                xs.append(short)
                ys.append(np.full(1, languages.index(r.lang)))
    net = ByteNet(languages, seed)
    net.train(np.concatenate(xs), np.concatenate(ys))
    return net


def language_udf(docs: DataFrame, net: ByteNet) -> Column:
    shared = small_batches(docs).sparkSession.sparkContext.broadcast(net)

    @F.pandas_udf(T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    def language(texts: pd.Series, letters: pd.Series) -> pd.DataFrame:
        has = [bool(x) for x in letters]
        found = iter(shared.value.predict_many([t.encode("utf-8", "surrogatepass") for t, x in zip(texts, has) if x]))
        return pd.DataFrame([next(found) if x else (UNDETERMINED, 0.0) for x in has], columns=["lang_pred", "score"])

    return language(text_of(F.col("text")), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))


def identify(docs: DataFrame, texts: int = TEXTS, seed: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs(doc_id, text, lang)``.

    A text that is null or has no letter is ``und`` with score 0, and so is
    every text if there is nothing to learn from. Whole texts are read,
    however long. Of languages that tie, the first by code point is
    predicted. A null doc_id counts as the empty text in the fold. Repeated rows each
    give a row; other columns are ignored; an empty table gives no rows.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), "lang")
    net = train(docs, texts, seed)
    found = language_udf(docs, net) if net else F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    return docs.select("doc_id", (fold(F.col("doc_id")) == 2).alias("held_out"), found.alias("f")).select("doc_id", "held_out", "f.lang_pred", "f.score")
