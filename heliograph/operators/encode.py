"""Vectors of texts: a model loaded once a worker, and a small one that needs no weights."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from zlib import crc32

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WORD = re.compile(r"[^\W_]+")
Encoder = Callable[[list[str]], np.ndarray]


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


_CRC = _crc_table()
#: Odd numbers that tell the letters of a piece apart by their place.
_PLACES = np.random.default_rng(1).integers(1 << 62, size=5, dtype=np.uint64) * 2 + 1


def _crc32(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of many short runs of bytes at once."""
    c = np.full(len(start), 0xFFFFFFFF, np.uint32)
    least = size.min(initial=1 << 30)
    for j in range(size.max(initial=0)):
        on = slice(None) if j < least else np.flatnonzero(size > j)
        x = c[on]
        c[on] = _CRC[(x ^ buf[start[on] + j]) & 255] ^ (x >> 8)
    return ~c


class PieceEncoder:
    """Texts by their words and the pieces of three to five letters in them, hashed, and projected at random to few dimensions.

    Texts that share words or word stems point in similar directions. The
    projection follows from the seed, so every worker has the same.
    """

    def __init__(self, dimensions: int = 64, buckets: int = 1 << 15, seed: int = 7):
        self.buckets = buckets
        self.projection = np.random.default_rng(seed).normal(size=(buckets, dimensions)).astype(np.float32)

    def pieces(self, words: Counter) -> tuple[np.ndarray, np.ndarray]:
        """The bucket of each distinct piece of the words, and how often it occurs. All pieces of a text are cut at once; 64 bits tell them apart."""
        marked = [f"<{w}>" for w in words]
        times = np.fromiter(words.values(), np.float64, len(words))
        whole = np.fromiter((crc32(w.encode("utf-8", "surrogatepass")) for w in marked), np.int64, len(words))
        text = "".join(marked)
        letters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        buf = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        byte = np.concatenate([[0], np.cumsum(1 + (letters >= 0x80) + (letters >= 0x800) + (letters >= 0x10000))])
        length = np.fromiter(map(len, marked), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), length)
        left, wide = np.cumsum(length)[word] - np.arange(len(letters)), length[word]
        name, names, starts, sizes = np.zeros(len(letters), np.uint64), [], [], []
        for j in range(5):
            name = name[: len(letters) - j] + letters[j:] * _PLACES[j]
            if j >= 2:
                at = np.flatnonzero((left > j) & (wide > j + 1))
                names.append(name[at])
                starts.append(at)
                sizes.append(np.full(len(at), j + 1))
        start, size = np.concatenate(starts), np.concatenate(sizes)
        names = np.concatenate(names)
        order = np.argsort(names)
        names, start, size = names.take(order), start.take(order), size.take(order)
        new = np.flatnonzero(np.concatenate([names[:1] == names[:1], names[1:] != names[:-1]]))
        n = np.add.reduceat(times.take(word.take(start)), new) if len(new) else np.zeros(0)
        start, size = start.take(new), size.take(new)
        start, end = byte.take(start), byte.take(start + size)
        return np.concatenate([whole, _crc32(buf, start, end - start)]) % self.buckets, np.concatenate([times, n])

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.projection.shape[1]), np.float32)
        for row, text in enumerate(texts):
            if words := Counter(_WORD.findall((text or "").lower())):
                at, n = self.pieces(words)
                weight = np.sqrt(n.astype(np.float32))
                order = np.argsort(at << 32 | weight.view(np.int32))  # by bucket, then weight: sums don't depend on the order of words
                v = np.einsum("i,ij->j", weight[order].astype(np.float64), self.projection.take(at[order], axis=0).astype(np.float64))  # in this thread alone
                out[row] = v / (np.linalg.norm(v) or 1.0)
        return out


def encoded(text: Column, load: Callable[[], Encoder] = PieceEncoder, batch: int = 128) -> Column:
    """A vector for each text, null counting as empty. ``load`` makes the encoder once for each Python worker, which keeps it."""

    def make() -> Callable[[np.ndarray], np.ndarray]:
        encoder = load()
        return lambda texts: np.asarray(encoder([str(t) for t in texts]), np.float32)

    model = predict_batch_udf(make, return_type=T.ArrayType(T.FloatType()), batch_size=batch)
    return model(F.coalesce(text.cast("string"), F.lit("")))
