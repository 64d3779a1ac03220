"""Benchmark decontamination by a prefix-filtered set join.

A window of item words is a set of word shingles, and a document can only
hold the window if it holds every shingle. So the necessary prefix of a
window is one shingle, its rarest in the corpus. Prefixes and windows are
tables of any size. Documents are read twice, once to count the benchmark's
shingles and once to find prefixes; both times a bitmap of fixed size keeps
nearly all other shingles from being shuffled. A place where a prefix may
occur goes on with the words around it, is joined to the windows of that
prefix, bounded by length and position, and compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from heliograph.llm.common import FILTER_BITS, discard, maybe_among, settle, small_batches, text_keys, text_of

#: Lower-cases A-Z and turns each byte that no word holds into a space.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def plain(text: str | None) -> bytes:
    """A text after lower-casing A-Z, with a space for each byte that no word holds."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES) if text else b""


def words_of(text: str | None) -> list[bytes]:
    """The words of a text after lower-casing A-Z: digits, a-z and all beyond ASCII."""
    return plain(text).split()


#: Bytes that are hashed at once; a piece ends between words, so only a longer word makes a longer piece.
PIECE = 1 << 17
_powers: list[np.ndarray] = []


def _powers_to(n: int) -> list[np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse, up to n at least."""
    if not _powers or len(_powers[0]) < n:
        base = 0x9E3779B97F4A7C15
        _powers[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n, PIECE + 1) - 1, x, np.uint64)])) for x in (base, pow(base, -1, 1 << 64))]
    return _powers


def _hash_piece(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the words of a piece: what each word adds to a sum over all bytes, moved to the same power."""
    edge = np.diff(np.concatenate([[False], b != 32, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers_to(len(b) + 1)
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _M2
    return starts, (h ^ (h >> np.uint64(32))) * _M1


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each word of texts whose words are apart by spaces, in order.

    Equal words have equal hashes. Others may have, too; whoever relies on
    them compares words in the end.
    """
    joined = b" ".join(texts)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    starts, hashes, at = [], [], 0
    while at < len(joined):
        end = len(joined) if len(joined) - at <= PIECE else joined.rfind(b" ", at, at + PIECE)
        if end <= at:  # a word that begins here is longer than a piece
            end = joined.find(b" ", at + 1)
            end = len(joined) if end < 0 else end
        s, h = _hash_piece(np.frombuffer(joined, np.uint8, end - at, at))
        starts.append(s + at)
        hashes.append(h)
        at = end
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.searchsorted(np.cumsum(sizes), np.concatenate(starts), side="right"), np.concatenate(hashes)


def shingle_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash for each run of ``size`` words, in order, from the words' hashes."""
    out = np.full(max(0, len(h) - size + 1), size, np.uint64)
    for i in range(size):
        x = out * _GOLD + h[i : i + len(out)]
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        out = x ^ (x >> np.uint64(31))
    return out.view(np.int64)


def _cut_windows(batches: Iterator[pd.DataFrame], window: int, shingle: int) -> Iterator[pd.DataFrame]:
    """A row for each shingle of each window of the items' words."""
    for b in batches:
        for item, text in zip(b["item"], b["text"]):
            w = words_of(text)
            _, each = word_hashes([plain(text)])
            k = min(window, len(w))
            size = min(shingle, k)
            out = []
            if k:
                h = shingle_hashes(each, size).tolist()
                for i in range(len(w) - k + 1):
                    words = b" ".join(w[i : i + k])
                    out += [(item, words, k, size, j, h[i + j]) for j in range(k - size + 1)]
            yield pd.DataFrame(out, columns=["item", "words", "length", "size", "place", "hash"])


class _Filter:
    """A bitmap of FILTER_BITS over hashes, by which most of those that aren't among them are told apart."""

    def __init__(self, words: np.ndarray, bits: np.ndarray):
        self.bits = np.zeros(FILTER_BITS // 64, np.uint64)
        self.bits[words] = bits.view(np.uint64)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """Positions of the hashes that may be among them."""
        p = hashes.view(np.uint64) & np.uint64(64 * len(self.bits) - 1)
        return np.flatnonzero((self.bits[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1))


def _filter(hashes: DataFrame):
    """The broadcast filter of the one column of ``hashes``; the driver gets at most FILTER_BITS / 64 rows, however many there are."""
    place = F.col("h").bitwiseAND(F.lit(FILTER_BITS - 1))
    marks = hashes.toDF("h").select(place.alias("p")).select(F.expr("p div 64").alias("word"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("bit"))
    found = marks.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    return hashes.sparkSession.sparkContext.broadcast(_Filter(found["word"].to_numpy(np.int64), found["bits"].to_numpy(np.int64)))


def _found(texts: list[bytes], sizes: list[int], among: _Filter) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """How many words each text has; and per size, the texts and places in them where a shingle passes the filter, and its hash. The texts are worked on as one array."""
    text, each = word_hashes(texts)
    n = np.bincount(text, minlength=len(texts))
    first, out = np.cumsum(n) - n, []
    for size in sizes:
        h = shingle_hashes(each, size)
        at = among(h)
        at = at[text[at] == text[at + size - 1]]  # none from one text into the next
        out.append((size, text[at], at - first[text[at]], h[at]))
    return n, out


def _count(batches: Iterator[pd.DataFrame], sizes: list[int], wanted) -> Iterator[pd.DataFrame]:
    """How often hashes that pass the filter occur in a batch of texts."""
    for b in batches:
        found = [h for *_, h in _found([plain(t) for t in b["text"]], sizes, wanted.value)[1]]
        h, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_counts=True)
        yield pd.DataFrame({"hash": h, "n": n.astype(np.int64)})


def _locate(batches: Iterator[pd.DataFrame], sizes: list[int], window: int, wanted) -> Iterator[pd.DataFrame]:
    """Per text, its number of words and the places where a prefix may be, each with the words around it."""
    for b in batches:
        texts = [plain(t) for t in b["text"]]
        n, found = _found(texts, sizes, wanted.value)
        words: dict[int, list[bytes]] = {}
        places: list[list[dict]] = [[] for _ in texts]
        for size, owners, ats, hashes in found:
            for i, at, h in zip(owners.tolist(), ats.tolist(), hashes.tolist()):
                w = words[i] if i in words else words.setdefault(i, texts[i].split())
                first = max(0, at - window + size)
                places[i].append({"hash": h, "at": at, "first": first, "around": [x.decode("utf-8", "surrogatepass") for x in w[first : at + window]]})
        yield pd.DataFrame({**{c: b[c] for c in b.columns if c != "text"}, "n_words": n.astype(np.int64), "places": places})


def _windows(benchmark: DataFrame, window: int, shingle: int) -> DataFrame:
    """item, words, length, size, place and hash: a row for each shingle of each distinct window. Settled."""
    items = small_batches(benchmark).select(F.col("item_id").cast("string").alias("item"), text_of(F.col("text")).alias("text"))
    cut = items.mapInPandas(partial(_cut_windows, window=window, shingle=shingle), "item string, words binary, length int, size int, place int, hash long")
    return settle(cut.distinct(), "windows")


def _hits(texts: DataFrame, keys: list[str], benchmark: DataFrame, window: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """(rows, hits), settled: the keys, n_words and row of each of ``texts(keys, text)``, and row, start, length and item of each window in it."""
    windows = _windows(benchmark, window, shingle)
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # from 1 to shingle
    wanted = _filter(windows.select("hash").distinct())
    counts = small_batches(texts).select("text").mapInPandas(partial(_count, sizes=sizes, wanted=wanted), "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    # The prefix: of a window's shingles the rarest, of equally rare ones that of the least hash.
    by_rarity = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "hash", "place")
    prefixes = windows.select("words", "length", "size", "place", "hash").distinct().join(counts, "hash", "left").groupBy("words", "length", "size").agg(F.min(by_rarity).alias("p"))
    # A window whose prefix never occurs needs no look.
    prefixes = settle(prefixes.filter("p.n > 0").select("words", "length", "p.place", "p.hash"), "prefixes")
    wanted.destroy()
    wanted = _filter(prefixes.select("hash").distinct())
    place = "struct<hash:bigint,at:int,first:int,around:array<string>>"
    kinds = ", ".join(f"{c} {t}" for c, t in texts.dtypes if c in keys)
    found = texts.select(*keys, "text").mapInPandas(partial(_locate, sizes=sizes, window=window, wanted=wanted), f"{kinds}, n_words long, places array<{place}>")
    # Numbers of rows of a written table stay what they are.
    rows = settle(found.withColumn("row", F.monotonically_increasing_id()), "located")
    wanted.destroy()
    near = rows.filter(F.size("places") > 0).select("row", "n_words", F.explode("places").alias("x")).select("row", "n_words", "x.*")
    near = near.join(prefixes, "hash").withColumn("start", F.col("at") - F.col("place"))
    near = near.filter((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words")))
    same = F.array_join(F.slice("around", F.col("start") - F.col("first") + 1, F.col("length")), " ") == F.col("words").cast("string")
    exact = near.filter(same).select("row", "start", "length", "words").distinct()
    hits = settle(exact.join(windows.select("words", "item").distinct(), "words").select("row", "start", "length", "item"), "hits")
    discard(windows, prefixes)
    return rows.drop("places"), hits


def find_overlaps(docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 5) -> DataFrame:
    """doc_id, n_words, spans and items of every row of ``docs(doc_id, text)``.

    ``spans`` are the word positions [start, stop) that windows of
    ``benchmark(item_id, text)`` cover, ``items`` the items they come from.
    A window has ``window`` words; an item of fewer, but not none, is one
    window. Null and wordless texts have no words and no spans, and such
    items match nothing. A window of an item without an id counts for spans,
    and for no item. Very long texts are searched whole. Repeated rows each
    give a row; other columns are ignored; empty tables give no rows or no
    spans.
    """
    rows, hits = _hits(docs.select("doc_id", text_of(F.col("text")).alias("text")), ["doc_id"], benchmark, window, shingle)
    # Windows that overlap or touch are merged into one span.
    found = hits.select("row", "start", (F.col("start") + F.col("length")).cast("int").alias("stop")).distinct()
    order = W.partitionBy("row").orderBy("start", "stop")
    reach = F.max("stop").over(order.rowsBetween(W.unboundedPreceding, -1))
    found = found.withColumn("new", F.when(F.col("start") <= reach, 0).otherwise(1)).withColumn("span", F.sum("new").over(order))
    found = found.groupBy("row", "span").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    spans = found.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    items = hits.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    of = lambda c, kind: F.coalesce(c, F.array().cast(kind)).alias(c)
    return rows.join(spans, "row", "left").join(items, "row", "left").select("doc_id", "n_words", of("spans", "array<struct<start:int,stop:int>>"), of("items", "array<string>"))


def report(overlaps: DataFrame) -> DataFrame:
    """Counts and a digest per document, from what find_overlaps gives."""
    return overlaps.select(
        "doc_id",
        "n_words",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 5) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no window of the benchmark. Only rows that may hold one are shuffled."""
    text = text_of(F.col("text"))
    rows, hits = _hits(docs.select(*text_keys(text), text.alias("text")), ["text_key", "text_key_2"], benchmark, window, shingle)
    bad = settle(rows.join(hits.select("row").distinct(), "row", "left_semi").select("text_key", "text_key_2").distinct(), "bad")
    tagged = docs.select(*text_keys(text), F.struct("*").alias("row"))
    asked = maybe_among(tagged, F.col("text_key"), bad.select("text_key"))
    clean = asked.filter("_maybe").join(bad, ["text_key", "text_key_2"], "left_anti").select("row")
    return asked.filter("not _maybe").select("row").unionByName(clean).select("row.*")
