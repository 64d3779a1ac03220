"""Removal of long repeated passages, found by recompression.

Texts are sequences of words, and rounds of recompression make them
shorter. A round names every run of a symbol and every pair of neighbouring
runs of which the first symbol falls on the left side and the second on the
right, sides being drawn from the symbols' names. Names follow from what
they stand for, so every task names alike, and equal passages get equal
symbols in their interior wherever they stand. With each border between
symbols goes the stretch of words that decides it, so that a symbol counts
as interior to a window only if no word outside the window had a say in it.

1. Each window is stood for by four neighbouring interior symbols of the
   highest round that has them, those of the least name. All occurrences of a
   window choose the same name at different places, so a window whose symbols
   occur once together occurs once. The windows that a place stands for are
   its unit. Names and units are counted over all texts.
2. The windows of a unit that occurs again occur again. Those of a lone unit
   whose name occurs again are counted one by one, with those of one unit
   for each other that has the name, by the name and an independent hash of
   their words, together 128 bits; what is counted once is told to its text.
3. The words of windows that occur again are removed.

The choice depends on the words of a window alone, so texts are taken in
pieces of bounded size and the result doesn't depend on the pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliograph.llm.common import discard, maybe_among, packed, settle, small_batches, text_keys, text_of
from heliograph.llm.decontam import word_hashes

WINDOW = 35
#: After three rounds a symbol has some two words, and most windows of 35 hold several times four with all that decides them. More rounds make more
#: places, fewer symbols together make more of them occur again by chance.
ROUNDS, TOGETHER = 3, 4
#: Words that are worked on at a time.
PIECE = 1 << 16
#: Copies of a text are left out of steps 1 and 2, one apart, if they make up at least one in so many rows. So at most so many texts are broadcast.
HOT = 4096
_FAR = np.int64(1) << 40
_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_SPACES = bytes(32 if b in b"\t\n\v\f\r" else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but the six ASCII white-space characters."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def _round(x: np.ndarray, at: np.ndarray, edge: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """One round. A symbol has its name x, its first word, whether it stands at the edge of a piece, and the words [low, high) that decide the border before it. Borders at edges stay."""
    free = ~edge[1:]
    same = (x[1:] == x[:-1]) & free
    right = (_mix(x ^ np.uint64(0x9E3779B97F4A7C15 * (2 * k + 1) % (1 << 64))) >> np.uint64(63)).astype(bool)
    pair = ~right[:-1] & right[1:] & free
    keep = np.concatenate([[True], ~(same | pair)])
    first = np.flatnonzero(keep)
    until = np.append(first[1:], len(x))
    # Where the second run of a symbol begins; at its end if there is one run.
    turn = until.copy()
    second = np.flatnonzero(pair) + 1
    turn[np.searchsorted(first, second, "right") - 1] = second
    name = _mix((x[first] + _GOLD) * _M2 + (turn - first).astype(np.uint64))
    tail = _mix((x[until - 1] ^ _M1) * _GOLD + (until - turn).astype(np.uint64))
    name = np.where(turn < until, _mix(name * _M1 + tail), name)
    name = np.where(until - first == 1, x[first], name)
    # Whether a border stays depends on both neighbours, and on what their other borders depend on.
    low2, high2 = np.concatenate([low[:1], low[:-1]])[first], np.concatenate([high[1:], high[-1:]])[first]
    edge2 = edge[first]
    return name, at[first], edge2, np.where(edge2, -_FAR, low2), np.where(edge2, _FAR, high2)


def anchors(pieces: list[np.ndarray], window: int = WINDOW, rounds: int = ROUNDS, together: int = TOGETHER) -> tuple[np.ndarray, np.ndarray]:
    """For each window of each piece of hashed words, in order: the name of the symbols that stand for it, and a number of their place."""
    m = min(together, window)
    lengths = np.array([len(p) for p in pieces])
    starts = np.cumsum(lengths + 1) - lengths - 1  # a mark follows each piece
    total = int(lengths.sum() + len(pieces))
    x, edge = np.zeros(total, np.uint64), np.zeros(total, bool)
    left, right = np.repeat(starts, lengths + 1), np.repeat(starts + lengths, lengths + 1)
    for s, p in zip(starts, pieces):
        x[s : s + len(p)] = p
    edge[starts] = edge[starts + lengths] = True
    at = np.arange(total)
    levels = [(x, at, edge, at, at)]  # nothing decides the borders of words
    for k in range(rounds):
        levels.append(_round(*levels[-1], k))
    is_window = at + window <= right
    is_window[starts + lengths] = False
    open_, best, name = is_window.copy(), np.full(total, -1), np.zeros(total, np.uint64)
    place = 0
    for x, at, edge, low, high in reversed(levels):
        if not open_.any():
            break
        if len(at) <= m:
            continue
        # Symbols j to j + m - 1 reach from border j to border j + m; windows that start in [a, b] hold all that decides these and those between.
        a = np.maximum(high[m:], at[m:]) - window
        b = np.minimum(low[:-m], at[:-m])
        a, b = np.maximum(a, left[at[:-m]]), np.minimum(b, right[at[:-m]] - window)
        x, single = x[: len(x) - m], x
        for i in range(1, m):
            x = _mix(x * _GOLD + single[i : len(x) + i])
        seen = np.concatenate([[0], np.cumsum(open_)])
        j = np.flatnonzero((a <= b) & (at[m:] <= right[at[:-m]]))
        j = j[seen[b[j] + 1] > seen[a[j]]]
        j = j[np.lexsort((at[j], x[j]))]
        reach = b[j] - a[j] + 1
        starts_at = np.repeat(a[j] - np.cumsum(reach) + reach, reach) + np.arange(reach.sum())
        rank = np.repeat(np.arange(len(j)), reach)
        wanted = open_[starts_at]
        starts_at, rank = starts_at[wanted], rank[wanted]
        least = np.full(total, len(j))
        np.minimum.at(least, starts_at, rank)
        got = np.flatnonzero(least < len(j))
        name[got], best[got] = x[j[least[got]]], place + least[got]
        open_[got] = False
        place += len(j)
    return name[is_window], best[is_window]


def _hashed(texts: list[str], window: int, piece: int) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """Lists of (text, first word, hashed words), of about ``piece`` words together: pieces of texts that hold each window once."""
    held, size = [], 0
    row, h = word_hashes([t.encode("utf-8", "surrogatepass").translate(_SPACES) for t in texts])
    cuts = np.searchsorted(row, np.arange(len(texts) + 1))
    for k, (i, z) in enumerate(zip(cuts, cuts[1:])):
        for at in range(i, z - window + 1, piece):
            held.append((k, int(at - i), h[at : min(z, at + piece + window - 1)]))
            size += len(held[-1][2])
            if size >= piece:
                yield held
                held, size = [], 0
    if held:
        yield held


_powers: list[np.ndarray] = []


def _runs(x: np.ndarray) -> list[tuple[int, int]]:
    """Where runs of equal numbers begin and end."""
    cuts = [0, *(np.flatnonzero(np.diff(x)) + 1).tolist(), len(x)] if len(x) else []
    return list(zip(cuts, cuts[1:]))


class _Group:
    """Pieces of texts with all that follows from their words: of each window its start in the pieces' words, text, first word, place and name, and of each place its first window and unit."""

    def __init__(self, group: list[tuple[int, int, np.ndarray]], window: int):
        pieces, lengths = [h for *_, h in group], np.array([len(h) for *_, h in group])
        self.h, self.window = np.concatenate(pieces), window
        self.name, place = anchors(pieces, window)
        inside = np.arange(len(self.h)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.start = np.flatnonzero(inside + window <= np.repeat(lengths, lengths))
        self.row = np.repeat([r for r, *_ in group], lengths - window + 1)
        self.at = inside[self.start] + np.repeat([at for _, at, _ in group], lengths - window + 1)
        if not _powers or len(_powers[0]) <= len(self.h):
            base, n = 0x9E3779B97F4A7C15, 2 * len(self.h)
            _powers[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, x, np.uint64)])) for x in (base, pow(base, -1, 1 << 64))]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.h * _powers[0][: len(self.h)])])
        # A unit is told by where its windows begin and all their words.
        order = np.argsort(place, kind="stable")
        cut = np.flatnonzero(np.diff(place[order], prepend=-1))
        n = np.diff(np.append(cut, len(order)))
        self.first, last = order[cut], order[cut + n - 1]
        self.unit = self._words(self.start[self.first], self.start[last] + window) + n.astype(np.uint64) * _M2
        self.of = np.empty(len(order), np.int64)  # the place of each window
        self.of[order] = np.repeat(np.arange(len(cut)), n)

    def _words(self, i: np.ndarray, z: np.ndarray) -> np.ndarray:
        """A hash of the words from i up to z."""
        return _mix((self.sums[z] - self.sums[i]) * _powers[1][i] + (z - i).astype(np.uint64) * _M1)

    def hashes(self, p: np.ndarray) -> np.ndarray:
        """Of the windows p; independent of their names."""
        return self._words(self.start[p], self.start[p] + self.window).view(np.int64)

    def among(self, known: list[np.ndarray]) -> np.ndarray:
        """Whether each window's unit is among those of its text."""
        row, unit = self.row[self.first], self.unit.view(np.int64)
        order, found = np.argsort(row, kind="stable"), np.zeros(len(row), bool)
        for i, z in _runs(row[order]):
            at = order[i:z]
            if len(ids := known[row[at[0]]]):
                found[at] = np.isin(unit[at], ids)
        return found[self.of]


def _named(batches: Iterator[pd.DataFrame], window: int, piece: int) -> Iterator[pd.DataFrame]:
    """By text, the names that stand for its windows and their units."""
    for batch in batches:
        key, copies = batch["text_key"].to_numpy(), batch["copies"].to_numpy()
        for group in _hashed(batch["text"].tolist(), window, piece):
            g = _Group(group, window)
            row = g.row[g.first]
            yield pd.DataFrame({"name": g.name[g.first].view(np.int64), "unit": g.unit.view(np.int64), "text_key": key[row], "n": copies[row]})


def _arrays(column: pd.Series) -> list[np.ndarray]:
    return [np.zeros(0, np.int64) if x is None else np.asarray(x, np.int64) for x in column]


def _suspects(batches: Iterator[pd.DataFrame], window: int, piece: int) -> Iterator[pd.DataFrame]:
    """The windows of lone units, and of those that stand for a unit that occurs again, which count twice."""
    for batch in batches:
        key, lone, often = batch["text_key"].to_numpy(), _arrays(batch["lone"]), _arrays(batch["often"])
        for group in _hashed(batch["text"].tolist(), window, piece):
            g = _Group(group, window)
            twice = g.among(often)
            p = np.flatnonzero(twice | g.among(lone))
            yield pd.DataFrame({"name": g.name[p].view(np.int64), "words": g.hashes(p), "text_key": key[g.row[p]], "n": 1 + twice[p].astype(np.int64)})


def _left(text: str, starts: list[np.ndarray], window: int) -> tuple[int, int, str]:
    w = words_of(text)
    n = len(w)
    if starts:
        depth = np.zeros(n + 1, np.int64)
        s = np.concatenate(starts)
        np.add.at(depth, s, 1)
        np.add.at(depth, s + window, -1)
        w = [w[i] for i in np.flatnonzero(np.cumsum(depth[:n]) == 0).tolist()]
    return n, n - len(w), b" ".join(w).decode("utf-8", "surrogatepass")


def _keys(docs: DataFrame, seed: int, *more) -> DataFrame:
    text = text_of(F.col("text"))
    return packed(small_batches(docs), text.alias("text"), *more).select("*", *text_keys(F.col("text"), seed))


def _texts(docs: DataFrame) -> tuple[int, DataFrame]:
    """(seed, texts): with this seed, text_key tells the texts of ``docs`` apart; a text has text_key, its number of copies and the least hash of an id."""
    for seed in range(4):
        rows = _keys(docs, seed).select("text_key", "text_key_2", F.xxhash64(F.col("row.doc_id").cast("string")).alias("id"))
        texts = rows.groupBy("text_key").agg(F.count("*").alias("copies"), F.min("id").alias("first"), F.min("text_key_2").alias("lo"), F.max("text_key_2").alias("hi"))
        texts = settle(texts, "texts")
        if texts.filter("lo <> hi").isEmpty():
            return seed, texts.drop("lo", "hi")
        discard(texts)
    raise RuntimeError("hashes of different texts agree")


def repeats(docs: DataFrame, window: int = WINDOW, piece: int = PIECE) -> DataFrame:
    """n_words, n_removed and kept (the words left, joined by one space) of each row of ``docs``, whose columns are the struct ``row``.

    Every word covered by a window of ``window`` words that also starts
    anywhere else, in the same text or another row, is removed; all
    occurrences go, the first too. So does all of a text of at least
    ``window`` words that stands in several rows. Null and blank texts have
    no words, and shorter ones than a window lose none. Repeated rows count
    as copies; null and repeated ids are rows like any other; an empty table
    gives no rows.
    """
    seed, texts = _texts(docs)
    rows = _keys(docs, seed).withColumn("id", F.xxhash64(F.col("row.doc_id").cast("string")))
    total = texts.agg(F.sum("copies")).first()[0] or 0
    hot = texts.filter((F.col("copies") > 1) & (F.col("copies") * HOT >= total))
    each = rows.select("text_key", "id", "text").join(F.broadcast(hot), "text_key", "left").filter(F.col("copies").isNull() | (F.col("id") == F.col("first")))
    each = each.select("text_key", F.coalesce("copies", F.lit(1).cast("bigint")).alias("copies"), "text")
    named = settle(each.mapInPandas(partial(_named, window=window, piece=piece), "name long, unit long, text_key long, n long"), "named")
    shared = named.groupBy("name").agg(F.sum("n").alias("total"), (F.min("unit") == F.max("unit")).alias("alike")).filter("total > 1")
    shared = settle(shared.select("name", "alike"), "shared")
    again = maybe_among(named, F.col("name"), shared.select("name")).filter("_maybe").drop("_maybe").join(shared.hint("merge"), "name")
    again = settle(again, "again")
    discard(named, shared)
    # Written down, so that the join deals both sides anew and can split a hot unit's rows.
    units = settle(again.groupBy("name", "unit").agg(F.sum("n").alias("total"), F.min("text_key").alias("of")), "units")
    marked = again.join(units.hint("merge"), ["name", "unit"])
    is_lone, stands = F.col("total") == 1, (F.col("total") > 1) & ~F.col("alike") & (F.col("text_key") == F.col("of"))
    marked = marked.select("text_key", "unit", is_lone.alias("lone"), stands.alias("stands")).distinct().repartition("text_key")
    kinds = [F.collect_list(F.when(when, F.col("unit"))).alias(c) for c, when in (("sure", ~F.col("lone")), ("lone", F.col("lone")), ("often", F.col("stands")))]
    names = settle(marked.groupBy("text_key").agg(*kinds), "names")
    discard(again, units)
    doubtful = names.filter("size(lone) > 0 or size(often) > 0").drop("sure")
    asked = maybe_among(each, F.col("text_key"), doubtful.select("text_key")).filter("_maybe").drop("_maybe").join(doubtful.hint("merge"), "text_key")
    suspects = asked.mapInPandas(partial(_suspects, window=window, piece=piece), "name long, words long, text_key long, n long")
    # What is counted once is in the text that the least key names.
    single = suspects.groupBy("name", "words").agg(F.sum("n").alias("n"), F.min("text_key").alias("text_key")).filter("n = 1")
    single = settle(single.select("text_key", "words").repartition("text_key").groupBy("text_key").agg(F.collect_list("words").alias("single")), "single")
    found = settle(names.drop("often").join(single, "text_key", "left"), "found")
    discard(names, single, texts)

    @F.pandas_udf("n_words long, n_removed long, kept string")
    def left(text: pd.Series, sure: pd.Series, lone: pd.Series, single: pd.Series) -> pd.DataFrame:
        texts, sure, lone, single = text.tolist(), _arrays(sure), _arrays(lone), _arrays(single)
        starts: list[list[np.ndarray]] = [[] for _ in texts]
        asked = [k for k in range(len(texts)) if len(sure[k]) or len(lone[k])]
        for group in _hashed([texts[k] for k in asked], window, piece):
            g = _Group(group, window)
            gone, p = g.among([sure[k] for k in asked]), np.flatnonzero(g.among([lone[k] for k in asked]))
            words, row = g.hashes(p), g.row[p]
            for i, z in _runs(row):
                gone[p[i:z]] |= ~np.isin(words[i:z], single[asked[row[i]]])
            p = np.flatnonzero(gone)
            for i, z in _runs(g.row[p]):
                starts[asked[g.row[p[i]]]].append(g.at[p[i:z]])
        return pd.DataFrame([_left(t, s, window) for t, s in zip(texts, starts)], columns=["n_words", "n_removed", "kept"])

    split = maybe_among(rows.select("row", "text", "text_key"), F.col("text_key"), found.select("text_key"))
    hit = split.filter("_maybe").drop("_maybe").join(found.hint("merge"), "text_key", "left")
    none = [F.lit(None).cast("array<bigint>").alias(c) for c in ("sure", "lone", "single")]
    clear = split.filter("not _maybe").select("text_key", "row", "text", *none)
    return hit.unionByName(clear).select("row", left("text", "sure", "lone", "single").alias("x")).select("row", "x.*")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` with what repeats() leaves as their text."""
    return repeats(docs, window).select(*(F.col("kept").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
