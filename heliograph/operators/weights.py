"""Vocabulary and TF-IDF weights of texts whose keys are distinct, by numbers of words in Arrow batches.

A pair of words occurs no more often than either word. So single words are
counted first, and only pairs of words that occur as often as the last word
that the vocabulary can hold are counted at all. What is shuffled are sums of
a batch: of words, and of such pairs as one number each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliograph.scratch import discard, settle

#: Words that every task holds at most, words that are counted at a time, and rows of a batch that goes out.
HELD, PIECE, OUT = 1 << 18, 1 << 20, 1 << 16


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, pa.Array]]:
    """Rows of about PIECE words at a time, with the row and the number of each word, and the words by number."""
    for b in batches:
        n = pc.fill_null(pc.list_value_length(b.column("t")), 0).to_numpy(zero_copy_only=False)
        slot = np.cumsum(n) // PIECE
        for cut in np.split(np.arange(len(n)), np.flatnonzero(np.diff(slot)) + 1):
            if len(cut) and n[cut].any():
                part = b.slice(cut[0], len(cut))
                coded = pc.list_flatten(part.column("t")).dictionary_encode()
                yield part, np.repeat(np.arange(len(cut)), n[cut]), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def _sums(row: np.ndarray, code: np.ndarray, codes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each code once, the rows that have it and how often it occurs."""
    each, tf = np.unique(row * codes + code, return_counts=True)
    found, at = np.unique(each % codes, return_inverse=True)
    return found, np.bincount(at, minlength=len(found)), np.bincount(at, tf, len(found)).astype(np.int64)


def _word_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, row, code, words in _pieces(batches):
        found, df, cf = _sums(row, code, len(words))
        yield pa.RecordBatch.from_arrays([words.take(pa.array(found)).cast(pa.string()), pa.array(df), pa.array(cf)], ["term", "df", "cf"])


def _numbered(words: pa.Array, code: np.ndarray, known: pa.Array) -> np.ndarray:
    """The place of each word among ``known``, -1 for another."""
    return pc.fill_null(pc.index_in(words.cast(known.type), value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)[code]


def _pairs(row: np.ndarray, number: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and code of neighbours that are both known."""
    both = (number[:-1] >= 0) & (number[1:] >= 0) & (row[:-1] == row[1:])
    return row[:-1][both], number[:-1][both] * k + number[1:][both]


def _pair_sums(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    known = pa.array(shared.value, pa.string())
    for _, row, code, words in _pieces(batches):
        found, df, cf = _sums(*_pairs(row, _numbered(words, code, known), len(known)), len(known) ** 2)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(df), pa.array(cf)], ["pair", "df", "cf"])


def _named(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    known = pa.array(shared.value, pa.string())
    for b in batches:
        pair = b.column("pair").to_numpy()
        term = pc.binary_join_element_wise(known.take(pa.array(pair // len(known))), known.take(pa.array(pair % len(known))), " ")
        yield pa.RecordBatch.from_arrays([term, b.column("df"), b.column("cf")], ["term", "df", "cf"])


def vocabulary(words: DataFrame, n: int, min_df: int = 2, max_share: float = 0.6, most: int = 5000) -> DataFrame | None:
    """What terms.vocabulary_of() gives of the counts of ``words(key, t)``; None if a task can't hold the words that count, as with a great many ties."""
    spark = words.sparkSession
    within = (F.col("df") >= min_df) & (F.col("df") <= max_share * n)
    summed = lambda df, by: df.groupBy(by).agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))
    single = settle(summed(words.select("t").mapInArrow(_word_sums, "term string, df long, cf long"), "term").filter(F.col("df") >= min_df), "singles")
    first = single.filter(within).orderBy(F.desc("cf"), "term").limit(most).collect()
    least = first[-1].cf if len(first) == most else min_df
    # The words of a pair that is within the bounds; a word in more texts than the bounds allow can be one of them.
    known = [r.term for r in single.filter(F.col("cf") >= least).select("term").limit(HELD + 1).collect()]
    discard(single)
    if len(known) > HELD:
        return None
    top = spark.createDataFrame(first, "term string, df long, cf long")
    if not known:
        return top
    shared = spark.sparkContext.broadcast(sorted(known))
    pairs = summed(words.select("t").mapInArrow(partial(_pair_sums, shared=shared), "pair long, df long, cf long"), "pair")
    named = pairs.filter(within & (F.col("cf") >= least)).mapInArrow(partial(_named, shared=shared), "term string, df long, cf long")
    return top.unionByName(named).orderBy(F.desc("cf"), "term").limit(most)


def _weighed(batches: Iterator[pa.RecordBatch], shared, keep: list[str]) -> Iterator[pa.RecordBatch]:
    known, terms, codes, idf = shared.value
    known, terms, k = pa.array(known, pa.string()), pa.array(terms, pa.string()), len(known)
    for part, row, code, words in _pieces(batches):
        number = _numbered(words, code, known)
        rows, pairs = _pairs(row, number, k)
        single = number >= 0
        rows, found = np.concatenate([row[single], rows]), np.concatenate([number[single], pairs + k])
        at = np.minimum(np.searchsorted(codes, found), len(codes) - 1)
        of = codes[at] == found
        each, tf = np.unique(rows[of] * len(codes) + at[of], return_counts=True)
        row, at = each // len(codes), each % len(codes)
        raw = (1 + np.log(tf)) * idf[at]
        w = raw / np.sqrt(np.bincount(row, raw * raw, len(part)))[row]
        for i in range(0, len(row), OUT):
            take = pa.array(row[i : i + OUT])
            yield pa.RecordBatch.from_arrays([part.column(c).take(take) for c in keep] + [terms.take(pa.array(at[i : i + OUT])), pa.array(w[i : i + OUT])], [*keep, "term", "w"])


def weights(words: DataFrame, vocabulary: DataFrame, n: int, key: str = "ord") -> DataFrame:
    """key, further columns of ``words(key, ..., t)``, term and w: what terms.tfidf() gives for a vocabulary that a task can hold."""
    keep = [key, *(c for c in words.columns if c not in (key, "t"))]
    schema = T.StructType([words.schema[c] for c in keep] + [T.StructField("term", T.StringType()), T.StructField("w", T.DoubleType())])
    rows = vocabulary.select("term", (F.log((1 + F.lit(n)) / (1 + F.col("df"))) + 1).alias("idf")).collect()
    if not rows:
        return words.sparkSession.createDataFrame([], schema)
    known = sorted({w for r in rows for w in r.term.split(" ")})
    place, k = {w: i for i, w in enumerate(known)}, len(known)
    codes = np.array([place[a] if not z else k + place[a] * k + place[z] for a, _, z in (r.term.partition(" ") for r in rows)], np.int64)
    order = codes.argsort()
    shared = words.sparkSession.sparkContext.broadcast((known, [rows[i].term for i in order], codes[order], np.array([r.idf for r in rows])[order]))
    return words.select(*keep, "t").mapInArrow(partial(_weighed, shared=shared, keep=keep), schema)
