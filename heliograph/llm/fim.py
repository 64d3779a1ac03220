"""Fill-in-middle rearrangement of whole texts by a streaming matcher.

A text is cut at two of its units, a unit being a word with the white space
before it. A first pass of the matcher counts the units; a second advances a
lazy iterator of matches to the two ranks drawn and keeps no more than the
offset it has reached. No list of units is ever made, so a text of any
length costs two integers beside itself. The text is then cut and put
together by expressions.

Which documents are rearranged, how, and where they are cut follows from
hashes of doc_id and the seed alone, so reruns agree however rows are dealt.
"""

from __future__ import annotations

import re
from collections import deque
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliograph.llm.common import small_batches, text_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
#: Of a hundred documents so many are rearranged, and of a hundred of those so many with the suffix first.
RATE, SUFFIX_FIRST = 50, 80

#: Possessive, so that a run of white space is never walked back.
_UNIT = re.compile(r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++")


def count_units(text: str) -> int:
    return sum(1 for _ in _UNIT.finditer(text))


def end_offsets(text: str, low: int, high: int) -> tuple[int, int]:
    """Where unit number ``low`` and unit number ``high`` end (0 for none), in code points; low <= high."""
    matches, ends, at, passed = _UNIT.finditer(text), [], 0, 0
    for rank in (low, high):
        if last := deque(islice(matches, rank - passed), maxlen=1):
            at = last[0].end()
        passed = rank
        ends.append(at)
    return ends[0], ends[1]


@F.pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in ("n", "first", "second")]))
def _cuts(text: pd.Series, h1: pd.Series, h2: pd.Series, plain: pd.Series) -> pd.DataFrame:
    out = []
    for t, x, y, stays in zip(text, h1, h2, plain):
        n = count_units(t)
        out.append((n, 0, 0) if stays else (n, *end_offsets(t, *sorted((x % (n + 1), y % (n + 1))))))
    return pd.DataFrame(out, columns=["n", "first", "second"], dtype="int64")


def rearrange(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """doc_id, text, n, form, prefix_chars, middle_chars and output of every row of ``docs(doc_id, text)``.

    form is plain, psm (prefix, suffix, middle) or spm (suffix, prefix,
    middle); output is the text as a model is to read it. A null text counts
    as empty; empty texts and texts that hold a mark stay plain, with null
    lengths. A null id hashes as the empty text. Both ranks may be equal or
    lie at an end: parts can be empty. Repeated rows each give a row, the
    same; other columns are ignored; an empty table gives no rows.
    """
    text = text_of(F.col("text"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    rows = small_batches(docs).select("doc_id", text.alias("text"), digest.alias("d"))
    h = [F.conv(F.substring("d", 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = (F.col("text") == "") | marked | (h[2] % 100 >= rate)
    form = F.when(plain, "plain").when(h[3] % 100 < suffix_first, "spm").otherwise("psm")
    cut = rows.select("doc_id", "text", form.alias("form"), _cuts("text", h[0], h[1], plain).alias("c"))
    middle = F.col("c.second") - F.col("c.first")
    part = lambda start, length: F.substring("text", start, length)
    prefix, mid = part(F.lit(1), F.col("c.first").cast("int")), part((F.col("c.first") + 1).cast("int"), middle.cast("int"))
    suffix = part((F.col("c.second") + 1).cast("int"), F.length("text"))
    psm = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), mid)
    spm = F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), mid)
    stays = F.col("form") == "plain"
    return cut.select(
        "doc_id",
        "text",
        F.col("c.n").alias("n"),
        "form",
        F.when(~stays, F.col("c.first")).alias("prefix_chars"),
        F.when(~stays, middle).alias("middle_chars"),
        F.when(stays, F.col("text")).when(F.col("form") == "spm", spm).otherwise(psm).alias("output"),
    )


def restore(output: Column, form: Column) -> Column:
    """The exact text that rearrange() made ``output`` of.

    A rearranged text holds no mark of its own, and no mark begins with what
    another ends in, so the first of each kind is the one put in.
    """
    inner = F.substring(output, F.lit(len(PREFIX) + 1), F.length(output))  # without the mark at the front; all are of one length

    def parts(between: str) -> tuple[Column, Column, Column]:
        one = F.substring_index(inner, between, 1)
        rest = F.substring(inner, F.length(one) + F.lit(len(between) + 1), F.length(inner))
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, F.substring(rest, F.length(two) + F.lit(len(MIDDLE) + 1), F.length(rest))

    suffix, prefix, middle = parts(PREFIX)
    spm = F.concat(prefix, middle, suffix)
    prefix, suffix, middle = parts(SUFFIX)
    return F.when(form == "plain", output).when(form == "spm", spm).otherwise(F.concat(prefix, middle, suffix))


def digests(found: DataFrame) -> DataFrame:
    """What rearrange() gives, with digests of the output and of the text rebuilt from it in place of texts."""
    both = found.withColumn("restored", restore(F.col("output"), F.col("form")))
    return both.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
