"""Token counts: pieces are counted once per distinct pre-token and joined to the pre-token frequencies of each document."""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliograph.llm.common import settle, small_batches, text_keys, text_of

#: Fixed value: the published splitting pattern of byte-level BPE vocabularies.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts of these characters are split by the pattern; all others by the library, whose Unicode version decides.
PLAIN_TEXT = r"[\t\n\r\x20-\x7E¡-¬®-ɏΑ-ΡΣ-ώА-я‐-‧ぁ-ゖ一-龥]*"
#: Texts of Latin letters and common signs only are split by what the pattern means for them, with explicit classes.
LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
LATIN_TEXT = rf"[\t\n\r\x20-\x7E{LATIN}–—‘’“”…«»¡¿€]*"
LATIN_PATTERN = rf" ?[{LATIN}]+| ?[0-9]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\t\n\r {LATIN}0-9]+|[\t\n\r ]+(?![^\t\n\r ])|[\t\n\r ]+"
#: At most so many frequent pre-tokens are broadcast. Longer ones than this go by a digest, there and as keys of the shuffle.
HEAD_PIECES, NAME_LENGTH = 1 << 20, 48

_made: dict[int, tuple] = {}


def _tools(spec: str) -> tuple:
    """(tokenizer, split function, specials) of a tokenizer file's content, once per worker."""
    key = hash(spec)
    if key not in _made:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        tok = Tokenizer.from_str(spec)
        tok.no_padding()
        tok.no_truncation()
        said = json.loads(spec)
        pre = said.get("pre_tokenizer") or {}
        if said.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError("only byte-level tokenizers without a normalizer split into pre-tokens independently of what surrounds them")
        if any(x.get("single_word") or x.get("lstrip") or x.get("rstrip") for x in said["added_tokens"]):
            raise ValueError("added tokens that take their surroundings with them aren't supported")
        specials = [x["content"] for x in said["added_tokens"]]
        cut = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        plain, pieces = regex.compile(PLAIN_TEXT), regex.compile(BYTE_LEVEL_PATTERN)
        latin, latin_pieces = re.compile(LATIN_TEXT), re.compile(LATIN_PATTERN)

        def split(text: str) -> list[str]:
            if latin.fullmatch(text):
                return latin_pieces.findall(text)
            if plain.fullmatch(text):
                return pieces.findall(text)
            return [text[a:b] for _, (a, b) in tok.pre_tokenizer.pre_tokenize_str(text)]

        def pretokens(text: str) -> tuple[list[str], int]:
            """The pre-tokens of a text, and how many special strings it holds."""
            if cut is None or not cut.search(text):
                return split(text), 0
            parts = cut.split(text)
            return [p for x in parts if x for p in split(x)], len(parts) - 1

        _made[key] = tok, pretokens
    return _made[key]


def name_of(piece: str) -> str:
    """The piece itself, or of a long one a 128-bit digest behind a NUL, which no pre-token of letters or digits holds."""
    if len(piece) <= NAME_LENGTH:
        return piece
    return "\x00" + hashlib.blake2b(piece.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def _batch_counts(batches: Iterator[pd.DataFrame], spec: str) -> Iterator[pd.DataFrame]:
    _, pretokens = _tools(spec)
    for b in batches:
        seen: Counter = Counter()
        for t in b["text"]:
            if t:
                seen.update(pretokens(t)[0])
        yield pd.DataFrame({"piece": list(seen.keys()), "n": list(seen.values())})


def _encode(batches: Iterator[pd.DataFrame], spec: str) -> Iterator[pd.DataFrame]:
    tok, _ = _tools(spec)
    tok.encode_special_tokens = True
    for b in batches:
        pieces = b["piece"].tolist()
        yield pd.DataFrame({"piece": [name_of(p) for p in pieces], "n": b["n"], "pieces": [len(e.ids) for e in tok.encode_batch(pieces, add_special_tokens=False)]})
    tok.encode_special_tokens = False


def _per_document(batches: Iterator[pd.DataFrame], spec: str, head) -> Iterator[pd.DataFrame]:
    """A row per document and pre-token that isn't in the head; the first row of a document carries what the head gives."""
    _, pretokens = _tools(spec)
    known = head.value
    for b in batches:
        ids, keys, sizes, sums, names, counts, checks = [], [], [], [], [], [], []
        for doc_id, key, check, text in zip(b["doc_id"], b["text_key"], b["text_key_2"], b["text"]):
            found, tokens = pretokens(text) if text else ([], 0)
            rest = []
            for p, n in Counter(found).items():
                p = name_of(p)
                c = known.get(p)
                if c is None:
                    rest.append((p, n))
                else:
                    tokens += n * c
            rest = rest or [(f"\x00{key % 9973}", 0)]  # no pre-token holds a NUL and digits
            k = len(rest)
            ids += [doc_id] * k
            keys += [key] * k
            sizes += [len(text.encode("utf-8", "surrogatepass")) if text else 0] + [0] * (k - 1)
            sums += [tokens] + [0] * (k - 1)
            checks += [check] + [None] * (k - 1)
            names += [p for p, _ in rest]
            counts += [n for _, n in rest]
        yield pd.DataFrame({"doc_id": pd.array(ids, dtype="Int64"), "text_key": keys, "piece": names, "n": counts, "n_bytes": sizes, "known": sums, "check": pd.array(checks, dtype="Int64")})


def count_tokens(docs: DataFrame, tokenizer_json: str, limit: int = 512, head_pieces: int = HEAD_PIECES, seed: int = 0) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every row of ``docs(doc_id, text)``.

    ``tokenizer_json`` is the content of a byte-level tokenizer file. Pass one
    counts each distinct pre-token of the corpus and encodes it once. Those
    with at least 1/head_pieces of all occurrences, hence at most head_pieces,
    are broadcast, each by NAME_LENGTH characters at most; the rest, of which
    none is frequent, whatever its length, is joined by a shuffle that no key
    can dominate.

    A null or empty text has 0 bytes and tokens; a very long one is counted
    whole. Repeated rows each give a row; a null doc_id stays null, and rows
    that share an id are told apart by 64 bits of their texts' hashes with
    ``seed``; should two texts agree in those, which a second hash tells, the
    query fails rather than count wrong. A text of limit tokens isn't over
    it. Other columns of ``docs`` are ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = small_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of(F.col("text")).alias("text"))
    counts = docs.select("text").mapInPandas(partial(_batch_counts, spec=tokenizer_json), "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    counts = settle(counts.mapInPandas(partial(_encode, spec=tokenizer_json), "piece string, n long, pieces int"), "pieces")
    total = counts.agg(F.sum("n")).first()[0] or 0
    in_head = F.col("n") * F.lit(head_pieces) >= F.lit(total)
    head = spark.sparkContext.broadcast({r.piece: r.pieces for r in counts.filter(in_head).select("piece", "pieces").toLocalIterator()})
    rows = docs.select("doc_id", *text_keys(F.col("text"), seed), "text").mapInPandas(
        partial(_per_document, spec=tokenizer_json, head=head), "doc_id long, text_key long, piece string, n long, n_bytes long, known long, check long"
    )
    tail = counts.filter(~in_head).select("piece", "pieces")
    summed = (
        rows.join(tail, "piece", "left")
        .groupBy("doc_id", "text_key")
        .agg(F.count("check").alias("copies"), F.min("check").alias("lo"), F.max("check").alias("hi"), F.sum("n_bytes").alias("n_bytes"), F.sum(F.col("known") + F.col("n") * F.coalesce("pieces", F.lit(0))).alias("n_tokens"))
    )
    one_text = F.when(F.col("lo") == F.col("hi"), F.col("copies")).otherwise(F.raise_error(F.lit("different texts of one id have the same hash: count with another seed")))
    summed = summed.withColumn("copies", one_text)
    each = summed.select("doc_id", F.expr("n_bytes div copies").alias("n_bytes"), F.expr("n_tokens div copies").alias("n_tokens"), F.explode(F.expr("sequence(1L, copies)")).alias("_copy"))
    return each.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
