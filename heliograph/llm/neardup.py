"""Near-duplicates by MinHash with sequential Bayesian verification.

Texts with equal shingle sets are one class, worked on once. Signatures of
the classes are cut into bands; a bucket is the classes that agree in a
band. Every member of a bucket is compared with the bucket's first member
(its pivot) rather than with every other. Then components are found, and
only buckets that still hold several of them are searched in full, in blocks
of bounded size and only across components: a link within a component
changes nothing. So no link that the bands propose is lost, and a bucket of
copies costs as many comparisons as it has members.

A comparison takes the signatures batch by batch and drops a pair once the
posterior probability that it reaches the similarity falls under the miss
probability. Survivors are confirmed on their full sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliograph.llm.common import discard, maybe_among, packed, settle, small_batches, text_of

HASHES, BATCH = 256, 32
#: So many more for the texts of buckets that hold several components, where many pairs come close to the similarity.
MORE_HASHES = 768
MISS = 1e-6
#: Pairs of exactly the asked similarity that no band may propose, at most.
BAND_MISS = 1e-4
#: Members of a block in the search across components.
BLOCK = 512

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 100_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_words = _WordHashes()


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of ``size`` words; of a shorter text, of all its words as one."""
    w = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, w), np.uint64, len(w))
    k = min(size, len(w))
    out = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        out = _mix(out * np.uint64(_GOLD) + h[i : len(w) - k + 1 + i])
    return np.unique(out)


def band_rows(similarity: float, hashes: int = HASHES, miss: float = BAND_MISS) -> int:
    """Most rows in a band such that pairs of that similarity are missed with probability ``miss`` at most."""
    return max([r for r in range(1, 33) if (1 - similarity**r) ** (hashes // r) <= miss], default=1)


def least_matches(similarity: float, hashes: int = HASHES, batch: int = BATCH, miss: float = MISS) -> list[int]:
    """By batch: with fewer matching bytes in all hashes so far, a pair is dropped.

    With a uniform prior, the similarity after m matches of n is Beta(m + 1,
    n - m + 1), and it exceeds t with the probability that of n + 1 trials
    of chance t at most m succeed. Bytes of different minima agree by chance
    once in 256.
    """
    t = similarity + (1 - similarity) / 256
    out = []
    for n in range(batch, hashes + 1, batch):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += math.exp(math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m) + m * math.log(t) + (n + 1 - m) * math.log1p(-t))
        out.append(m)
    return out


def _permutations(seed: int, hashes: int = HASHES) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 31, hashes, dtype=np.uint32) * 2 + 1, rng.integers(0, 1 << 32, hashes, dtype=np.uint32)


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(low, (x[None, i : i + 2048] * a[:, None] + b[:, None]).min(axis=1), out=low)
    return low


def _sign(batches: Iterator[pd.DataFrame], size: int, rows: int, seed: int) -> Iterator[pd.DataFrame]:
    a, b = _permutations(seed)
    bands = HASHES // rows
    salt = _mix(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(_GOLD))
    for batch in batches:
        out = []
        for doc_id, key, text in zip(batch["doc_id"], batch["text_key"], batch["text"]):
            s = shingle_set(text, size)
            if not len(s):
                out.append((doc_id, key, 0, None, None, None, None))
                continue
            n1, n2 = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16, salt=seed.to_bytes(8, "big")).digest(), np.int64).tolist()
            low = signature(s, a, b)
            parts, h = low[: bands * rows].reshape(bands, rows).astype(np.uint64), salt
            for i in range(rows):
                h = _mix(h * np.uint64(_GOLD) + parts[:, i])
            out.append((doc_id, key, len(s), n1, n2, h.view(np.int64), low.astype(np.uint8).tobytes()))
        f = pd.DataFrame(out, columns=["doc_id", "text_key", "n_shingles", "node", "check", "bands", "sig"])
        yield f.astype({"doc_id": "Int64", "node": "Int64", "check": "Int64"})


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, text and text_key of each row."""
    return small_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of(F.col("text")).alias("text")).withColumn("text_key", F.xxhash64("text"))


def signed(docs: DataFrame, size: int, similarity: float, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """(rows, classes), both settled.

    Rows have doc_id, text_key, n_shingles and node; node, the class of equal
    sets, is null without words. A class has node, first_id (its least
    doc_id), and of one of its rows doc_id, text_key, bands and sig.
    """
    rows = _rows(docs)
    for k in range(4):
        made = partial(_sign, size=size, rows=band_rows(similarity), seed=seed + k)
        found = settle(rows.mapInPandas(made, "doc_id long, text_key long, n_shingles long, node long, check long, bands array<long>, sig binary"), "signed")
        one = F.min_by(F.struct("doc_id", "text_key", "bands", "sig"), "text_key").alias("x")
        grouped = found.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.min("check").alias("lo"), F.max("check").alias("hi"), one)
        classes = settle(grouped.select("node", "first_id", (F.col("lo") != F.col("hi")).alias("mixed"), "x.*"), "classes")
        # Classes are told apart by 64 of their digest's 128 bits. That this is enough is checked; else other digests are taken.
        if classes.filter("mixed").isEmpty():
            return found.drop("check"), classes.drop("mixed")
        discard(found, classes)
    raise RuntimeError("digests of different sets agree")


def _survivors(x: np.ndarray, y: np.ndarray, p: np.ndarray, q: np.ndarray, least: list[int]) -> np.ndarray:
    """Which of the pairs (x[p], y[q]) of rows of two byte matrices no batch rules out."""
    at, m = np.arange(len(p)), np.zeros(len(p), np.int32)
    for k, bound in enumerate(least):
        part = slice(k * BATCH, (k + 1) * BATCH)
        m += (x[p[at], part] == y[q[at], part]).sum(axis=1, dtype=np.int32)
        alive = m >= bound
        at, m = at[alive], m[alive]
    return at


def _matrix(column, hashes: int = HASHES) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, hashes)


def _prune(batches: Iterator[pd.DataFrame], least: list[int]) -> Iterator[pd.DataFrame]:
    for b in batches:
        if len(b):
            row = np.arange(len(b))
            yield b[["a", "b"]].iloc[_survivors(_matrix(b["sig_a"]), _matrix(b["sig_b"]), row, row, least)]


def _pruned(pairs: DataFrame, sigs: DataFrame, least: list[int]) -> DataFrame:
    """Of pairs (a, b), those that sequential comparison of signatures leaves."""
    both = pairs.join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a").join(sigs.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b")
    return both.mapInPandas(partial(_prune, least=least), "a long, b long")


def _confirm(batches: Iterator[pd.DataFrame], size: int, similarity: int) -> Iterator[pd.DataFrame]:
    """Pairs whose full sets reach similarity / 1000; neighbouring rows share the set of b."""
    held, s_b = None, None
    for batch in batches:
        a, b = [], []
        for x, y, text_a, text_b in zip(batch["a"], batch["b"], batch["text_a"], batch["text_b"]):
            if held != y:
                held, s_b = y, shingle_set(text_b, size)
            s_a = shingle_set(text_a, size)
            both = len(np.intersect1d(s_a, s_b, assume_unique=True))
            if 1000 * both >= similarity * (len(s_a) + len(s_b) - both):
                a.append(x)
                b.append(y)
        yield pd.DataFrame({"a": a, "b": b}, dtype="int64")


def _texts(nodes: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """node and text of some classes. Of the documents, only those that such a class may come from are shuffled."""
    rows = settle(nodes.join(reps.select("node", "doc_id", "text_key"), "node"), "wanted")
    texts = maybe_among(_rows(docs), F.col("text_key"), rows.select("text_key")).filter("_maybe").drop("_maybe")
    same = rows["doc_id"].eqNullSafe(texts["doc_id"]) & (rows["text_key"] == texts["text_key"])
    # Of repeated rows the least text stands for all.
    found = settle(rows.join(texts, same).groupBy("node").agg(F.min("text").alias("text")), "texts")
    discard(rows)
    return found


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """Of pairs (a, b), those whose full sets reach the similarity; ``texts`` has both sides' texts."""
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return settle(both.mapInPandas(partial(_confirm, size=size, similarity=round(1000 * similarity)), "a long, b long"), "links")


def _are_stars(e: DataFrame) -> bool:
    """Whether every u of the edges (u, v) has one v, and no v is a u."""
    each = e.groupBy("u").agg(F.count("*").alias("n"))
    return each.filter("n > 1").isEmpty() and e.join(each.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, root of every node in edges (a, b): root is the least node reachable. By alternating large and small stars, until nothing but stars is left."""
    e = settle(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _are_stars(e):
        ways = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ways.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = ways.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = settle(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("x"))
        old, e = e, settle(small.select("x.u", "x.v").filter("u <> v").distinct(), "edges")
        discard(old, large)
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _sign_more(batches: Iterator[pd.DataFrame], size: int, seed: int) -> Iterator[pd.DataFrame]:
    a, b = _permutations(seed, MORE_HASHES)
    for batch in batches:
        sets = [shingle_set(t, size) for t in batch["text"]]
        yield pd.DataFrame({"node": batch["node"], "n": [len(s) for s in sets], "more": [signature(s, a, b).astype(np.uint8).tobytes() for s in sets]})


def _across(batches: Iterator[pd.DataFrame], least: list[int], similarity: float) -> Iterator[pd.DataFrame]:
    """Surviving pairs of different components within blocks; the rows come sorted by block."""
    held: list[pd.DataFrame] = []
    none = pd.DataFrame({"a": [], "b": []}, dtype="int64")

    def compared(f: pd.DataFrame) -> pd.DataFrame:
        left, right = f[f["side"] <= 1], f[f["side"] != 1]  # 0: both sides
        own = bool((f["side"] == 0).all())
        x, y = (_matrix(t["sig"], HASHES + MORE_HASHES) for t in (left, right))
        (a, ca, na), (b, cb, nb) = ((t["node"].to_numpy(), t["root"].to_numpy(), t["n"].to_numpy()) for t in (left, right))
        bands_a, bands_b, bucket = np.array(left["bands"].tolist()), np.array(right["bands"].tolist()), f["bucket"].iat[0]
        out = [none]
        for i in range(0, len(a), 64):
            part = slice(i, i + 64)
            short, long = np.minimum(na[part, None], nb[None]), np.maximum(na[part, None], nb[None])
            p, q = np.nonzero((ca[part, None] != cb[None]) & (short >= similarity * long))
            p += i
            if own:
                p, q = p[a[p] < b[q]], q[a[p] < b[q]]
            at = _survivors(x, y, p, q, least)
            p, q = p[at], q[at]
            # A pair that shares several buckets is proposed by the first of them.
            first = (bands_a[p] == bands_b[q]).argmax(axis=1) if len(p) else p
            once = bands_a[p, first] == bucket
            out.append(pd.DataFrame({"a": a[p[once]], "b": b[q[once]]}))
        return pd.concat(out)

    for batch in batches:
        if not len(batch):
            continue
        ids = batch["block"].to_numpy()
        cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
        for i, z in zip(cuts, cuts[1:]):
            if held and held[-1]["block"].iat[-1] != ids[i]:
                yield compared(pd.concat(held))
                held = []
            held.append(batch.iloc[i:z])
    if held:
        yield compared(pd.concat(held))


def _merged(rows: DataFrame, few: DataFrame, on: list[str]) -> DataFrame:
    """rows joined to ``few``, which has a row per key, by a sort-merge join: adaptive execution splits a hot key's rows in that, but not in a broadcast join behind a shuffle."""
    return rows.join(few.hint("merge"), on)


def _mixed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """bucket, node, root of members, pivots apart, of buckets that hold several components."""
    m = members.filter("node <> pivot").select("bucket", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = m.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("bucket")
    return settle(_merged(m, several, ["bucket"]), "mixed")


def _left_over(m: DataFrame, signs: DataFrame, least: list[int], similarity: float, block: int = BLOCK) -> DataFrame:
    """Pairs (a, b) across components within buckets that comparison of signatures leaves. ``signs`` has node, n, bands and sig."""
    # Components that fill blocks of their own, and the rest of each bucket.
    per_root = m.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    per_root = per_root.withColumn("own", F.when(F.col("n") > block, F.col("root")))
    chunks = settle(per_root.groupBy("bucket", "own").agg(F.ceil(F.sum("n") / block).alias("chunks")), "chunks")
    sizes = per_root.select("bucket", "root", "own").join(chunks.withColumnRenamed("own", "o"), ["bucket"]).filter(F.col("own").eqNullSafe(F.col("o"))).select("bucket", "root", "own", "chunks")
    placed = _merged(m, sizes, ["bucket", "root"]).withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks"))
    each = chunks.select("bucket", "own", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)).alias("chunk")).withColumn("name", F.xxhash64("own", "chunk"))
    x, y = each.alias("x"), each.alias("y")
    # Both sides of a pair are chunks, not rows: a bucket of n members has n / block of them.
    pair = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.name") <= F.col("y.name"))).filter(~(F.col("x.own").isNotNull() & F.coalesce(F.col("x.own") == F.col("y.own"), F.lit(False))))
    pair = pair.select(F.col("x.bucket").alias("bucket"), F.col("x.name").alias("p"), F.col("y.name").alias("q"), F.xxhash64("x.bucket", "x.name", "y.name").alias("block"))
    one = F.when(F.col("p") == F.col("q"), F.array(F.struct(F.col("p").alias("name"), F.lit(0).alias("side")))).otherwise(F.array(F.struct(F.col("p").alias("name"), F.lit(1).alias("side")), F.struct(F.col("q").alias("name"), F.lit(2).alias("side"))))
    sides = pair.select("bucket", "block", F.explode(one).alias("s")).select("bucket", "block", "s.name", "s.side")
    rows = placed.withColumn("name", F.xxhash64("own", "chunk")).join(sides, ["bucket", "name"]).select("bucket", "block", "side", "node", "root").join(signs, "node")
    found = rows.repartition("block").sortWithinPartitions("block").mapInPandas(partial(_across, least=least, similarity=similarity), "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def linked(docs: DataFrame, size: int = 5, similarity: float = 0.8, seed: int = 1, block: int = BLOCK) -> DataFrame:
    """doc_id, text_key, n_shingles and component_id of every row of ``docs(doc_id, text)``.

    Two texts are linked if the Jaccard similarity of their sets of
    ``size``-word shingles is at least ``similarity``. A text of fewer words
    has its whole sequence as its one shingle; a null, empty or blank text
    has none and is linked with nothing. component_id is the least doc_id
    that links reach, the own included; nulls are greater than all. text_key
    is xxhash64 of the text. Repeated rows each give a row; other columns
    are ignored; an empty table gives no rows.
    """
    least = least_matches(similarity)
    s, reps = signed(docs, size, similarity, seed)
    bands = reps.select("node", F.explode("bands").alias("bucket"))
    pivots = bands.groupBy("bucket").agg(F.min("node").alias("pivot"), F.count("*").alias("n")).filter("n > 1")
    members = settle(bands.join(pivots, "bucket"), "members")
    pairs = members.filter("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    pairs = settle(_pruned(pairs, reps, least), "pairs")
    ends = lambda t: t.select(F.col("a").alias("node")).union(t.select(F.col("b"))).distinct()
    texts = _texts(ends(pairs), reps, docs)
    links = _confirmed(pairs, texts, size, similarity)
    roots = settle(components(links), "roots")
    discard(pairs, texts, links)
    mixed = _mixed(members.filter("n > 2"), roots)
    if not mixed.isEmpty():
        texts = _texts(mixed.select("node").distinct(), reps, docs)
        more = texts.mapInPandas(partial(_sign_more, size=size, seed=seed + 1000), "node long, n long, more binary")
        signs = settle(more.join(reps.select("node", "bands", "sig"), "node").select("node", "n", "bands", F.concat("sig", "more").alias("sig")), "signs")
        pairs = settle(_left_over(mixed, signs, least_matches(similarity, HASHES + MORE_HASHES), similarity, block), "across")
        stars = roots.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
        links = _confirmed(pairs, texts, size, similarity)
        roots = settle(components(stars.union(links)), "roots")
        discard(texts, signs, pairs, links)
    named = reps.select("node", "first_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = settle(named.select("node", "root").join(first, "root").select("node", "component_id"), "named")
    discard(reps, members, mixed, roots)
    return s.select("doc_id", "text_key", "n_shingles", "node").join(named, "node", "left").select("doc_id", "text_key", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def find_duplicates(docs: DataFrame, size: int = 5, similarity: float = 0.8, **options) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (doc_id = component_id) per row of linked()."""
    return linked(docs, size, similarity, **options).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_first(docs: DataFrame, size: int = 5, similarity: float = 0.8, **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, of one document per component; of rows of equal id and text, one.

    Only rows that may go are shuffled: those whose text is that of a row that isn't kept, or of several rows.
    """
    found = settle(linked(docs, size, similarity, **options).select("doc_id", "text_key", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")), "found")
    per = settle(found.groupBy("doc_id", "text_key").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("copies")).filter("copies > 1 or not kept"), "touched")
    rows = packed(docs, F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text_of(F.col("text"))).alias("text_key"))
    rows = maybe_among(rows, F.col("text_key"), per.select("text_key"))
    asked = rows.filter("_maybe").alias("r").join(per.alias("p"), F.col("r.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("r.text_key") == F.col("p.text_key")), "left")
    untouched = asked.filter(F.col("p.kept").isNull()).select("r.row")
    # Repeated rows may differ in other columns; the least of them by those that can be compared stays.
    order = F.to_json("r.row")
    repeated = asked.filter("p.kept").groupBy("r.doc_id", "r.text_key").agg(F.min_by("r.row", order).alias("row")).select("row")
    return rows.filter("not _maybe").select("row").unionByName(untouched).unionByName(repeated).select("row.*")
