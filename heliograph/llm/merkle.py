"""Merkle fixity audit of WARC records.

Records are hashed; a leaf covers an ordered range of record offsets, an
inner node an ordered range of leaves. Two replicas are compared from the
root; only branches that differ are descended, down to the records of the
differing ranges. All of it is DataFrame operations, and no level is collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph.llm.common import discard, settle

#: Record offsets of a leaf, and children of an inner node.
RANGE, FANOUT = 64, 16
#: Digits of a digest by which the records of one offset are put into ranges, should an offset have many.
DIGITS = 3


def record_text(url: Column, payload: Column) -> Column:
    """A WARC/1.1 response record without its closing line ends. Null counts as empty."""
    body = F.coalesce(payload, F.lit(""))
    to = F.coalesce(url, F.lit(""))
    h = F.md5(F.concat(to, F.lit("\n"), body))
    ident = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), to,
        F.lit("\r\nWARC-Record-ID: <urn:uuid:"), ident,
        F.lit(">\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"), body,
    )


def write_warc(records: DataFrame, path: str) -> None:
    """Files of the records of ``records(offset, record)`` in ascending order of offset. Null records are empty ones."""
    rows = records.repartitionByRange("offset").sortWithinPartitions("offset").select(F.coalesce("record", F.lit("")).alias("record"))
    rows.write.option("lineSep", "\r\n\r\n").text(path)


def _records(content: bytes) -> Iterator[tuple[int, bytes]]:
    """(byte offset, record) of each record; where one isn't well formed, the rest of the file is one record."""
    at = 0
    while at < len(content):
        head = content.find(b"\r\n\r\n", at)
        length = [x[15:].strip() for x in content[at : max(head, at)].split(b"\r\n") if x.lower().startswith(b"content-length:")]
        if not content.startswith(b"WARC/", at) or head < 0 or len(length) != 1 or not length[0].isdigit():
            yield at, content[at:]
            return
        end = head + 4 + int(length[0])
        yield at, content[at:end]
        at = end + 4 if content.startswith(b"\r\n\r\n", end) else end


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for path, content in zip(b["path"], b["content"]):
            yield pd.DataFrame([(path, at, r) for at, r in _records(content)], columns=["file", "offset", "record"])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """file, offset (in bytes) and record (bytes, without its closing line ends) of uncompressed WARC files. A file is read by one task, as a whole."""
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(_parse, "file string, offset long, record binary")


def digests(records: DataFrame) -> DataFrame:
    """offset, digest (sha256 of the record) and copies of ``records(offset, record)``; rows that agree in both are one."""
    return records.select(F.col("offset").cast("bigint").alias("offset"), F.sha2(F.coalesce(F.col("record").cast("binary"), F.lit("").cast("binary")), 256).alias("digest")).groupBy("offset", "digest").agg(F.count("*").alias("copies"))


def _branch(offset: Column) -> Column:
    """The leaf of an offset; records without an offset share leaf -1, below which nothing else lies but negative offsets."""
    return F.coalesce(F.floor(offset / F.lit(RANGE)), F.lit(-1)).cast("bigint")


def _ordered(rows: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """keys and hash: that of each group's values in ascending order of ``order``."""
    entry = F.struct(F.col(order).alias("o"), F.col(value).alias("v"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda x: F.concat_ws(":", F.coalesce(x["o"].cast("string"), F.lit("none")), x["v"].cast("string"))), ",")
    return rows.groupBy(*keys).agg(F.sha2(text, 256).alias("hash"))


def leaves(held: DataFrame) -> DataFrame:
    """node and hash for each range of offsets.

    A leaf hashes its offsets' hashes in ascending order, at most RANGE and
    one for records without an offset. An offset's hash covers its records
    in the order of their digests, by way of ranges of digests: an offset
    that many different records share, such as null, is in no list as a whole.
    """
    ranges = _ordered(held.withColumn("range", F.substring("digest", 1, DIGITS)), ["offset", "range"], "digest", "copies")
    offsets = _ordered(ranges, ["offset"], "range", "hash")
    return _ordered(offsets.withColumn("node", _branch(F.col("offset"))), ["node"], "offset", "hash")


def tree(held: DataFrame) -> list[DataFrame]:
    """The levels (node, hash), leaves first, up to one with the root alone. A node's children are FANOUT at most."""
    levels = [settle(leaves(held), "leaves")]
    while True:
        n = levels[-1].agg(F.min("node").alias("lo"), F.max("node").alias("hi")).first()
        if n.lo is None or n.lo == n.hi or (n.lo, n.hi) == (-1, 0):
            break
        levels.append(settle(_parents(levels[-1], F.floor(F.col("node") / F.lit(FANOUT)).cast("bigint")), "level"))
    levels.append(settle(_parents(levels[-1], F.lit(0).cast("bigint")), "root"))
    return levels


def _parents(level: DataFrame, parent: Column) -> DataFrame:
    return _ordered(level.withColumn("up", parent), ["up"], "node", "hash").withColumnRenamed("up", "node")


def differing(a: list[DataFrame], b: list[DataFrame], compared: list[int] | None = None) -> DataFrame:
    """The leaves in which two trees differ, found by descending differing branches only.

    ``compared``, if given, gets the number of nodes compared on each level, from the top.
    """
    height = max(len(a), len(b))
    found = None
    for k in range(height - 1, -1, -1):
        # A lower tree's root stands for its missing upper levels, so those always differ.
        if k >= min(len(a), len(b)) - 1 and len(a) != len(b):
            continue
        x, y = (t[k].select("node", F.col("hash").alias(n)) for t, n in ((a, "x"), (b, "y")))
        if found is not None:
            up = F.lit(0).cast("bigint") if k == height - 2 else F.floor(F.col("node") / F.lit(FANOUT)).cast("bigint")
            below = found.select(F.col("node").alias("up"))
            x, y = (t.withColumn("up", up).join(below, "up", "left_semi").drop("up") for t in (x, y))
        both = x.join(y, "node", "full")
        if compared is not None:
            compared.append(both.count())
        found = settle(both.filter(~F.col("x").eqNullSafe(F.col("y"))).select("node"), "differing")
    return found


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """offset, range_id, sha256 and status of every offset in ``primary(offset, record)`` or ``replica(offset, record)``.

    status is intact, corrupt (both have the offset, with other records),
    missing (not in the replica) or extra (not in the primary). sha256 is
    that of the primary's record, the least if it has several, null for
    extra ones. Null offsets are one offset of its own; a null record is an
    empty one; a very long one is hashed whole. Repeated rows count: an
    offset with other numbers of copies is corrupt. Other columns are
    ignored; two empty tables give no rows.
    """
    a, b = settle(digests(primary), "primary"), settle(digests(replica), "replica")
    x, y = tree(a), tree(b)
    where = differing(x, y)
    discard(*x, *y)
    near = lambda t, name: t.withColumn("node", _branch(F.col("offset"))).join(where, "node", "left_semi").select("offset", "digest", F.col("copies").alias(name))
    x, y = near(a, "x"), near(b, "y").select(F.col("offset").alias("o"), F.col("digest").alias("d"), "y")
    both = x.join(y, x["offset"].eqNullSafe(y["o"]) & (x["digest"] == y["d"]), "full")
    both = both.withColumns({"at": F.when(F.col("x").isNotNull(), F.col("offset")).otherwise(F.col("o"))})
    bad = both.groupBy("at").agg(F.count("x").alias("in_x"), F.count("y").alias("in_y"), F.count_if(~F.col("x").eqNullSafe(F.col("y"))).alias("off")).filter("off > 0")
    bad = bad.select(F.col("at").alias("o"), F.when(F.col("in_y") == 0, "missing").when(F.col("in_x") == 0, "extra").otherwise("corrupt").alias("found"))
    held = a.groupBy("offset").agg(F.min("digest").alias("sha256"))
    rows = held.join(bad, held["offset"].eqNullSafe(bad["o"]), "left").select("offset", "sha256", F.coalesce("found", F.lit("intact")).alias("status"))
    extra = bad.filter("found = 'extra'").select(F.col("o").alias("offset"), F.lit(None).cast("string").alias("sha256"), F.lit("extra").alias("status"))
    return rows.unionByName(extra).select("offset", _branch(F.col("offset")).alias("range_id"), "sha256", "status")
