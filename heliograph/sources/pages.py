"""Pages over HTTP as a Spark data source, in batch and as a stream.

``spark.read.format("http_pages")`` reads the addresses of a table and gives
url, status, html and tries. A partition holds the addresses of some hosts,
so a host is asked by one task alone, at its own pace; a task that fails asks
again for its own hosts only. As a stream, each batch takes the next files
of a folder of addresses.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from urllib.parse import urlsplit
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from heliograph.sources.fetch import TIMEOUT, get

SCHEMA = "url string, status int, html string, tries int"
#: Statuses after which an address is asked again: no answer, too many requests, and errors of the server.
AGAIN = (0, 408, 429, 500, 502, 503, 504)


class Hosts(InputPartition):
    """The addresses of some hosts, those of a host together."""

    def __init__(self, urls: list[str]):
        super().__init__(crc32("\n".join(urls).encode()))
        self.urls = urls


def host_of(url: str) -> str:
    return urlsplit(url).netloc.lower()


def dealt(urls: list[str], parts: int) -> list[list[str]]:
    """Distinct addresses in at most ``parts`` lists; a host is in one of them, and the lists are of like length."""
    hosts: dict[str, list[str]] = {}
    for u in sorted(set(urls)):
        hosts.setdefault(host_of(u), []).append(u)
    lists: list[list[str]] = [[] for _ in range(min(parts, len(hosts)))]
    for _, own in sorted(hosts.items(), key=lambda x: (-len(x[1]), x[0])):
        min(lists, key=len).extend(own)
    return lists


def fetched(urls: list[str], tries: int, pause: float, wait: float, timeout: float) -> Iterator[tuple[str, int, str | None, int]]:
    """(url, status, html, tries) of addresses, with ``pause`` seconds between requests to a host and twice as long a wait after each failure."""
    last: dict[str, float] = {}
    for url in urls:
        host = host_of(url)
        for n in range(1, tries + 1):
            time.sleep(max(0.0, last.get(host, 0.0) + pause - time.monotonic()))
            status, html = get(url, timeout)
            last[host] = time.monotonic()
            if status not in AGAIN or n == tries:
                break
            time.sleep(wait * 2 ** (n - 1))
        yield url, status, html, n


class PageReader(DataSourceReader):
    def __init__(self, urls: list[str], options: dict):
        self.urls, self.parts = urls, int(options.get("parts", 8))
        self.how = int(options.get("tries", 3)), float(options.get("pause", 0.0)), float(options.get("wait", 0.5)), float(options.get("timeout", TIMEOUT))

    def partitions(self) -> list[Hosts]:
        return [Hosts(x) for x in dealt(self.urls, self.parts)] or [Hosts([])]

    def read(self, partition: Hosts) -> Iterator[tuple]:
        return fetched(partition.urls, *self.how)


class HttpPages(DataSource):
    """Options: urls, one address a line, at most MOST of them; parts, tries, pause, wait, timeout."""

    @classmethod
    def name(cls) -> str:
        return "http_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageReader:
        return PageReader([u for u in self.options.get("urls", "").split("\n") if u], self.options)


#: Addresses that one read takes, as they go by way of the driver; more are read in turns.
MOST = 50_000


def read_pages(spark: SparkSession, urls: list[str], **options) -> DataFrame:
    """url, status, html and tries of up to MOST addresses, such as those of a front page or of a batch."""
    if len(urls) > MOST:
        raise ValueError(f"{len(urls)} addresses; take at most {MOST} at a time, or stream_pages()")
    spark.dataSource.register(HttpPages)
    return spark.read.format("http_pages").options(**{k: str(v) for k, v in options.items()}).option("urls", "\n".join(urls)).load()


def stream_pages(rows: DataFrame, folder: str, checkpoint: str, parts: int = 8, **options):
    """Starts a query that fetches the addresses of a stream ``rows(url)`` as they come and appends pages to Parquet under ``folder``.

    The offsets are those of the stream of addresses. Each batch deals its
    addresses by host; its pages are written in one folder, which a batch
    that is run again replaces, so no page is kept twice. Batches have no
    bound but that of the stream's source.
    """
    import pandas as pd
    from pyspark.sql import functions as F

    how = int(options.get("tries", 3)), float(options.get("pause", 0.0)), float(options.get("wait", 0.5)), float(options.get("timeout", TIMEOUT))

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame(list(fetched(b["url"].tolist(), *how)), columns=["url", "status", "html", "tries"])

    def step(batch: DataFrame, number: int) -> None:
        urls = batch.filter(F.col("url").isNotNull()).select("url").distinct()
        host = F.lower(F.regexp_extract("url", "://([^/?#]*)", 1))
        pages = urls.repartition(parts, host).sortWithinPartitions("url").mapInPandas(fetch, SCHEMA)
        pages.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return rows.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
