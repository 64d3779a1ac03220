"""Fetching pages: at the edge of the engine, never inside a plan that is cheap to repeat."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIMEOUT = 12
AGENT = "Mozilla/5.0 (compatible; heliograph)"


def headers_of(url: str, headers: Mapping[str, Mapping[str, str]]) -> Mapping[str, str]:
    return headers[max(fits, key=len)] if (fits := [p for p in headers if url.startswith(p)]) else {}


def get(url: str, timeout: float = TIMEOUT, headers: Mapping[str, Mapping[str, str]] | None = None) -> tuple[int, str | None]:
    """(status, html) of an http or https address; (0, None) after any failure.

    ``headers`` has what is sent to addresses that start with its keys, the
    longest of which counts.
    """
    from urllib.error import HTTPError
    from urllib.request import Request, urlopen

    if not url.lower().startswith(("http://", "https://")):
        return 0, None
    try:
        with urlopen(Request(url, headers={"User-Agent": AGENT, **headers_of(url, headers or {})}), timeout=timeout) as r:  # noqa: S310
            return r.status, r.read().decode(r.headers.get_content_charset() or "utf-8", "replace")
    except HTTPError as e:
        return e.code, None
    except Exception:  # noqa: BLE001  one bad address must not end the run
        return 0, None


def _fetch(batches: Iterator[pd.DataFrame], opener: Callable[[str], tuple[int, str | None]], threads: int) -> Iterator[pd.DataFrame]:
    with ThreadPoolExecutor(threads) as pool:
        for b in batches:
            found = list(pool.map(opener, b["url"]))
            yield pd.DataFrame({"url": b["url"], "status": [s for s, _ in found], "html": [h for _, h in found]})


def fetch_pages(rows: DataFrame, opener: Callable[[str], tuple[int, str | None]] = get, parts: int = 8, threads: int = 8) -> DataFrame:
    """url, status and html of each distinct url of ``rows(url)``. Results are joined back by url, not by place. Write them down before use: a plan that is run twice fetches twice."""
    urls = rows.filter(F.col("url").isNotNull()).select("url").distinct().repartition(parts, "url")
    return urls.mapInPandas(partial(_fetch, opener=opener, threads=threads), "url string, status int, html string")
