"""The headlines of each article in order, kept as state while its snapshots arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_SEEN = "url string, headline string, at bigint, ord bigint"
HISTORY = "aid string, change bigint, n bigint, versions array<struct<h:string,u:string,t:timestamp>>, last timestamp"


def _order(seen: dict) -> tuple:
    return seen["at"] is None, seen["at"] or 0, seen["ord"]


class Versions(StatefulProcessor):
    """State of an article: what was first seen at each of its urls (of each url's headlines with same_url), in a list with times in microseconds, and how often its versions changed."""

    def __init__(self, same_url: bool, idle_ms: int | None):
        self.same_url, self.idle_ms = same_url, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getListState("seen", _SEEN)
        self.changes = handle.getValueState("changes", "n bigint")

    @staticmethod
    def _versions(seen: list[dict]) -> list[dict]:
        first: dict[str, dict] = {}
        for s in sorted(seen, key=_order):
            first.setdefault(s["headline"], s)
        return list(first.values())

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = [dict(zip(("url", "headline", "at", "ord"), r)) for r in self.seen.get()] if self.seen.exists() else []
        held = {(s["url"], s["headline"] if self.same_url else None): s for s in before}
        for b in rows:
            for url, headline, at, number in zip(b["url"], b["headline"], b["at"], b["ord"]):
                s = {"url": url, "headline": headline, "at": None if pd.isna(at) else pd.Timestamp(at).value // 1000, "ord": int(number)}
                k = url, headline if self.same_url else None
                if k not in held or _order(s) < _order(held[k]):
                    held[k] = s
        now = sorted(held.values(), key=_order)
        if self.idle_ms is not None:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            newest = max((s["at"] // 1000 for s in now if s["at"] is not None), default=timerValues.getCurrentWatermarkInMs())
            self.handle.registerTimer(newest + self.idle_ms)
        if now == before:
            return
        self.seen.put([(s["url"], s["headline"], s["at"], s["ord"]) for s in now])
        old, new = self._versions(before), self._versions(now)
        if len(new) < 2 or old == new:
            return
        change = 1 + (self.changes.get()[0] if self.changes.exists() else 0)
        self.changes.update((change,))
        times = [None if v["at"] is None else pd.Timestamp(v["at"], unit="us") for v in new]
        told = [{"h": v["headline"], "u": v["url"], "t": t} for v, t in zip(new, times)]
        yield pd.DataFrame({"aid": [key[0]], "change": [change], "n": [len(new)], "versions": [told], "last": pd.Series([times[-1]], dtype="datetime64[ns]")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """An article without news for so long is forgotten; what comes later begins a new history."""
        self.seen.clear()
        self.changes.clear()
        return iter(())

    def close(self) -> None:
        pass


def revision_changes(rows: DataFrame, same_url: bool = False, idle: str | None = None, late: str = "1 hour") -> DataFrame:
    """aid, change (from 1), n, versions(h, u, t) and last: the history of an article each time that it changes and has two headlines at least.

    From a stream of ``rows(aid, url, headline, at, ord)``, ``at`` a
    timestamp. The last change of an article is what revision_history() gives
    over all rows, in whatever order they came. With ``idle``, such as
    "30 days", articles without rows are forgotten once the watermark,
    ``late`` behind the latest time, has passed by so much; so state is kept
    for what is still read. Rows without aid, url or headline are left out.
    The query needs the state store of with_rocks().
    """
    rows = rows.filter("aid is not null and headline is not null and url is not null")
    rows = rows.select(F.col("aid").cast("string").alias("aid"), "url", "headline", "at", F.col("ord").cast("bigint").alias("ord"))
    ms = None
    if idle:
        rows = rows.withWatermark("at", late)
        ms = int(pd.Timedelta(idle).total_seconds() * 1000)
    return rows.groupBy("aid").transformWithStateInPandas(Versions(same_url, ms), HISTORY, "Append" if idle else "Update", "EventTime" if idle else "None")


def latest(changes: DataFrame) -> DataFrame:
    """aid, n, versions and last of each article's last change."""
    return changes.groupBy("aid").agg(F.max_by(F.struct("n", "versions", "last"), "change").alias("r")).select("aid", "r.*")
