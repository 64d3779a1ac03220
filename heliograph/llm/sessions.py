"""Sessions of users whose events arrive late, as versions that retract one another.

Within a block of a user's time, events are activated batch by batch in a
union-find: an event is united with the active event before it and those
after it that lie within the gap. A root carries its session's extent,
counts, sum and standing versions. After a batch every session that got an
event is a new version, and retracts the versions that stood for its parts.

No user is worked on in one piece. Time is cut into a grid; a session that
comes no nearer to a border of its block than the gap is resolved there.
What the other sessions were after each batch goes on as events with an
extent to a grid ``GROW`` times as wide, of which the same is done, until
none is left. A session passes at most one row on for each of its versions.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliograph.llm.common import discard, settle

GAP = 240
#: Seconds of a block of the first grid, and how much wider each next grid is. Grids are nested.
SPAN, GROW = 1 << 14, 16
#: Added to times, so that no time in use is a border of many grids.
_ORIGIN = 0x15555555555
_IN = ["user", "block", "batch", "start_s", "end_s", "n", "h"]
_OUT = "user long, batch long, start_s long, end_s long, n_events long, n_new long, n_retracted long, h_sum long, h_new long, retracted_batch long, retracted_start_s long, open boolean"


def resolve(batch: list, start: list, end: list, n: list, h: list, gap: int) -> list[list]:
    """All versions of the sessions of one block, with the final session of each.

    Events come in order of (start, end); each is an extent that got n events
    with sum h in its batch. A version is [batch, start, end, events, new,
    retracted, sum, new sum, retracting batch, retracting start, final start,
    final end].
    """
    m = len(start)
    order = sorted(range(m), key=lambda x: (batch[x], x))
    # Neighbours among the active at the time of activation: those left when later ones are taken out of the full list again.
    before, after, active = list(range(-1, m - 1)), list(range(1, m + 1)), [-1] * m
    for x in reversed(order):
        active[x] = p = before[x]
        if p >= 0:
            after[p] = after[x]
        if after[x] < m:
            before[after[x]] = p
    above, low, high, last = list(range(m)), list(start), list(end), list(range(m))
    count, total, new, new_h, stands = [0] * m, [0] * m, list(n), list(h), [[] for _ in range(m)]
    following, first = [m] * m, m
    versions: list[list] = []

    def root(x: int) -> int:
        while above[x] != x:
            above[x] = x = above[above[x]]
        return x

    def unite(x: int, y: int) -> int:
        if len(stands[x]) < len(stands[y]):
            x, y = y, x
        above[y] = x
        low[x], high[x], last[x] = min(low[x], low[y]), max(high[x], high[y]), max(last[x], last[y])
        for kept in (count, total, new, new_h):
            kept[x] += kept[y]
        stands[x] += stands[y]
        stands[y] = []
        return x

    i = 0
    while i < m:
        now, j = batch[order[i]], i
        while j < m and batch[order[j]] == now:
            x, p = order[j], active[order[j]]
            if p < 0:
                following[x], first = first, x
            else:
                following[x], following[p] = following[p], x
            r = x
            if p >= 0 and start[x] - high[root(p)] <= gap:
                r = unite(x, root(p))
            while (y := following[last[r]]) < m and start[y] - high[r] <= gap:
                r = unite(r, root(y))
            j += 1
        for r in dict.fromkeys(root(x) for x in order[i:j]):
            count[r] += new[r]
            total[r] += new_h[r]
            for v in stands[r]:
                versions[v][8:10] = now, low[r]
            versions.append([now, low[r], high[r], count[r], new[r], len(stands[r]), total[r], new_h[r], None, None, r, None])
            stands[r], new[r], new_h[r] = [len(versions) - 1], 0, 0
        i = j
    for v in versions:
        r = root(v[10])
        v[10:12] = low[r], high[r]
    return versions


def _resolved(batches: Iterator[pd.DataFrame], gap: int, span: int) -> Iterator[pd.DataFrame]:
    """Versions by block, of rows sorted by user, block and time; ``open`` if the final session comes within the gap of a border."""
    held: list[pd.DataFrame] = []

    def versions(f: pd.DataFrame) -> pd.DataFrame:
        out = []
        keys = f[["user", "block"]].to_numpy()
        cuts = [0, *((keys[1:] != keys[:-1]).any(axis=1).nonzero()[0] + 1).tolist(), len(f)]
        columns = [f[c].tolist() for c in _IN[2:]]
        for i, z in zip(cuts, cuts[1:]):
            left = int(keys[i, 1]) * span - _ORIGIN
            for *v, low, high in resolve(*(c[i:z] for c in columns), gap=gap):
                out.append((int(keys[i, 0]), *v, low - gap < left or high + gap >= left + span))
        frame = pd.DataFrame(out, columns=[x.split()[0] for x in _OUT.split(", ")])
        return frame.astype({"retracted_batch": "Int64", "retracted_start_s": "Int64"})

    for b in batches:
        if not len(b):
            continue
        keys = b[["user", "block"]].to_numpy()
        whole = int((keys != keys[-1]).any(axis=1).sum())  # rows are sorted: those before the last block of this batch
        if whole or held and (held[-1][["user", "block"]].to_numpy()[-1] != keys[0]).any():
            yield versions(pd.concat([*held, b.iloc[:whole]]))
            held = []
        held.append(b.iloc[whole:])
    if held:
        yield versions(pd.concat(held))


def versions(events: DataFrame, gap: int = GAP, span: int = SPAN) -> DataFrame:
    """Every version of every session: user, batch, start_s, end_s, n_events, n_new, n_retracted, h_sum, retracted_batch, retracted_start_s.

    ``events`` has whole numbers user, batch, second and value; batches take
    effect in ascending order, whatever the order of rows. Events of a user
    at most ``gap`` seconds apart share a session. A session with an event
    of a batch is a new version and retracts the standing ones it contains;
    the last two columns are the batch and start of what retracts it, null
    if it stands at the end. h_sum adds up the values, nulls as 0. Events
    with a null user, batch or second are left out; repeated rows and ties
    each count; other columns are ignored; an empty table gives no rows.
    """
    rows = events.select(*(F.col(c).cast("bigint").alias(c) for c in ("user", "batch")), F.col("second").cast("bigint").alias("start_s"), F.coalesce(F.col("value").cast("bigint"), F.lit(0)).alias("h"))
    rows = rows.dropna(subset=["user", "batch", "start_s"]).groupBy("user", "batch", "start_s").agg(F.count("*").alias("n"), F.sum("h").alias("h"))
    rows, done, before = rows.withColumn("end_s", F.col("start_s")), [], None
    while True:
        blocks = rows.withColumn("block", F.expr(f"floor((start_s + {_ORIGIN}L) / {span})")).select(*_IN)
        dealt = blocks.repartition("user", "block").sortWithinPartitions("user", "block", "start_s", "end_s", "batch")
        found = settle(dealt.mapInPandas(partial(_resolved, gap=gap, span=span), _OUT), "versions")
        if before is not None:
            discard(before)
        last = span > 1 << 50
        done.append(found if last else found.filter("not open"))
        before = settle(found.filter("open").select("user", "batch", "start_s", "end_s", F.col("n_new").alias("n"), F.col("h_new").alias("h")), "open")
        if last or before.isEmpty():
            break
        rows, span = before, span * GROW
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("h_new", "open")


def standing(found: DataFrame, batch: int | None = None) -> DataFrame:
    """Of versions(), those that stand after ``batch``, or after all."""
    if batch is None:
        return found.filter("retracted_batch is null")
    return found.filter((F.col("batch") <= batch) & (F.col("retracted_batch").isNull() | (F.col("retracted_batch") > batch)))
