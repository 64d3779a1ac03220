"""Every query that has SQL agrees with DuckDB on the smallest tables."""

import datetime
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from heliograph.plans.registry import ORACLES, QUERIES  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, (datetime.datetime, datetime.date)):
        return str(v)[:10] if str(v)[10:] in ("", " 00:00:00") else str(v)
    return str(v)


def same(df, con, sql):
    r = con.execute(sql)
    theirs = [x[0] for x in r.description]
    assert sorted(df.columns) == sorted(theirs)
    cols = sorted(theirs)
    a = sorted(tuple(plain(row[c]) for c in cols) for row in df.collect())
    b = sorted(tuple(plain(dict(zip(theirs, row))[c]) for c in cols) for row in r.fetchall())
    assert a == b


@pytest.fixture(scope="session")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees(spark, sf, con, name):
    same(QUERIES[name](spark, sf), con, ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(QUERIES) <= set(e.queries()) and set(ORACLES) <= set(e.oracle_sql())
