"""Every catalogued query against its DuckDB twin, on the smallest tables."""

import datetime
import decimal
import os

import duckdb
import pytest

from lodestrata.plans.registry import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")


def plain(v):
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, decimal.Decimal):
        return str(int(v)) if v == int(v) else str(v)
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        if name.endswith(".parquet"):
            path = f"{DATA}/{name}" + ("/*.parquet" if os.path.isdir(f"{DATA}/{name}") else "")
            con.execute(f"create view {name.removesuffix('.parquet')} as select * from read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    run = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in run.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in run.fetchall())


def test_every_twin_has_a_query():
    assert set(ORACLE_SQL) <= set(QUERIES)
