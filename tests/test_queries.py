"""Every registered query against its SQL twin, and a row check for the rest."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, normal

QUERIES, TWINS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return con


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == pytest.approx(b, rel=1e-9, abs=1e-6)
    return a == b


@pytest.mark.parametrize("name", sorted(TWINS))
def test_twin(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    names, rows = normal(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(TWINS[name])
    want_names, want = normal([d[0] for d in cur.description], cur.fetchall())
    assert names == want_names
    assert len(rows) == len(want)
    for got, exp in zip(rows, want):
        assert all(same(a, b) for a, b in zip(got, exp)), (got, exp)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(TWINS)))
def test_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_every_twin_has_a_query():
    assert set(TWINS) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
