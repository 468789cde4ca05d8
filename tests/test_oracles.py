"""Every query that has SQL against DuckDB on the smallest tables; every other one runs."""

import decimal
import os

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


def norm(v):
    if v is None or v != v:
        return None
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v else "0"
    if isinstance(v, float):
        return repr(round(v, 9))
    return str(v).replace("+00:00", "")


@pytest.fixture(scope="module")
def duck(folder):
    c = duckdb.connect()
    for f in os.listdir(folder):
        c.sql(f"create view {f.removesuffix('.parquet')} as from '{folder}/{f}'")
    return c


def test_every_statement_has_its_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, duck, name):
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    rows = sorted(tuple(str(norm(r[c])) for c in columns) for r in df.collect())
    if name not in SQL:
        return
    found = duck.sql(SQL[name])
    assert sorted(found.columns) == columns
    at = [found.columns.index(c) for c in columns]
    assert rows == sorted(tuple(str(norm(r[i])) for i in at) for r in found.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
