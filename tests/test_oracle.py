"""Every registered query against its DuckDB oracle on sf0.001."""

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "benchmark"]


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        return f"{v:.6g}"
    if isinstance(v, decimal.Decimal):
        return f"{v:.6f}"
    if isinstance(v, dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S")
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    srows = sdf.collect()
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert _rows(sdf.columns, srows) == _rows(dcols, drows)


def test_every_query_has_an_oracle():
    from lakestar.plans import catalog

    assert set(catalog.queries()) == set(catalog.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["category", "revenue"] and df.count() == 7
