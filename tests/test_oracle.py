"""Every registered query equals its DuckDB oracle (exact values) on sf0.001."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from strata.plans.oracle import ORACLES
from strata.plans.queries import QUERIES
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events".split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(rows, cols, order):
    idx = [cols.index(c) for c in order]
    return sorted((tuple(_norm(r[i]) for i in idx) for r in rows), key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    rel = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    assert sorted(sdf.columns) == sorted(ocols)
    order = sorted(ocols)
    assert _rows(sdf.collect(), sdf.columns, order) == _rows(rel.fetchall(), ocols, order)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["city", "TotalOrders", "TotalRevenue"]
    assert df.count() > 0
