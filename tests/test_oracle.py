"""Every registered query against its DuckDB oracle on the smallest scale
(the driver repeats this at sf0.01)."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as E
from tidemart.plans import catalog, oracle

from .conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem").split()


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return ("n", float(v))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, (int, float)):
        return ("n", float(v))
    if isinstance(v, (dt.date, dt.datetime)):
        return ("d", str(v)[:10])
    return ("null", "") if v is None else ("s", str(v))


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(catalog.all_queries()) == set(oracle.all_sql())
    assert set(catalog.all_queries()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(catalog.all_queries()))
def test_query_matches_oracle(spark, duck, name):
    df = catalog.all_queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(oracle.all_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _canon(df.columns, srows) == _canon(dcols, drows)


def test_entry_runs(spark):
    out = E.entry(spark)
    assert out.count() > 0
    assert out.columns == ["store_id", "quarters", "year", "totalrevenue"]
