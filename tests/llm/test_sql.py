"""The queries that SQL can express, against DuckDB on whole tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tidemart.llm import queries

from .data import SF


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def _canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([(type(r[i]).__name__, r[i]) for i in order] for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(queries.all_sql()))
def test_query_equals_sql(spark, duck, name):
    df = queries.all_queries()[name](spark, SF)
    found = duck.execute(queries.all_sql()[name])
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon([d[0] for d in found.description], found.fetchall())


def test_registered():
    names = set(entry.queries())
    assert {n.partition("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and set(queries.all_sql()) <= set(entry.oracle_sql())
