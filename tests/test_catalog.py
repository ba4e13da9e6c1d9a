"""Every named query with SQL gives what DuckDB gives, value for value."""

import math
import os

import duckdb
import pytest

from ledgerlens.plans.catalog import QUERIES, SQL


@pytest.fixture(scope="module")
def duck(data):
    connection = duckdb.connect()
    for name in os.listdir(data):
        table = name.removesuffix(".parquet")
        connection.sql(f"create view {table} as select * from '{data}/{name}'")
    return connection


def _plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def _rows(frame, columns):
    rows = [tuple(_plain(v) for v in r) for r in frame[columns].astype(object).itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, data, name):
    result = QUERIES[name](spark, data)
    expected = duck.sql(SQL[name])
    columns = sorted(result.columns)
    assert columns == sorted(expected.columns)
    assert _rows(result.toPandas(), columns) == _rows(expected.df(), columns)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
