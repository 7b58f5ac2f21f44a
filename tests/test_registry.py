"""Registered queries against their DuckDB twins on sf0.001 (the driver's check, run small)."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF001

TABLES = sorted(f.removesuffix(".parquet") for f in os.listdir(SF001) if f.endswith(".parquet"))

# Slow model-fitting queries are checked by the rows-only path in their own test.
SQL_QUERIES = sorted(E.oracle_sql())


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.12g}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_every_sql_query_has_a_spark_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_flagship(spark):
    rows = E.entry(spark).collect()
    assert {r["pickup_borough"] for r in rows} >= {"AFRICA", "N/A", None}
    assert sum(r["trips"] for r in rows) == 4315


@pytest.mark.parametrize("name", SQL_QUERIES)
def test_query_matches_duckdb(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    rel = duck.sql(E.oracle_sql()[name])
    s_rows, o_rows = [tuple(r) for r in df.collect()], rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(s_rows) == len(o_rows)
    assert _rows(df.columns, s_rows) == _rows(rel.columns, o_rows)
