"""Every query of the catalog against its SQL counterpart, on whole tables."""

import datetime
import math

import duckdb
import pytest
from conftest import MEDIUM, SMALL, TABLES

import __spark_entry__ as contract

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6))
    if isinstance(value, datetime.datetime):
        return value.isoformat(" ")
    return str(value)


def table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{MEDIUM}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, MEDIUM)
    ours = table(df.columns, df.collect())
    assert ours[1], "a query over whole tables gives rows"
    if name in ORACLES:
        cursor = duck.execute(ORACLES[name])
        assert ours == table([d[0] for d in cursor.description], cursor.fetchall())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert "EffectiveTo" in df.columns


def test_contract_needs_no_session():
    assert set(ORACLES) <= set(QUERIES)
    assert SMALL in contract.SMOKE_DIR
