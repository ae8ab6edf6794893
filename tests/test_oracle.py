"""Every registered query against its SQL, value by value."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from lavra.plans.sales import QUERIES
from oracles import ORACLES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def ordered(columns, rows):
    places = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(r[i] for i in places) for r in rows), key=str)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    answer = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(answer.columns)
    got = ordered(df.columns, [tuple(r) for r in df.collect()])
    assert got == ordered(list(answer.columns), answer.fetchall())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
