"""Queries that SQL can express, value by value against DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from lavra.llm.queries import ORACLES, QUERIES

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def ordered(columns, rows):
    places = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(r[i] for i in places) for r in rows), key=str)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    df = QUERIES[name](spark, folder)
    answer = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(answer.columns)
    got = ordered(df.columns, [tuple(r) for r in df.collect()])
    assert got == ordered(list(answer.columns), answer.fetchall())
