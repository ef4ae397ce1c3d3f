"""Queries against their SQL, on the smallest tables."""

import duckdb
import pytest

from varloom.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels conversations"


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def bag(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([row[i] for i in order]) for row in data)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_its_sql(spark, sql, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = sql.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(expected.columns)
    got = [tuple(r) for r in df.collect()]
    assert got
    assert bag(df.columns, got) == bag(expected.columns, expected.fetchall())
