"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from varloom.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = "lineitem orders part"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    import duckdb

    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def bag(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([row[i] for i in order]) for row in data)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_sql(spark, sql, name):
    df = contract.queries()[name](spark, SF_DIR)
    expected = sql.sql(contract.oracle_sql()[name])
    assert sorted(df.columns) == sorted(expected.columns)
    got = [tuple(r) for r in df.collect()]
    assert got, "an empty result checks nothing"
    assert bag(df.columns, got) == bag(expected.columns, expected.fetchall())


def test_entry(spark):
    assert contract.entry(spark).columns == ["chrom", "tsa", "n_variants", "n_known", "n_observations"]
