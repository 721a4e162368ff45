"""Every registered query against its SQL, on whole tables."""

import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as registered

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    assert not any(isinstance(v, Decimal) for v in rows[0])
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_query_matches_sql(spark, tables, name):
    result = registered.queries()[name](spark, SF_DIR)
    expected = tables.execute(registered.oracle_sql()[name])
    columns = [item[0] for item in expected.description]
    assert sorted(result.columns) == sorted(columns)
    want = rows_by_name(columns, expected.fetchall())
    got = rows_by_name(result.columns, [tuple(row) for row in result.collect()])
    assert got == want


def test_every_query_has_sql():
    text = registered.text_queries.queries() if registered.text_queries else {}
    own = set(registered.queries()) - set(text) - {"pipeline"}
    assert own <= set(registered.oracle_sql()) <= set(registered.queries())


def test_entry(spark):
    assert registered.entry(spark).count() > 0
