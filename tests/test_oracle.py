"""Every registered query against the same query in SQL, over whole tables."""

import pytest

import __spark_entry__ as entry_points
from compare import connect, duckdb_rows, spark_rows
from conftest import DATA
from moodmart.workloads.oracle import ORACLE
from moodmart.workloads.queries import QUERIES

FOLDER = f"{DATA}/sf0.01"


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_every_query_is_registered():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    columns, rows = spark_rows(QUERIES[name](spark, FOLDER))
    expected_columns, expected_rows = duckdb_rows(database, ORACLE[name])
    assert columns == expected_columns
    assert len(rows) == len(expected_rows) > 0
    for row, expected in zip(rows, expected_rows):
        assert row == expected


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
