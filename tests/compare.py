"""Comparison of a Spark result with DuckDB's, as sorted rows."""

import math
from pathlib import Path

import duckdb


def connect(folder):
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def spark_rows(frame):
    names = sorted(frame.columns)
    return names, sorted(
        (tuple(_plain(row[name]) for name in names) for row in frame.collect()), key=lambda row: tuple(map(repr, row))
    )


def duckdb_rows(connection, sql):
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    order = sorted(names)
    places = [names.index(name) for name in order]
    rows = (tuple(_plain(row[place]) for place in places) for row in result.fetchall())
    return order, sorted(rows, key=lambda row: tuple(map(repr, row)))
