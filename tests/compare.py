"""Compare a Spark result with DuckDB's: columns by name, rows without order, values exactly."""

from __future__ import annotations

import datetime
import decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duckdb_on(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def _value(value):
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def spark_rows(df: DataFrame) -> list[tuple]:
    names = sorted(df.columns)
    rows = [tuple(_value(row[name]) for name in names) for row in df.collect()]
    return sorted(rows, key=repr)


def sql_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = connection.execute(sql)
    columns = [column[0] for column in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_value(row[i]) for i in order) for row in cursor.fetchall()]
    return sorted(columns), sorted(rows, key=repr)


def difference(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both results are the same, else a short account."""
    columns, wanted = sql_rows(connection, sql)
    if sorted(df.columns) != columns:
        return f"columns {sorted(df.columns)} instead of {columns}"
    got = spark_rows(df)
    if len(got) != len(wanted):
        return f"{len(got)} rows instead of {len(wanted)}"
    wrong = [(a, b) for a, b in zip(got, wanted) if a != b]
    return f"{len(wrong)} rows differ, first: {wrong[0]}" if wrong else None
