"""Compare a query with its DuckDB SQL the way the driver does: names, rows, values."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(_plain(row[i]) for i in order) for row in rows)


# SQL type names by Spark type name.
_TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE",
}


def compare_types(df, connection, sql: str) -> list[str]:
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    theirs = {row[0]: row[1] for row in described}
    return [
        f"{name}: {kind} != {theirs.get(name)}"
        for name, kind in df.dtypes
        if _TYPES.get(kind) != theirs.get(name)
    ]


def compare(df, connection, sql: str) -> list[str]:
    """Differences between the Spark result and the SQL result; empty if they agree."""
    spark_names, spark_rows = table(df.columns, [tuple(r) for r in df.collect()])
    cursor = connection.execute(sql)
    sql_names, sql_rows = table([c[0] for c in cursor.description], cursor.fetchall())
    if spark_names != sql_names:
        return [f"columns {spark_names} != {sql_names}"]
    problems = []
    if len(spark_rows) != len(sql_rows):
        problems.append(f"rows {len(spark_rows)} != {len(sql_rows)}")
    if spark_rows != sql_rows:
        for mine, theirs in zip(spark_rows, sql_rows):
            if mine != theirs:
                problems.append(f"first difference {mine} != {theirs}")
                break
    return problems
