"""Compare a Spark result with the SQL result of another engine, value by value."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def sql_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    cursor = connection.execute(sql)
    return [d[0] for d in cursor.description], cursor.fetchall()


def _comparable(value):
    """NaN equals itself here; apart from that values must be identical, doubles to the last bit."""
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, float):
        return float.hex(value + 0.0)
    return value


def as_bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_comparable(row[i]) for i in order) for row in rows)


def differences(df, sql: str, sf_dir: str) -> str:
    """Empty when both results hold the same columns and rows, else a short report."""
    columns, expected = sql_rows(sql, sf_dir)
    if sorted(columns) != sorted(df.columns):
        return f"columns differ: {sorted(set(columns) ^ set(df.columns))}"
    ours, theirs = as_bag(df.columns, df.collect()), as_bag(columns, expected)
    if ours == theirs:
        return "" if ours else "no rows at all"
    missing, extra = theirs - ours, ours - theirs
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())}; {sum(extra.values())} differ, "
        f"e.g. {next(iter(extra), None)} against {next(iter(missing), None)} of {sorted(df.columns)}"
    )
