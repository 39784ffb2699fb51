"""Expressions of this library are Spark SQL text, which composes by formatting and reaches the JVM in one call
per projection instead of one per operator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_columns(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    """Add or replace columns; all expressions see the columns of `df`."""
    return df.withColumns({name: F.expr(text) for name, text in expressions.items()})


def quoted(name: str) -> str:
    """A column name as SQL text, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def unused_name(name: str, df: DataFrame) -> str:
    """`name`, with underscores in front until no column of `df` is called so."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


def require_columns(df: DataFrame, columns: list[str], purpose: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{purpose} needs the columns {missing}, which this source does not have")
