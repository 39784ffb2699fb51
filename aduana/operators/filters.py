"""Row filters over a fact table. All of them are plain predicates that reach the Parquet scan."""

from __future__ import annotations

from datetime import datetime as Moment

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aduana.functions.codes import starts_with
from aduana.functions.dates import ntz
from aduana.functions.frames import quoted

IMPORTS, EXPORTS = 1, 2

LEVEL_COLUMNS = {"hts": "hts_code", "naics": "naics", "country": "country"}

# Partition column that `write_facts` adds; a date filter also bounds it, so whole folders are skipped.
YEAR_PARTITION = "date_year"

# Day column that `write_facts` adds: file footers hold its bounds in a form that Spark reads without the data.
DAY_COLUMN = "date_day"


def agricultural_only(facts: DataFrame) -> DataFrame:
    return facts.where("agri_prod = 1")


def with_code_prefix(facts: DataFrame, level: str, prefix: str = "") -> DataFrame:
    """Keep the rows whose code at `level` starts with `prefix`.

    Rows without a code go, also for the empty prefix. The level "total" has no code and keeps every row.
    """
    if level not in LEVEL_COLUMNS:
        return facts
    column = LEVEL_COLUMNS[level]
    if column not in facts.columns:
        raise ValueError(f"level {level!r} needs the column {column!r}, which this source does not have")
    return facts.where(starts_with(column, prefix))


def parse_period(text: str) -> tuple[Moment, Moment] | int | None:
    """Read "", "2024" or "2024-01-01+2024-12-31"."""
    if not text:
        return None
    parts = text.split("+")
    if len(parts) == 1:
        return int(text)
    if len(parts) == 2:
        first, last = (Moment.strptime(part, "%Y-%m-%d") for part in parts)
        return first, last
    raise ValueError(f'Invalid period {text!r}: give "YYYY" or "YYYY-MM-DD+YYYY-MM-DD"')


def in_period(facts: DataFrame, text: str) -> DataFrame:
    """Keep one calendar year, or a range that is closed at midnight of both days.

    A year becomes a half-open range, because `year(date) = y` would not be pushed to the scan.
    """
    period = parse_period(text)
    if period is None:
        return facts
    if isinstance(period, int):
        first_year = last_year = period
        if 1 <= period < 9999:
            kept = f"date >= {ntz(f'{period:04d}-01-01')} AND date < {ntz(f'{period + 1:04d}-01-01')}"
        else:
            kept = f"year(date) = {period}"
    else:
        first, last = period
        first_year, last_year = first.year, last.year
        kept = f"date BETWEEN {ntz(first.isoformat(' '))} AND {ntz(last.isoformat(' '))}"
    if YEAR_PARTITION in facts.columns:
        kept += f" AND {YEAR_PARTITION} BETWEEN {first_year} AND {last_year}"
    return facts.where(kept)


def classified(facts: DataFrame) -> DataFrame:
    """Keep imports and exports that have a product code."""
    return facts.where(f"hts_code IS NOT NULL AND trade_id IN ({IMPORTS}, {EXPORTS})")


def latest_period(df: DataFrame, date: str = "date") -> DataFrame:
    """Rows at the greatest date. The side that is broadcast is a global aggregate: exactly one row.

    The maximum is taken over whole rows, which begin with the date: so both sides have the same plan below it, and Spark
    reuses the last shuffle of `df` instead of computing it from the source a second time.
    """
    rest = [F.col(quoted(f.name)) for f in df.schema if f.name != date and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    newest = df.agg(F.max(F.struct(F.col(quoted(date)).alias("newest"), *rest))["newest"].alias("newest"))
    return df.join(F.broadcast(newest), F.col(quoted(date)) == F.col("newest"), "left_semi")
