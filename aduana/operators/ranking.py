"""Ordered reports: extremes of the latest period, and short sorted code lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aduana.functions.frames import with_columns


def extremes_of_latest(
    df: DataFrame, value: str, k: int, *, largest: bool, key: str, date: str = "date", drop_null: bool = False
) -> DataFrame:
    """The `k` rows with the largest (smallest) `value` among the rows at the latest date, with a `position`.

    Sorting by date first makes this one distributed top-k: no second pass for the latest date and no join.
    When the latest date has fewer than `k` rows, the top-k also holds older rows; the outer filter removes
    them. The windows only see those `k` rows. Nulls come first in both directions, unless `drop_null`
    leaves them out; NaN counts as the largest value; `key` breaks ties.
    """
    if largest:
        by_value = F.desc_nulls_last(value) if drop_null else F.desc_nulls_first(value)
    else:
        by_value = F.asc_nulls_last(value) if drop_null else F.asc_nulls_first(value)
    top = df.orderBy(F.desc_nulls_last(date), by_value, key).limit(k)
    order = (
        f"{date} DESC NULLS LAST, {value} {'DESC' if largest else 'ASC'} NULLS {'LAST' if drop_null else 'FIRST'}, {key}"
    )
    ranked = with_columns(top, {
        "position": f"row_number() OVER (ORDER BY {order})",
        "_newest": f"max({date}) OVER ()",
    })
    kept = f"{date} = _newest" + (f" AND {value} IS NOT NULL" if drop_null else "")
    return ranked.where(kept).drop("_newest")


def in_display_order(report: DataFrame) -> DataFrame:
    """Last position first, the order a horizontal bar chart draws its rows in."""
    return report.orderBy(F.desc("position"))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """Distinct values in ascending order, nulls first."""
    return df.select(column).dropDuplicates([column]).orderBy(column)


def column_to_list(small: DataFrame, column: str) -> list:
    """One column of a short, already reduced frame as a Python list. All of it goes to the driver: reduce it first."""
    return [row[0] for row in small.select(column).collect()]
