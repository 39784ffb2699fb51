"""Unit-price series per HS4 heading.

The windows run over rolled-up frames, so one window group holds one row per period (by heading) or one row
per heading (by period), whatever the number of customs records behind it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aduana.functions.codes import code_prefix
from aduana.functions.dates import month_start, quarter_start
from aduana.functions.frames import with_columns
from aduana.functions.numbers import float_divide, one_if_zero, percent_change, sum_or_zero

DIRECTIONS = ("imports", "exports")

SERIES = "PARTITION BY hs4 ORDER BY date"


def unit_prices(product_rollup: DataFrame, period: str, *, cluster_by: tuple[str, ...] = ("hs4",)) -> DataFrame:
    """Value per quantity by (year, `period`, hs4) out of a product-level rollup; `period` is "qtr" or "month".

    A product line without quantity counts as one unit, before the lines of a heading are added up.

    The rollup is shuffled by `cluster_by` (some of the three keys), which serves the aggregation here as well as
    a window over the same columns that follows: one shuffle instead of two. A group then holds the products of one
    heading (or period) over time, a size set by the classification and not by the number of records.
    """
    start = quarter_start if period == "qtr" else month_start
    sums = [F.sum(d).alias(d) for d in DIRECTIONS]
    sums += [F.expr(f"double({sum_or_zero(one_if_zero(f'{d}_qty'))})").alias(f"{d}_qty") for d in DIRECTIONS]
    headings = with_columns(product_rollup, {"hs4": code_prefix("hts_code", 4)}).repartition(*cluster_by)
    return with_columns(
        headings.groupBy("year", period, "hs4").agg(*sums),
        {f"price_{d}": float_divide(f"double({d})", f"{d}_qty") for d in DIRECTIONS} | {"date": start("year", period)},
    )


def _add_change(prices: DataFrame, earlier: str) -> DataFrame:
    """Change against the price that `earlier`, a window expression of a price column, finds.

    The earlier price is a column of its own first, so that each window function is evaluated once.
    """
    found = with_columns(prices, {f"_earlier_{d}": earlier.format(f"price_{d}") for d in DIRECTIONS})
    changed = with_columns(found, {
        f"price_{d}_yoy": percent_change(f"price_{d}", f"_earlier_{d}") for d in DIRECTIONS
    })
    return changed.drop(*(f"_earlier_{d}" for d in DIRECTIONS))


def add_row_change(prices: DataFrame, rows: int) -> DataFrame:
    """Percentage change against the price `rows` rows earlier in the heading's own series.

    The lag counts rows, not calendar periods; a row without a date sorts first and counts as a row.
    """
    return _add_change(prices, f"lag({{0}}, {rows}) OVER ({SERIES})")


def _a_year_before(value: str, period: str) -> str:
    """The value of the same period one calendar year earlier; null when that period is missing.

    A value-based window frame finds the earlier row, so it takes one shuffle and no self-join.
    """
    per_year = {"qtr": 4, "month": 12}[period]
    slot = f"year * {per_year} + {period}"
    frame = f"PARTITION BY hs4 ORDER BY {slot} RANGE BETWEEN {per_year} PRECEDING AND {per_year} PRECEDING"
    # Rows without a date are each other's frame; they have no earlier period.
    return f"if(year IS NULL, NULL, first({value}) OVER ({frame}))"


def add_calendar_change(prices: DataFrame, period: str) -> DataFrame:
    """Percentage change against the same period one calendar year earlier; null when that period is missing."""
    return _add_change(prices, _a_year_before("{0}", period))


def add_market_rank(prices: DataFrame) -> DataFrame:
    """Rank of each heading within its month by unit price, highest price first; equal prices share a rank."""
    return with_columns(prices, {
        f"rank_{d}": f"rank() OVER (PARTITION BY year, month ORDER BY price_{d} DESC)" for d in DIRECTIONS
    })


def add_rolling_statistics(prices: DataFrame, rows: int = 3, sigmas: float = 2.0, months: bool = False) -> DataFrame:
    """Mean, sample standard deviation and price band over the last `rows` rows of each heading, or, with `months`, over
    its last `rows` calendar months.

    All four are null until the heading has `rows` rows; with `months`, wherever one of the months is missing, and in rows
    without a date. The band is mean ± `sigmas` standard deviations.
    """
    frame, present = f"{SERIES} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW", "count(1) OVER ({0})"
    if months:
        # The frame reaches back in month numbers, so the count tells how many of the months are there.
        frame = f"PARTITION BY hs4 ORDER BY year * 12 + month RANGE BETWEEN {rows - 1} PRECEDING AND CURRENT ROW"
        present = "if(year IS NULL, 0, count(1) OVER ({0}))"
    names = [f"price_{d}" for d in DIRECTIONS]
    moving = {"_rows": present.format(frame)}
    for price in names:
        moving[f"_{price}_mean"] = f"avg({price}) OVER ({frame})"
        moving[f"_{price}_std"] = f"stddev_samp({price}) OVER ({frame})"
    statistics, bands = {}, {}
    for price in names:
        statistics |= {f"{price}_{s}": f"if(_rows = {rows}, _{price}_{s}, NULL)" for s in ("mean", "std")}
        bands[f"{price}_low"] = f"{price}_mean - {sigmas!r}D * {price}_std"
        bands[f"{price}_high"] = f"{price}_mean + {sigmas!r}D * {price}_std"
    return with_columns(with_columns(with_columns(prices, moving), statistics), bands).drop(*moving)


def add_rank_shift(ranked: DataFrame, rows: int = 12, months: bool = False) -> DataFrame:
    """Places gained since the row `rows` rows earlier, or, with `months`, since the same month a year earlier: positive
    when the heading moved towards rank 1."""
    earlier = _a_year_before("{0}", "month") if months else f"lag({{0}}, {rows}) OVER ({SERIES})"
    return with_columns(ranked, {f"rank_{d}_shift": f"{earlier.format(f'rank_{d}')} - rank_{d}" for d in DIRECTIONS})
