"""Unit-price series of HS4 headings and the reports on them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from aduana.functions.frames import with_columns
from aduana.functions.numbers import clamp
from aduana.operators.ranking import extremes_of_latest
from aduana.operators.series import (
    add_calendar_change, add_market_rank, add_rank_shift, add_rolling_statistics, add_row_change, unit_prices,
)
from aduana.plans.trade import product_sums

PRICE_COLUMNS = (
    "hs4", "imports", "exports", "imports_qty", "exports_qty", "price_imports", "price_exports", "date",
)


def _heading_prices(
    facts: DataFrame, time_frame: str, period: str, agriculture_filter: bool, strict: bool, cluster_by: tuple[str, ...]
) -> DataFrame:
    products = product_sums(facts, time_frame, agriculture_filter=agriculture_filter, corrections=True, strict=strict)
    prices = unit_prices(products, period, cluster_by=cluster_by)
    return prices.select("year", period, *PRICE_COLUMNS)


def price_series(
    facts: DataFrame,
    agriculture_filter: bool = False,
    calendar: bool = False,
    strict: bool = True,
    sort: bool = True,
) -> DataFrame:
    """Quarterly import and export unit price per HS4 heading with the change over four quarters in percent.

    Corrections are always applied. The change looks four rows back in the heading's series; with
    `calendar` it looks at the same quarter one year earlier, which differs when quarters are missing.
    """
    prices = _heading_prices(facts, "qtr", "qtr", agriculture_filter, strict, ("hs4",))
    changed = add_calendar_change(prices, "qtr") if calendar else add_row_change(prices, 4)
    return changed.orderBy("hs4", "date") if sort else changed


def monthly_price_statistics(
    facts: DataFrame, agriculture_filter: bool = False, strict: bool = True, sort: bool = True, months: bool = False
) -> DataFrame:
    """Monthly unit prices per HS4 heading with statistics over three rows, price bands, market rank, the change over
    twelve rows in percent and the shift in rank over twelve rows.

    A heading without trade in some month has no row for it, so rows reach across the gap. With `months`, statistics are
    over three calendar months and null where one is missing, and change and shift are against the same month a year
    earlier. Prices and ranks share one shuffle by month, the other columns one by heading.
    """
    prices = _heading_prices(facts, "monthly", "month", agriculture_filter, strict, ("year", "month"))
    ranked = add_market_rank(prices)
    rolling = add_rolling_statistics(ranked, months=months)
    changed = add_calendar_change(rolling, "month") if months else add_row_change(rolling, 12)
    result = add_rank_shift(changed, months=months)
    return result.orderBy("hs4", "date") if sort else result


def price_movers(
    prices: DataFrame, k: int = 50, *, largest: bool = True, direction: str = "imports", drop_null: bool = False
) -> DataFrame:
    """The `k` headings whose price rose (fell) most in the latest quarter of a price series.

    `actual_yoy` is the change itself and `plot_yoy` the change limited to ±100 percent. A heading without a
    change yet is listed first, as nulls sort first; `drop_null` leaves it out.
    """
    change = f"price_{direction}_yoy"
    changes = with_columns(prices, {"actual_yoy": change, "plot_yoy": clamp(change, -100.0, 100.0)})
    return extremes_of_latest(changes, "actual_yoy", k, largest=largest, key="hs4", drop_null=drop_null)
