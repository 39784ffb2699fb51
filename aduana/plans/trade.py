"""Rollup of customs records, from the fact table to the sorted result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aduana.functions.codes import code_prefix, code_text
from aduana.functions.corrections import correct_records
from aduana.functions.frames import require_columns, with_columns
from aduana.functions.numbers import sum_or_zero
from aduana.functions.units import convert_units
from aduana.operators.filters import agricultural_only, in_period, with_code_prefix
from aduana.operators.ranking import column_to_list, distinct_sorted
from aduana.operators.rollup import direction_sums, grouping_columns, rollup, rollup_family

# Columns every rollup reads; `hts_desc`, `sitc` and the like may be missing.
CONSUMED = ["trade_id", "hts_code", "data", "unit_1", "qty_1", "unit_2", "qty_2", "date"]


def prepare_records(
    facts: DataFrame,
    level: str,
    datetime: str = "",
    agriculture_filter: bool = False,
    corrections: bool = False,
    level_filter: str = "",
    strict: bool = True,
) -> DataFrame:
    """Filter, correct and convert. With `strict`, an empty result of the code filter is a ValueError.

    That check starts a small job that stops at the first row found; a prefix that matches nothing costs a scan of the
    code column. An empty period is no error. Corrections change neither codes nor dates, so the predicates after
    them still reach the scan.
    """
    extra = (["agri_prod"] if agriculture_filter else []) + (["country"] if corrections else [])
    require_columns(facts, CONSUMED + extra, f"a rollup by {level}")
    if agriculture_filter:
        facts = agricultural_only(facts)
    if corrections:
        facts = correct_records(facts)
    facts = with_code_prefix(facts, level, level_filter)
    dated = in_period(facts, datetime)
    if strict and level != "total" and facts.isEmpty():
        raise ValueError(f"Invalid {level.upper()} code: {level_filter}")
    return convert_units(dated, exact=True, limbs=True)


def trade_rollup(
    facts: DataFrame,
    level: str,
    time_frame: str,
    datetime: str = "",
    agriculture_filter: bool = False,
    corrections: bool = False,
    level_filter: str = "",
    strict: bool = True,
    sort: bool = True,
) -> DataFrame:
    """Imports, exports and net trade by `level` ("total", "hts", "naics", "country") and `time_frame`
    ("yearly", "fiscal", "qtr", "monthly")."""
    grouping_columns(level, time_frame)
    base = prepare_records(facts, level, datetime, agriculture_filter, corrections, level_filter, strict)
    return rollup(base, level, time_frame, sort=sort)


def trade_rollup_family(
    facts: DataFrame, datetime: str = "", agriculture_filter: bool = False, corrections: bool = False,
    levels: tuple[str, ...] = ("total", "hts", "naics", "country"),
) -> DataFrame:
    """All layouts of `trade_rollup` at once, from one scan of the facts; see `rollup_family`."""
    base = prepare_records(facts, "total", datetime, agriculture_filter, corrections, strict=False)
    return rollup_family(base, levels)


def product_sums(facts: DataFrame, time_frame: str, **options) -> DataFrame:
    """Sums per product for further aggregation: quantities are still decimals where they are exact."""
    return direction_sums(prepare_records(facts, "hts", **options), grouping_columns("hts", time_frame))


def fiscal_net_quantity(facts: DataFrame, strict: bool = True) -> DataFrame:
    """Per fiscal year, the net import quantity of all products, where a product with net exports counts as 0."""
    products = product_sums(facts, "fiscal", strict=strict)
    # A NaN, which only fractional quantities can hold, stays one.
    net = with_columns(products, {"net": "if(imports_qty < exports_qty, 0, imports_qty - exports_qty)"})
    return net.groupBy("fiscal_year").agg(F.expr(f"double({sum_or_zero('net')})").alias("net_qty"))


def chapter_codes(df: DataFrame, code: str, skip: int = 2) -> DataFrame:
    """Distinct two-character code prefixes in order, without the first `skip`.

    A numeric code is taken as its plain digits, without a leading zero. Skipping rows runs in one task; two
    characters keep the list short whatever the size of the data.
    """
    chapters = df.selectExpr(f"{code_prefix(code_text(code), 2)} AS cmdcode")
    codes = distinct_sorted(chapters, "cmdcode")
    return codes.offset(skip) if skip else codes


def chapter_list(df: DataFrame, code: str, skip: int = 2) -> list[str]:
    return column_to_list(chapter_codes(df, code, skip), "cmdcode")
