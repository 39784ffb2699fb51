"""Imports, exports and net trade, side by side, per level and time frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aduana.functions.dates import FISCAL_START_MONTH
from aduana.functions.frames import quoted, unused_name, with_columns
from aduana.functions.numbers import sum_or_zero, zero_if_null
from aduana.functions.units import EXACT, LIMBS, exact_of_limbs
from aduana.operators.filters import EXPORTS, IMPORTS, LEVEL_COLUMNS, classified

# Time frames and result columns.
TIME_COLUMNS = {
    "yearly": ["year"],
    "fiscal": ["fiscal_year"],
    "qtr": ["year", "qtr"],
    "monthly": ["year", "month"],
}

MEASURES = ("imports", "imports_qty", "exports", "exports_qty")


def grouping_columns(level: str, time_frame: str) -> list[str]:
    if time_frame not in TIME_COLUMNS:
        raise ValueError(f"Unknown time_frame {time_frame!r}; use one of {sorted(TIME_COLUMNS)}")
    if level != "total" and level not in LEVEL_COLUMNS:
        raise ValueError(f"Unknown level {level!r}; use one of {['total', *LEVEL_COLUMNS]}")
    return TIME_COLUMNS[time_frame] + ([] if level == "total" else [LEVEL_COLUMNS[level]])


def add_net_measures(df: DataFrame) -> DataFrame:
    return with_columns(df, {
        "net_exports": "exports - imports",
        "net_imports": "imports - exports",
        "net_exports_qty": "exports_qty - imports_qty",
        "net_imports_qty": "imports_qty - exports_qty",
    })


def _quantity(base: DataFrame) -> tuple[str, ...]:
    """The columns that hold quantities: whole input quantities are added exactly, fractional ones as doubles."""
    if set(LIMBS) <= set(base.columns):
        return LIMBS
    return (EXACT if EXACT in base.columns else "qty",)


def _quantity_sum(columns: tuple[str, ...], value: str = "{0}") -> str:
    """Sum of quantities, 0 for none; limbs are added as 64-bit numbers and put together once per group."""
    sums = [sum_or_zero(value.format(c)) for c in columns]
    return exact_of_limbs(*sums) if len(sums) > 1 else sums[0]


def as_doubles(sums: DataFrame) -> DataFrame:
    """Quantity sums as doubles, rounded once."""
    return with_columns(sums, {m: f"double({m})" for m in MEASURES if m.endswith("_qty")})


def _sums(quantity: tuple[str, ...], fill: bool = True) -> list[Column]:
    """Value and quantity of each direction as conditional sums."""
    sums = []
    for direction, name in ((IMPORTS, "imports"), (EXPORTS, "exports")):
        own = f"if(trade_id = {direction}, {{0}}, NULL)"
        for total, measure in ((sum_or_zero(own.format("data")), name), (_quantity_sum(quantity, own), f"{name}_qty")):
            sums.append(F.expr(total if fill else f"if(count_if(trade_id = {direction}) > 0, {total}, NULL)").alias(measure))
    return sums


def direction_sums(base: DataFrame, keys: list[str], fill: bool = True) -> DataFrame:
    """Value and quantity per key with one column per direction, in one scan and one shuffle.

    The sums are combined on the map side, so a key that holds a third of all rows costs one row per map
    task in the shuffle. A row with a null key has no counterpart in the other direction (nulls are not
    equal), so such a group stays split by direction: a helper column holds the direction for those rows and is
    constant for all others. A direction without rows is 0, or null without `fill`. Quantities are decimals if
    `base` has `qty_exact` or its limbs, else doubles.
    """
    if not keys:
        raise ValueError("no columns to group by")
    any_null = " OR ".join(f"{quoted(key)} IS NULL" for key in keys)
    side = unused_name("_side", base)
    sided = with_columns(classified(base), {side: f"if({any_null}, trade_id, 0)"})
    return sided.groupBy(*(quoted(k) for k in keys), quoted(side)).agg(*_sums(_quantity(base), fill)).drop(side)


def direction_sums_joined(base: DataFrame, keys: list[str]) -> DataFrame:
    """The same result as `direction_sums` in its literal form: two aggregates and a full outer join."""
    rows, quantity = classified(base), _quantity(base)

    def one_side(direction: int, name: str) -> DataFrame:
        return rows.where(f"trade_id = {direction}").groupBy(*(quoted(k) for k in keys)).agg(
            F.sum("data").alias(name), F.expr(_quantity_sum(quantity)).alias(f"{name}_qty")
        )

    joined = one_side(IMPORTS, "imports").join(one_side(EXPORTS, "exports"), keys, "full")
    return joined.selectExpr(*(quoted(k) for k in keys), *(f"{zero_if_null(m)} AS {m}" for m in MEASURES))


def rollup(base: DataFrame, level: str, time_frame: str, *, sort: bool = True) -> DataFrame:
    """Roll converted records up; `base` has `hts_code, trade_id, data, qty` (or `qty_exact`) and the grouping columns.

    `sort=False` saves the range shuffle of the result when it is aggregated or written further on.
    Value sums are 64-bit; ANSI mode raises an error on overflow.
    """
    keys = grouping_columns(level, time_frame)
    result = add_net_measures(as_doubles(direction_sums(base, keys)))
    return result.orderBy(*keys) if sort else result


# Calendar columns of each time frame, out of year and month; those that a time frame lacks are null.
_PERIODS = {
    "yearly": {"year": "year"},
    "fiscal": {"fiscal_year": f"year + if(month >= {FISCAL_START_MONTH}, 1, 0)"},
    "qtr": {"year": "year", "qtr": "(month + 2) div 3"},
    "monthly": {"year": "year", "month": "month"},
}


def rollup_family(base: DataFrame, levels: tuple[str, ...] = ("total", *LEVEL_COLUMNS)) -> DataFrame:
    """The rollups of all `levels` and time frames in one pass: `level`, `time_frame`, their key columns (null where a layout
    has none), and the measures of `rollup`, without an order. A level leaves out records without its code.

    The layouts are a lattice: each record goes into its months of the levels, combined on the map side, and the sums of
    quarters, years and fiscal years come from those of months. Whole values and quantities are added exactly, so the
    result is that of the single rollups, bit by bit; fractional quantities can differ in their last digits.
    """
    for level in levels:
        grouping_columns(level, "yearly")
    codes = {level: quoted(LEVEL_COLUMNS[level]) if level in LEVEL_COLUMNS else "CAST(NULL AS STRING)" for level in levels}
    each = ", ".join(f"struct('{level}' AS level, {code} AS code)" for level, code in codes.items())
    records = classified(base).selectExpr("trade_id", "data", *_quantity(base), "year", "month", f"inline(array({each}))")
    records = records.where("level = 'total' OR code IS NOT NULL")
    # Records without a date have no counterpart in the other direction; see `direction_sums`.
    sided = with_columns(records, {"side": "if(year IS NULL, trade_id, 0)"})
    months = sided.groupBy("level", "code", "year", "month", "side").agg(*_sums(_quantity(base)))
    parts = ("year", "fiscal_year", "qtr", "month")
    frames = ", ".join(
        f"struct('{frame}' AS time_frame, " + ", ".join(f"int({periods.get(c, 'NULL')}) AS {c}" for c in parts) + ")"
        for frame, periods in _PERIODS.items())
    spread = months.selectExpr("level", "code", "side", *MEASURES, f"inline(array({frames}))")
    summed = spread.groupBy("level", "time_frame", "code", "side", *parts).agg(*(F.sum(m).alias(m) for m in MEASURES))
    keyed = add_net_measures(as_doubles(summed))
    return keyed.selectExpr(
        "level", "time_frame", *parts,
        *(f"if(level = '{level}', code, NULL) AS {column}" for level, column in LEVEL_COLUMNS.items()),
        *MEASURES, "net_exports", "net_imports", "net_exports_qty", "net_imports_qty")
