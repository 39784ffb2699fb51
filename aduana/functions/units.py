"""One comparable quantity (kilogram equivalents) out of two quantity/unit pairs."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from aduana.functions.codes import code_prefix
from aduana.functions.dates import calendar_parts
from aduana.functions.frames import with_columns
from aduana.functions.numbers import zero_if_null


class Unit(NamedTuple):
    """How a quantity becomes kilograms, as arithmetic on doubles and as an exact factor; `by_product` replaces both
    for codes with the given first six digits."""

    kilograms: str
    factor: str
    by_product: dict[str, tuple[str, str]] = {}


# Unit codes and their factors. The order is the order of precedence.
UNITS = {
    "kg": Unit("{0}", "1"),
    "gm": Unit("{0} / 1000", "0.001"),
    "t": Unit("{0} * 1000", "1000"),
    "l": Unit("{0}", "1"),
    "doz": Unit("{0} * 0.70874D", "0.70874"),
    "m3": Unit("{0} * 353.8322D", "353.8322"),
    "pfl": Unit("{0} * 1.25D", "1.25", {"220710": ("{0} * 0.5556D", "0.5556"), "220870": ("{0} * 2", "2")}),
}

# Whole quantities times any factor above have at most this many decimals.
QUANTITY_DECIMALS = 5
# The quantity without rounding, beside `qty`: any 64-bit quantity times any factor fits.
EXACT = "qty_exact"
# The same as two 64-bit numbers, qty_exact = (qty_high * 2^31 + qty_low) / 10^5, which add up without decimals per row.
LIMBS = ("qty_high", "qty_low")
_LIMB_BITS = 31
_WHOLE_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def unit_rank(unit: str) -> str:
    """Place of a unit in the order of precedence, counted from 1; 0 for an unknown or missing unit."""
    units = ", ".join(f"'{u}'" for u in UNITS)
    return zero_if_null(f"int(array_position(array({units}), lower({unit})))")


def _by_unit(rank: str, hts_code: str, kind: int, text: str) -> str:
    """CASE over the units; `kind` picks the arithmetic (0) or the factor (1), which goes into `text`."""
    branches = []
    for place, unit in enumerate(UNITS.values(), start=1):
        value = text.format(unit[kind])
        if unit.by_product:
            special = " ".join(f"WHEN '{hs6}' THEN {text.format(both[kind])}" for hs6, both in unit.by_product.items())
            value = f"CASE {code_prefix(hts_code, 6)} {special} ELSE {value} END"
        branches.append(f"WHEN {place} THEN {value}")
    return f"CASE {rank} {' '.join(branches)} END"


def kilograms(quantity: str, rank: str, hts_code: str) -> str:
    """Quantity in kilograms; null for rank 0."""
    return _by_unit(rank, hts_code, 0, "{0}").format(quantity)


def exact_kilograms(quantity: str, rank: str, hts_code: str) -> str:
    """The same as a decimal, for a whole quantity: no digit is lost."""
    factor = _by_unit(rank, hts_code, 1, f"CAST({{0}}BD AS DECIMAL(9, {QUANTITY_DECIMALS}))")
    return f"CAST(CAST({quantity} AS DECIMAL(19, 0)) * {factor} AS DECIMAL(28, {QUANTITY_DECIMALS}))"


def kilogram_limbs(quantity: str, rank: str, hts_code: str) -> dict[str, str]:
    """The exact kilograms of a whole 64-bit quantity in two limbs: each factor is a whole number of 10^-5 below 2^27, so no
    product overflows, and the low limbs of four billion records add up."""
    factor = _by_unit(rank, hts_code, 1, f"CAST({{0}}BD * {10 ** QUANTITY_DECIMALS} AS BIGINT)")
    low = f"({quantity} & {(1 << _LIMB_BITS) - 1}) * {factor}"
    return {
        LIMBS[0]: f"shiftright({low}, {_LIMB_BITS}) + shiftright({quantity}, {_LIMB_BITS}) * {factor}",
        LIMBS[1]: f"({low}) & {(1 << _LIMB_BITS) - 1}",
    }


def exact_of_limbs(high: str, low: str) -> str:
    """Sums of limbs as one decimal."""
    whole = f"CAST({high} AS DECIMAL(20, 0)) * {1 << _LIMB_BITS}BD + {low}"
    return f"CAST(({whole}) * CAST(1e-{QUANTITY_DECIMALS}BD AS DECIMAL({QUANTITY_DECIMALS}, {QUANTITY_DECIMALS})) AS DECIMAL(38, {QUANTITY_DECIMALS}))"


def convert_units(facts: DataFrame, exact: bool = False, limbs: bool = False) -> DataFrame:
    """Add `qty` in kilogram equivalents and the columns `qtr`, `fiscal_year`, `month`, `year`. With `exact`, and if both
    quantity columns hold whole numbers, the decimal `qty_exact` comes with them, which rollups add up instead; with `limbs`
    as well, the columns `LIMBS` come in its place.

    The pair whose unit comes first in the order of precedence counts: a `kg` in the second pair wins over a
    `t` in the first one, and with equal units the first pair wins. Null input quantities become 0.

    These are projections only: they run inside the scan stage, and Catalyst drops whatever the query does
    not use. The pair is chosen before the factor; one branch per unit and pair would make the generated
    method so long that the JVM interprets it instead of compiling it.
    """
    facts = with_columns(facts, {
        "qty_1": zero_if_null("qty_1"), "qty_2": zero_if_null("qty_2"),
        "_rank_1": unit_rank("unit_1"), "_rank_2": unit_rank("unit_2"),
    })
    first = "_rank_1 > 0 AND (_rank_2 = 0 OR _rank_1 <= _rank_2)"
    chosen = with_columns(facts, {
        "_rank": f"if({first}, _rank_1, _rank_2)",
        "_whole": f"if({first}, qty_1, qty_2)",
        "_quantity": f"double(if({first}, qty_1, qty_2))",
    })
    results = {"qty": kilograms("_quantity", "_rank", "hts_code")}
    if exact and all(isinstance(facts.schema[c].dataType, _WHOLE_TYPES) for c in ("qty_1", "qty_2")):
        if limbs:
            results |= kilogram_limbs("_whole", "_rank", "hts_code")
        else:
            results[EXACT] = exact_kilograms("_whole", "_rank", "hts_code")
    converted = with_columns(chosen, results | calendar_parts("date"))
    return converted.drop("_whole", "_rank_1", "_rank_2", "_rank", "_quantity")
