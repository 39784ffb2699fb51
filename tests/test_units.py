from __future__ import annotations

import pytest
from frames import day, facts

from aduana.functions.units import LIMBS, UNITS, convert_units, exact_of_limbs

OTHER, ETHANOL, LIQUEUR = "0101000001", "2207100000", "2208700000"


@pytest.mark.parametrize(
    ("unit_1", "unit_2", "code", "expected"),
    [
        ("kg", None, OTHER, 30.0), (None, "kg", OTHER, 70.0),
        ("gm", None, OTHER, 30 / 1000), (None, "gm", OTHER, 70 / 1000),
        ("t", None, OTHER, 30000.0), (None, "t", OTHER, 70000.0),
        ("l", None, OTHER, 30.0), (None, "l", OTHER, 70.0),
        ("doz", None, OTHER, 30 * 0.70874), (None, "doz", OTHER, 70 * 0.70874),
        ("m3", None, OTHER, 30 * 353.8322), (None, "m3", OTHER, 70 * 353.8322),
        ("pfl", None, ETHANOL, 30 * 0.5556), (None, "pfl", ETHANOL, 70 * 0.5556),
        ("pfl", None, LIQUEUR, 60.0), (None, "pfl", LIQUEUR, 140.0),
        ("pfl", None, OTHER, 30 * 1.25), (None, "pfl", OTHER, 70 * 1.25),
        ("pfl", None, None, 30 * 1.25),
        # An earlier unit of the second pair wins over a later one of the first pair.
        ("t", "kg", OTHER, 70.0), ("gm", "t", OTHER, 30 / 1000), ("pfl", "m3", ETHANOL, 70 * 353.8322),
        ("kg", "kg", OTHER, 30.0), ("pfl", "pfl", LIQUEUR, 60.0),
        # Case does not matter; an unknown unit is passed over.
        ("KG", "T", OTHER, 30.0), ("no", "Gm", OTHER, 70 / 1000), ("no", "x", OTHER, None), (None, None, OTHER, None),
    ],
)
def test_each_rule(spark, unit_1, unit_2, code, expected):
    row = convert_units(
        facts(spark, {"unit_1": unit_1, "qty_1": 30, "unit_2": unit_2, "qty_2": 70, "hts_code": code})
    ).first()
    assert row.qty == expected
    exact = convert_units(
        facts(spark, {"unit_1": unit_1, "qty_1": 30, "unit_2": unit_2, "qty_2": 70, "hts_code": code}), exact=True
    ).first()
    assert exact.qty == expected and (exact.qty_exact if expected is None else float(exact.qty_exact)) == (
        expected if expected is None else pytest.approx(expected, rel=1e-15))


def test_null_quantity_counts_as_zero(spark):
    row = convert_units(facts(spark, {"unit_1": "kg", "qty_1": None, "unit_2": "t", "qty_2": None})).first()
    assert (row.qty, row.qty_1, row.qty_2) == (0.0, 0, 0)


def test_no_helper_column_is_left(spark):
    df = facts(spark, {})
    assert convert_units(df).columns == [*df.columns, "qty", "qtr", "fiscal_year", "month", "year"]
    assert convert_units(df, exact=True).columns == [*df.columns, "qty", "qty_exact", "qtr", "fiscal_year", "month", "year"]
    fractional = df.selectExpr("* EXCEPT (qty_2)", "double(qty_2) AS qty_2")
    assert "qty_exact" not in convert_units(fractional, exact=True).columns


@pytest.mark.parametrize(
    ("date", "expected"),
    [
        (day("2012-06-30"), (2, 2012, 6, 2012)), (day("2012-07-01"), (3, 2013, 7, 2012)),
        (day("2012-12-31T23:59:59"), (4, 2013, 12, 2012)), (None, (None, None, None, None)),
    ],
)
def test_calendar_parts(spark, date, expected):
    row = convert_units(facts(spark, {"date": date})).first()
    assert (row.qtr, row.fiscal_year, row.month, row.year) == expected


def test_limbs_are_the_exact_quantity(spark):
    """For any 64-bit quantity, by itself and in sums beyond 64 bits."""
    quantities = [0, 1, -1, 7, 2**31 - 1, 2**31, -(2**31), 2**62, -(2**62), 2**63 - 1, -(2**63), 123456789012345678]
    rows = [(u, q, h) for u in [*UNITS, "no"] for q in quantities for h in ("2207100000", "2208700000", "0101000000")]
    df = spark.createDataFrame(rows, "unit_1 string, qty_1 bigint, hts_code string").selectExpr(
        "*", "CAST(NULL AS STRING) AS unit_2", "CAST(NULL AS BIGINT) AS qty_2", "CAST(NULL AS TIMESTAMP_NTZ) AS date")
    exact, limbs = convert_units(df, exact=True), convert_units(df, exact=True, limbs=True)
    assert limbs.columns == [*df.columns, "qty", *LIMBS, "qtr", "fiscal_year", "month", "year"]
    both = exact.select("unit_1", "qty_1", "hts_code", "qty_exact").join(limbs.select("unit_1", "qty_1", "hts_code", *LIMBS), ["unit_1", "qty_1", "hts_code"])
    assert both.where(f"NOT qty_exact <=> {exact_of_limbs(*LIMBS)}").isEmpty() and both.count() == len(rows)
    sums = both.where("qty_1 > 0").selectExpr("sum(qty_exact) AS a", exact_of_limbs(*(f"sum({c})" for c in LIMBS)) + " AS b").first()
    assert sums.a == sums.b > 2**64
    fractional = df.selectExpr("* EXCEPT (qty_1)", "double(qty_1) AS qty_1")
    assert not set(LIMBS) & set(convert_units(fractional, exact=True, limbs=True).columns)
