from __future__ import annotations

import math

import pytest
from comparing import as_bag
from frames import day, facts

from aduana import rollup, trade_rollup
from aduana import TradeDesk
from aduana.functions.units import convert_units
from aduana.operators.filters import with_code_prefix
from aduana.operators.rollup import add_net_measures, direction_sums, direction_sums_joined, grouping_columns
from workload.facts import trade_facts

LEVELS = ("total", "hts", "naics", "country")
TIMES = ("yearly", "fiscal", "qtr", "monthly")


def bag(df):
    return as_bag(df.columns, df.collect())


@pytest.fixture(scope="module")
def trade(spark, sf_dir):
    return trade_facts(spark, sf_dir, agri=True, country=True)


@pytest.mark.parametrize("time", TIMES)
@pytest.mark.parametrize("level", LEVELS)
def test_one_pass_equals_full_join(trade, level, time):
    base = convert_units(with_code_prefix(trade, level), exact=True)
    keys = grouping_columns(level, time)
    one_pass = direction_sums(base, keys)
    joined = direction_sums_joined(base, keys)
    assert one_pass.columns == joined.columns
    assert bag(one_pass) == bag(joined)


def test_null_dates_stay_split_by_direction(spark):
    df = facts(
        spark, {"date": None, "data": 5}, {"date": None, "data": 6}, {"date": None, "data": 7, "trade_id": 2},
        {"data": 1}, {"data": 2, "trade_id": 2},
    )
    rows = [tuple(r)[:5] for r in trade_rollup(df, "total", "yearly").collect()]
    assert sorted(rows[:2], key=lambda r: r[1]) == [(None, 0, 0.0, 7, 10.0), (None, 11, 20.0, 0, 0.0)]
    assert rows[2] == (2010, 1, 10.0, 2, 10.0)


def test_other_directions_and_missing_codes_are_left_out(spark):
    df = facts(spark, {"trade_id": 3}, {"trade_id": None}, {"hts_code": None}, {"data": 4, "country": "france"})
    assert [(r.country, r.imports) for r in trade_rollup(df, "country", "yearly").collect()] == [("france", 4)]


def test_unknown_units_give_zero_and_measures_are_not_null(spark):
    row = trade_rollup(facts(spark, {"unit_1": "no", "data": None}), "hts", "monthly").first()
    assert row.asDict() == {
        "year": 2010, "month": 5, "hts_code": "0101000001", "imports": 0, "imports_qty": 0.0, "exports": 0,
        "exports_qty": 0.0, "net_exports": 0, "net_imports": 0, "net_exports_qty": 0.0, "net_imports_qty": 0.0,
    }


def test_result_schema_and_order(trade):
    result = trade_rollup(trade, "hts", "monthly")
    assert [(f.name, f.dataType.simpleString()) for f in result.schema] == [
        ("year", "int"), ("month", "int"), ("hts_code", "string"), ("imports", "bigint"), ("imports_qty", "double"),
        ("exports", "bigint"), ("exports_qty", "double"), ("net_exports", "bigint"), ("net_imports", "bigint"),
        ("net_exports_qty", "double"), ("net_imports_qty", "double"),
    ]
    keys = [(r.year is not None, r.year or 0, r.month or 0, r.hts_code) for r in result.collect()]
    assert keys == sorted(keys)


def totals(df, measure):
    return df.agg({measure: "sum"}).first()[0]


@pytest.mark.parametrize("measure", ["imports", "exports"])
def test_levels_add_up(trade, measure):
    total = totals(trade_rollup(trade, "total", "yearly"), measure)
    assert totals(trade_rollup(trade, "total", "fiscal"), measure) == total
    assert totals(trade_rollup(trade, "hts", "monthly"), measure) == total
    for level in ("country", "naics"):
        known = trade.where(f"{level} IS NOT NULL")
        assert totals(trade_rollup(trade, level, "qtr"), measure) == totals(
            trade_rollup(known, "total", "yearly"), measure
        )


def test_net_measures_mirror_each_other(trade):
    for r in trade_rollup(trade, "country", "yearly").collect():
        assert r.net_exports == -r.net_imports == r.exports - r.imports
        assert r.net_exports_qty == -r.net_imports_qty == r.exports_qty - r.imports_qty


def test_plain_sums_agree_within_rounding(trade):
    base = convert_units(trade)
    exact = {r.year: r.imports_qty for r in trade_rollup(trade, "total", "yearly").where("exports = 0 OR year > 0").collect()}
    for r in rollup(base, "total", "yearly").where("year IS NOT NULL").collect():
        assert math.isclose(r.imports_qty, exact[r.year], rel_tol=1e-12)


def test_net_measures_of_hand_written_sums(spark):
    df = spark.createDataFrame([(3, 1.5, 5, 0.5)], "imports bigint, imports_qty double, exports bigint, exports_qty double")
    row = add_net_measures(df).first()
    assert (row.net_exports, row.net_imports, row.net_exports_qty, row.net_imports_qty) == (2, -2, -1.0, 1.0)


def test_value_overflow_is_an_error(spark):
    df = facts(spark, {"data": 2**63 - 1}, {"data": 1})
    with pytest.raises(Exception, match="ARITHMETIC_OVERFLOW"):
        trade_rollup(df, "total", "yearly").collect()


def test_source_day_bounds(spark):
    df = facts(spark, {"date": day("2012-06-30"), "data": 1}, {"date": day("2012-07-01"), "data": 2})
    assert [(r.fiscal_year, r.imports) for r in trade_rollup(df, "total", "fiscal").collect()] == [(2012, 1), (2013, 2)]


def test_keys_of_any_name(spark):
    df = facts(spark, {"data": 5}, {"data": 6, "country": "a `b`", "trade_id": 2}).withColumnRenamed("country", "partner `x` y")
    base = convert_units(df.selectExpr("*", "'east' AS _side"))
    rows = direction_sums(base, ["partner `x` y", "_side"]).collect()
    assert sorted(tuple(r)[:3] for r in rows) == [("a `b`", "east", 0), ("spain", "east", 5)]
    with pytest.raises(ValueError, match="group"):
        direction_sums(base, [])


def test_a_direction_without_rows(spark):
    desk = TradeDesk(spark, {})
    base = desk.conversion(facts(spark, {"data": None}, {"country": "france", "trade_id": 2}))
    rows = {r.country: tuple(r)[1:] for r in desk.filter_data(base, ["country"]).collect()}
    assert rows == {"spain": (0, 10.0, None, None), "france": (None, None, 100, 10.0)}
    assert {r.country: (r.imports, r.exports) for r in desk.process_data("yearly", "country", base).collect()} == {
        "spain": (0, 0), "france": (0, 100)}


def test_only_consumed_columns_are_needed(spark):
    df = facts(spark, {}).drop("agri_prod", "country", "naics")
    assert trade_rollup(df, "hts", "yearly").count() == 1
    for options, column in (({"agriculture_filter": True}, "agri_prod"), ({"corrections": True}, "country")):
        with pytest.raises(ValueError, match=column):
            trade_rollup(df, "hts", "yearly", **options)
    with pytest.raises(ValueError, match="unit_2"):
        trade_rollup(df.drop("unit_2"), "total", "yearly")
