from __future__ import annotations

import pytest
from frames import day, facts, physical_plan_of

from aduana import trade_rollup
from aduana.operators.filters import in_period, latest_period, with_code_prefix
from aduana.sources import write_facts


def values(df, column):
    return sorted((r[0] for r in df.select(column).collect()), key=str)


def test_prefix_and_null_codes(spark):
    df = facts(spark, {"hts_code": "2207100000"}, {"hts_code": "0101000001"}, {"hts_code": None})
    assert values(with_code_prefix(df, "hts", "22"), "hts_code") == ["2207100000"]
    assert values(with_code_prefix(df, "hts"), "hts_code") == ["0101000001", "2207100000"]
    assert with_code_prefix(df, "total", "22").count() == 3
    assert with_code_prefix(df, "hts", "2' OR '1'='1").count() == 0


def test_level_without_its_column(spark):
    with pytest.raises(ValueError, match="naics"):
        with_code_prefix(facts(spark, {}).drop("naics"), "naics")


def test_range_is_closed_at_midnight(spark):
    days = ["2023-12-31T23:59:59", "2024-01-01", "2024-06-01T10:00:00", "2024-12-31", "2024-12-31T10:00:00"]
    df = facts(spark, *({"date": day(d)} for d in days), {"date": None})
    assert values(in_period(df, "2024-01-01+2024-12-31"), "date") == [day(d) for d in days[1:4]]
    assert values(in_period(df, "2024"), "date") == [day(d) for d in days[1:]]
    assert in_period(df, "").count() == 6
    assert in_period(df, "0").count() == 0
    assert in_period(df, "9999").count() == 0


@pytest.mark.parametrize("text", ["2024-01-01+2024-02-01+2024-03-01", "20x4", "2024-01-01", "2024-13-01+2024-12-31"])
def test_bad_periods(spark, text):
    with pytest.raises(ValueError):
        in_period(facts(spark, {}), text)


def test_unknown_code_is_an_error_only_when_strict(spark):
    df = facts(spark, {"date": day("2010-01-01")})
    with pytest.raises(ValueError, match="HTS code: 99"):
        trade_rollup(df, "hts", "yearly", level_filter="99")
    assert trade_rollup(df, "hts", "yearly", level_filter="99", strict=False).isEmpty()
    # An empty period is no error, and "total" has no code to check.
    assert trade_rollup(df, "hts", "yearly", datetime="1999").isEmpty()
    assert trade_rollup(df, "total", "yearly", level_filter="99").count() == 1


@pytest.mark.parametrize(("level", "time_frame"), [("hs4", "yearly"), ("hts", "weekly")])
def test_unknown_layout(spark, level, time_frame):
    with pytest.raises(ValueError):
        trade_rollup(facts(spark, {}), level, time_frame)


def test_agricultural_filter_drops_nulls(spark):
    df = facts(spark, {"agri_prod": 1, "data": 7}, {"agri_prod": 0}, {"agri_prod": None})
    assert trade_rollup(df, "total", "yearly", agriculture_filter=True).first().imports == 7


def test_latest_period(spark):
    df = facts(spark, {"date": day("2010-01-01")}, {"date": day("2011-01-01"), "data": 5}, {"date": None})
    assert values(latest_period(df), "data") == [5]
    assert latest_period(facts(spark, {"date": None})).isEmpty()


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "facts")
    df = facts(spark, {"date": day("2010-05-01")}, {"date": day("2011-05-01")}, {"date": None})
    write_facts(df, path)
    stored = spark.read.parquet(path)
    rolled = trade_rollup(
        stored, "hts", "yearly", datetime="2010", corrections=True, agriculture_filter=True, level_filter="01",
        strict=False,
    )
    plan = physical_plan_of(rolled)
    assert "StringStartsWith(hts_code,01)" in plan
    assert "EqualTo(agri_prod,1)" in plan
    assert "GreaterThanOrEqual(date,2010-01-01" in plan and "LessThan(date,2011-01-01" in plan
    assert "date_year#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "naics" not in plan.split("ReadSchema: ")[1]
