"""Every registered query against its SQL, and the shape of its plan."""

from __future__ import annotations

import re

import __spark_entry__
import pytest
from aduana import denormalise
from comparing import as_bag, differences, sql_rows
from frames import physical_plan_of
from workload import oracles, queries, stored

QUERIES, ORACLES = queries.queries(), oracles.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_result(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), ORACLES[name], sf_dir) == ""


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, sf_dir, name):
    plan = physical_plan_of(QUERIES[name](spark, sf_dir))
    # The landed pages of the header queries are put together by aggregation first.
    pages = name.startswith("header_")
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", *(() if pages else ("ObjectHashAggregate",))):
        assert slow not in plan
    if name in stored.queries():
        assert "lineitem" not in plan
        return
    lineitem_scans = [s for s in re.findall(r"Location: .*", plan) if "lineitem" in s]
    # Only the literal join form and the union read the records twice; `latest_period` has its own test.
    assert len(lineitem_scans) == (2 if name in ("full_join_rollup", "union_directions", "latest_period") else 1)
    exchanges = len(re.findall(r"^\(\d+\) Exchange", plan, re.M))
    limit = {"price_quarterly": 3, "price_agri": 3, "price_calendar": 3, "price_movers_top": 2, "price_movers_bottom": 2}
    limit |= {"price_statistics_monthly": 4, "price_months": 4, "price_rolling": 4, "price_rank": 3, "price_yoy_monthly": 4}
    limit |= {"latest_period": 5, "full_join_rollup": 3, "star_denormalise": 0, "fiscal_net": 2, "prefix_label": 4}
    assert exchanges <= limit.get(name, 2)


def test_latest_period_scans_the_records_once(spark, sf_dir):
    df = QUERIES["latest_period"](spark, sf_dir)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \[l_", plan)) == 1 and "ReusedExchange" in plan


@pytest.mark.parametrize(
    "name", ["hts_monthly", "country_yearly", "price_quarterly", "price_statistics_monthly", "distinct_codes", "chapters"])
def test_order(spark, sf_dir, name):
    """The hash of the results is a bag's; here the sequence counts."""
    columns, expected = sql_rows(ORACLES[name] + ("" if "ORDER BY" in ORACLES[name].rsplit(")", 1)[-1] else "ORDER BY hs4, date NULLS FIRST"), sf_dir)
    keys = [c for c in ("year", "month", "hts_code", "country", "hs4", "date", "cmdcode") if c in columns]
    if name.startswith("price"):
        keys = ["hs4", "date"]
    found = [tuple(row[k] for k in keys) for row in QUERIES[name](spark, sf_dir).collect()]
    assert found == [tuple(row[columns.index(k)] for k in keys) for row in expected]


def test_stored_facts_are_pruned(spark, sf_dir):
    """Folders of other years are not listed, and codes and dates are tested in the files' row groups."""
    plan = physical_plan_of(QUERIES["stored_org_rollup"](spark, sf_dir))
    folders, pushed = (plan.split(f"{kind}: [")[1].split("\n")[0] for kind in ("PartitionFilters", "PushedFilters"))
    assert "date_year" in folders and "2009" in folders and "2010" in folders
    assert "StringStartsWith(hts_code,22)" in pushed and "GreaterThanOrEqual(date,2009-03-01" in pushed
    assert "agri_prod" not in plan.split("ReadSchema")[1].split("\n")[0]
    plan = physical_plan_of(QUERIES["stored_jp_rollup"](spark, sf_dir))
    pushed = plan.split("PushedFilters: [")[1].split("\n")[0]
    assert "date_year" in plan.split("PartitionFilters: [")[1].split("\n")[0]
    assert "StringStartsWith(naics,3)" in pushed and "EqualTo(agri_prod,1)" in pushed


def test_an_update_can_be_repeated(spark, sf_dir):
    first, again = (sorted(map(str, QUERIES["ingested_update"](spark, sf_dir).collect())) for _ in range(2))
    assert first == again


def test_all_layouts_come_from_one_scan_and_equal_the_single_rollups(spark, sf_dir):
    family = QUERIES["rollup_layouts"](spark, sf_dir)
    plan = physical_plan_of(family)
    assert len([s for s in re.findall(r"Location: .*", plan) if "lineitem" in s]) == 1
    assert len(re.findall(r"^\(\d+\) Exchange", plan, re.M)) == 2
    rows = family.collect()
    for level in ("total", "hts", "naics", "country"):
        for time in ("yearly", "fiscal", "qtr", "monthly"):
            single = QUERIES[f"{level}_{time}"](spark, sf_dir)
            mine = [[r[c] for c in single.columns] for r in rows if (r.level, r.time_frame) == (level, time)]
            assert as_bag(single.columns, mine) == as_bag(single.columns, single.collect())


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_a_code_prefix_cuts_the_fact_before_other_look_ups(spark, sf_dir, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        # Without a rollup on top, so that no look-up is pruned.
        fact, dimensions = queries._star(spark, sf_dir)
        plan = physical_plan_of(denormalise(fact, dimensions, "hts", "00000001"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    tree = plan.split("\n\n")[0]
    joins = re.findall(r"(Join(?: Inner| LeftOuter)?)[^\n]*\((\d+)\)", tree)
    kinds = re.findall(r"(?:BroadcastHashJoin|SortMergeJoin) (Inner|LeftOuter)", tree)
    assert len(joins) == 7 and kinds == ["LeftOuter"] * 6 + ["Inner"]
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_all_are_registered():
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLES) <= set(__spark_entry__.oracle_sql())


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns[:3] == ["year", "month", "hts_code"]
