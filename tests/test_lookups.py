from __future__ import annotations

import re

import pytest
from aduana.operators.lookups import (
    AGRICULTURAL_HEADINGS, NAICS_SECTORS, STAR_KEYS, _swept, agricultural_headings, code_intervals, denormalise, direction_table,
    naics_sectors, unmatched_keys, with_agricultural_flag, with_naics_sector, with_prefix_label,
)
from aduana.operators.ranking import column_to_list, distinct_sorted
from aduana.plans.trade import chapter_codes, chapter_list, fiscal_net_quantity
from aduana.sources import DIMENSIONS, STAR_ORGANISATION_FACT, STAR_PLANNING_FACT
from frames import day, facts, physical_plan_of


def test_lookup_tables(spark):
    assert len(AGRICULTURAL_HEADINGS) == len(set(AGRICULTURAL_HEADINGS)) == 129
    codes = column_to_list(agricultural_headings(spark), "hs4")
    assert len(codes) == 129 and {len(c) for c in codes} == {4} and sum(c[0] == "0" for c in codes) == 62
    assert len(NAICS_SECTORS) == naics_sectors(spark).count() == 29
    assert [tuple(r) for r in direction_table(spark).orderBy("id").collect()] == [(1, "Imports"), (2, "Exports")]


def test_agricultural_flag(spark):
    df = spark.createDataFrame([("0405000000",), ("0411000000",), ("2106909999",), (None,)], "hts_code string")
    assert column_to_list(with_agricultural_flag(df), "agricultural") == [1, 0, 1, None]


def test_longest_prefix_wins(spark):
    expected = {
        "325412": NAICS_SECTORS["3254"], "325199": NAICS_SECTORS["325"], "3299": NAICS_SECTORS["32"],
        "32": NAICS_SECTORS["32"], "111": NAICS_SECTORS["11"], "3391": NAICS_SECTORS["3391"], "99": None, "3": None,
    }
    df = spark.createDataFrame([(c,) for c in [*expected, None]], "naics string")
    found = {r.naics: r.sector for r in with_naics_sector(df).collect()}
    assert found == expected | {None: None}
    assert with_naics_sector(df).columns == ["naics", "sector"]


NESTED = {"1": "a", "12": "b", "1234": "c", "125": "d", "9": "e", "12345678": "f", "13": None, "é": "g", "éa": "h", "7.": "i"}
CODES = ["1", "10", "12", "120", "1234", "123", "12345678", "123456789", "1235", "125", "1259", "126", "13", "139", "14", "2", "9", "99",
         "", "é", "éa1", "éb", "e", "7", "7.5", "8", None]


def longest(code):
    found = [p for p in NESTED if code is not None and code.startswith(p)]
    return NESTED[max(found, key=len)] if found else None


def test_labels_of_nested_prefixes(spark):
    codes = spark.createDataFrame([(c,) for c in CODES], "`my code` string").selectExpr("`my code`", "1 AS label", "2 AS _bucket", "3 AS low")
    listed = {p: n for p, n in NESTED.items() if n is not None}
    table = spark.createDataFrame([*listed.items(), ("12", "z"), (None, "n")], "prefix string, label string")
    for prefixes in (listed, table):
        found = with_prefix_label(codes, prefixes, "my code", "sector")
        assert found.columns == ["my code", "label", "_bucket", "low", "sector"]
        expected = {c: longest(c) if c is None or not c.startswith("13") else "a" for c in CODES}
        assert {r[0]: r.sector for r in found.collect()} == expected
        plan = physical_plan_of(found)
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    # One join for all lengths.
    assert len(re.findall(r"^\(\d+\) \w*Join", physical_plan_of(with_prefix_label(codes, listed, "my code", "sector")), re.M)) == 1
    none = spark.createDataFrame([], "prefix string, label string")
    for prefixes in ({}, none):
        assert {r.sector for r in with_prefix_label(codes, prefixes, "my code", "sector").collect()} == {None}


def test_a_code_meets_no_other_prefix_of_its_bucket(spark):
    """One bucket holds all codes and prefixes: no join compares their bounds, and no row is lost with null codes and equal rows."""
    prefixes = spark.range(1, 3000).selectExpr("concat('7', string(id)) AS prefix", "concat('to ', id) AS label")
    codes = spark.range(6000).selectExpr("if(id % 10 = 0, NULL, concat('7', string(id % 4500), 'x')) AS code", "map('a', id % 3) AS other")
    found = with_prefix_label(codes, prefixes, "code", "sector", shortest=2)
    listed = {f"7{i}" for i in range(1, 3000)}

    def expected(code):
        best = next((code[:n] for n in range(len(code), 1, -1) if code[:n] in listed), None) if code else None
        return best and f"to {best[1:]}"

    rows = found.collect()
    assert sorted((str(r.code), r.other["a"]) for r in rows) == sorted((str(r.code), r.other["a"]) for r in codes.collect())
    assert all(r.sector == expected(r.code) for r in rows) and any(r.sector for r in rows)
    plan = physical_plan_of(found)
    assert not re.search(r"^Join condition ?: .*>=", plan, re.M) and plan.count("Join condition") > 0
    # A row's part comes from all its columns, so a hot code is dealt to several, too.
    hot = with_prefix_label(spark.range(400).selectExpr("'7123' AS code", "id"), prefixes, "code", "sector", shortest=2)
    assert {(r.sector) for r in hot.collect()} == {"to 123"} and hot.count() == 400
    assert len(re.findall(r"hashpartitioning\(_bucket#\d+, _dealt#\d+", physical_plan_of(hot))) > 0


def test_intervals_are_disjoint(spark):
    table = spark.createDataFrame([(p, n) for p, n in NESTED.items() if n], "prefix string, label string")
    rows = sorted((r.low, r.high, r.label) for r in code_intervals(table, 1).collect())
    assert all(low < high for low, high, _ in rows)
    assert all(a[1] <= b[0] for a, b in zip(rows, rows[1:], strict=False))
    assert rows == sorted(_swept({p: n for p, n in NESTED.items() if n}))


def dimensions(spark):
    rows = {
        "country": [(1, "4700", "spain")],
        "hts": [(7, "0101000001", "horses", "live horses", True)],
        "sitc": [(3, "001", "animals", "live animals")],
        "naics": [(4, "1129", "other animals")],
        "trade": [(1, "Imports"), (2, "Exports")],
        "district": [(5, "49", "San Juan")],
        "unit": [(1, "kg"), (2, "no")],
    }
    return {n: spark.createDataFrame(rows[n], c.schema) for n, c in DIMENSIONS.items()}


def test_denormalise_planning_fact(spark):
    fact = spark.createDataFrame(
        [
            (1, day("2010-01-01"), 2, 7, 1, 5, 3, 4, 100, None, None, 1, 10, 2, 3),
            (2, None, 9, None, 8, None, None, None, 50, None, None, None, None, 2, None),
        ],
        STAR_PLANNING_FACT.schema,
    )
    first, second = denormalise(fact, dimensions(spark)).orderBy("data", ascending=False).collect()
    assert first.asDict() == {
        "date": day("2010-01-01"), "country": "spain", "trade_id": 2, "agri_prod": 1, "hts_code": "0101000001",
        "hts_desc": "horses", "data": 100, "unit_1": "kg", "qty_1": 10, "unit_2": "no", "qty_2": 3,
        "direction": "Exports", "sitc": "001", "naics": "1129", "district": "San Juan",
    }
    assert (second.hts_code, second.country, second.direction, second.unit_1, second.unit_2) == (
        None, None, None, None, "no",
    )


def test_denormalise_organisation_fact(spark):
    fact = spark.createDataFrame(
        [(1, day("2010-01-01"), 1, 7, 1, 100, 1, 10, None, None)], STAR_ORGANISATION_FACT.schema
    )
    row = denormalise(fact, dimensions(spark)).first().asDict()
    assert row["direction"] == "Imports" and row["unit_2"] is None and "naics" not in row


def test_denormalise_by_code(spark):
    columns = STAR_PLANNING_FACT.schema
    fact = spark.createDataFrame(
        [(1, None, 1, 7, 1, 5, 3, 4, 100, None, None, 1, 10, 2, 3), (2, None, 1, None, 1, 5, 3, None, 50, None, None, 1, 1, 2, 1),
         (3, None, 1, 8, 9, 5, 3, 4, 25, None, None, 1, 1, 2, 1)], columns)

    def values(level, prefix):
        return sorted(r.data for r in denormalise(fact, dimensions(spark), level, prefix).collect())

    assert values("total", "x") == [25, 50, 100]
    assert values("hts", "0101") == values("hts", "") == [100] and values("hts", "02") == []
    assert values("naics", "11") == [25, 100] and values("country", "sp") == [50, 100]
    row = denormalise(fact, dimensions(spark), "hts", "01").first()
    assert (row.hts_code, row.country, row.naics, row.unit_2) == ("0101000001", "spain", "1129", "no")
    with pytest.raises(ValueError, match="naics_id"):
        denormalise(spark.createDataFrame([], STAR_ORGANISATION_FACT.schema), dimensions(spark), "naics", "1")


def test_rows_without_a_key_are_dealt_to_all_tasks(spark):
    """Where a dimension is joined by a shuffle, its null keys are not one task's, and each row stays once."""
    fact = spark.range(400).selectExpr(
        "int(id) AS id", "TIMESTAMP_NTZ '2010-01-01' + make_dt_interval(int(id % 90)) AS date", "1 AS trade_id",
        "int(if(id % 4 = 0, 7, if(id % 4 = 1, 70, NULL))) AS hts_id", "1 AS country_id", "id AS data", "int(NULL) AS unit1_id", "1 AS qty_1",
        "2 AS unit2_id", "1 AS qty_2")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for key, value in zip(before, ("-1", "false"), strict=True):
        spark.conf.set(key, value)
    try:
        rows = denormalise(fact, dimensions(spark)).selectExpr("data", "hts_code", "country", "unit_1", "unit_2", "spark_partition_id() AS task").collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sorted(r.data for r in rows) == list(range(400))
    assert all((r.hts_code, r.country, r.unit_1, r.unit_2) == ("0101000001" if r.data % 4 == 0 else None, "spain", None, "no") for r in rows)
    unkeyed = [r.task for r in rows if r.data % 4 > 1]
    assert max(unkeyed.count(t) for t in set(unkeyed)) < len(unkeyed) / 2


def test_unmatched_keys(spark):
    fact = spark.createDataFrame(
        [(1, None, 1, 7, 1, 5, 3, 4, 100, None, None, 1, 10, 2, 3), (2, None, 9, 70, None, 5, 3, None, 50, None, None, 9, 1, 2, 1),
         (3, None, 9, 70, None, 5, 3, 4, 50, None, None, 1, 1, 9, 1)], STAR_PLANNING_FACT.schema)
    found = unmatched_keys(fact, dimensions(spark))
    assert sorted(map(tuple, found.collect()), key=str) == sorted([
        ("hts_id", "hts", 70, 2), ("country_id", "country", None, 2), ("naics_id", "naics", None, 1), ("unit1_id", "unit", 9, 1),
        ("unit2_id", "unit", 9, 1)], key=str)
    with_trade = unmatched_keys(fact, dimensions(spark), {"trade_id": "trade"})
    assert [tuple(r) for r in with_trade.collect()] == [("trade_id", "trade", 9, 2)]
    assert len(re.findall(r"Scan ExistingRDD", physical_plan_of(unmatched_keys(fact, dimensions(spark))).split("\n\n")[0])) == 1 + len(set(STAR_KEYS.values()))
    with pytest.raises(ValueError, match="no key"):
        unmatched_keys(fact, {})


def test_one_large_dimension_shuffles_the_fact_once(spark, tmp_path):
    small = dimensions(spark)
    spark.range(20000).selectExpr(
        "int(id) AS id", "lpad(string(id), 10, '0') AS hts_code", "string(id) AS hts_short_desc", "'' AS hts_long_desc",
        "id % 2 = 0 AS agri_prod").write.parquet(str(tmp_path / "hts"))
    for name, side in small.items():
        side.write.parquet(str(tmp_path / f"{name}_small"))
    tables = {n: spark.read.parquet(str(tmp_path / f"{n}_small")) for n in small} | {"hts": spark.read.parquet(str(tmp_path / "hts"))}
    spark.createDataFrame([], STAR_PLANNING_FACT.schema).write.parquet(str(tmp_path / "fact"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        plan = physical_plan_of(denormalise(spark.read.parquet(str(tmp_path / "fact")), tables))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin LeftOuter") <= 2 and len(re.findall(r"^\(\d+\) Exchange", plan, re.M)) == 2


def test_chapters(spark):
    codes = [101000001, 101000002, 2207100000, 2208700000, 3901000000, None]
    df = spark.createDataFrame([(c,) for c in codes], "Commodity_Code bigint")
    assert chapter_list(df, "Commodity_Code", skip=0) == [None, "10", "22", "39"]
    assert chapter_list(df, "Commodity_Code") == ["22", "39"]
    assert chapter_codes(df, "Commodity_Code", skip=9).isEmpty()
    assert chapter_codes(df.selectExpr("string(Commodity_Code) AS c"), "c", skip=1).count() == 3


def test_distinct_sorted(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "c string")
    assert column_to_list(distinct_sorted(df, "c"), "c") == [None, "a", "b"]


def test_fiscal_net_ignores_net_exports(spark):
    df = facts(
        spark, {"qty_1": 30}, {"qty_1": 10, "trade_id": 2}, {"qty_1": 99, "trade_id": 2, "hts_code": "0202000001"},
        {"qty_1": 5, "date": day("2010-07-01")},
    )
    assert {r.fiscal_year: r.net_qty for r in fiscal_net_quantity(df).collect()} == {2010: 20.0, 2011: 5.0}
