"""The registered queries: each takes a session and a data folder and returns a lazy DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aduana.functions.corrections import correct_records
from aduana.functions.frames import with_columns
from aduana.functions.units import convert_units
from aduana.operators.filters import latest_period
from aduana.operators.lookups import (
    denormalise, unmatched_keys, with_agricultural_flag, with_naics_sector, with_prefix_label,
)
from aduana.operators.ranking import distinct_sorted, in_display_order
from aduana.operators.rollup import add_net_measures, as_doubles, direction_sums_joined, grouping_columns
from aduana.plans.prices import monthly_price_statistics, price_movers, price_series
from aduana.plans.trade import chapter_codes, fiscal_net_quantity, prepare_records, trade_rollup, trade_rollup_family
from aduana.sources.contracts import ORGANISATION, PLANNING, conform
from aduana.sources.readers import promote_header
from aduana.sources.writers import concat_extracts
from workload import stored
from workload.facts import table, trade_facts

Query = Callable[[SparkSession, str], DataFrame]


# Columns of the monthly statistics by topic.
ROLLING = [f"price_{d}_{s}" for d in ("imports", "exports") for s in ("mean", "std", "low", "high")]
YEAR_ON_YEAR = ["price_imports_yoy", "price_exports_yoy", "rank_imports_shift", "rank_exports_shift"]


def rollup_query(level: str, time_frame: str, **options) -> Query:
    """`strict` is off, so that building a query starts no job."""
    needs_country = level == "country" or options.get("corrections", False)

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        facts = trade_facts(spark, sf_dir, agri=options.get("agriculture_filter", False), country=needs_country)
        return trade_rollup(facts, level, time_frame, strict=False, **options)

    return query


def full_join_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = prepare_records(trade_facts(spark, sf_dir), "hts", strict=False)
    keys = grouping_columns("hts", "monthly")
    return add_net_measures(as_doubles(direction_sums_joined(base, keys))).orderBy(*keys)


def corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    corrected = correct_records(trade_facts(spark, sf_dir, country=True))
    return corrected.select("date", "hts_code", "country", "unit_1", "qty_1")


def unit_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    converted = convert_units(trade_facts(spark, sf_dir))
    return converted.select("hts_code", "unit_1", "qty_1", "unit_2", "qty_2", "qty")


def date_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert_units(trade_facts(spark, sf_dir)).select("date", "qtr", "fiscal_year", "month", "year")


def price_quarterly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_series(trade_facts(spark, sf_dir, country=True), strict=False)


def price_agri(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = trade_facts(spark, sf_dir, agri=True, country=True)
    return price_series(facts, agriculture_filter=True, strict=False)


def price_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_series(trade_facts(spark, sf_dir, country=True), calendar=True, strict=False)


def _unsorted_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_series(trade_facts(spark, sf_dir, country=True), strict=False, sort=False)


def price_movers_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_movers(_unsorted_prices(spark, sf_dir))


def price_movers_bottom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_movers(_unsorted_prices(spark, sf_dir), largest=False)


def price_movers_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_movers(_unsorted_prices(spark, sf_dir), direction="exports")


def price_movers_drop_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The headings below 0800 have all their records in the last year here, so that they have no change yet."""
    facts = with_columns(trade_facts(spark, sf_dir, country=True), {
        "date": "if(hts_code < '08', date + make_ym_interval(2013 - year(date)), date)"})
    return price_movers(price_series(facts, strict=False, sort=False), drop_null=True)


def movers_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report in display order, which is a column here."""
    shown = in_display_order(price_movers_top(spark, sf_dir))
    return shown.selectExpr("*", "int(row_number() OVER (ORDER BY position DESC)) AS shown_at")


def prices_of_latest_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_period(_unsorted_prices(spark, sf_dir))


def price_statistics_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_price_statistics(trade_facts(spark, sf_dir, country=True), strict=False)


def _statistics(*columns: str) -> Query:
    """Some columns of the monthly statistics; Catalyst drops the windows behind the others."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        statistics = monthly_price_statistics(trade_facts(spark, sf_dir, country=True), strict=False)
        return statistics.select("hs4", "year", "month", *columns)

    return query


def price_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics over calendar months. Every third heading has its trade of March and September in the month after, so
    that its series has gaps."""
    facts = with_columns(trade_facts(spark, sf_dir, country=True), {
        "date": "if(int(substring(hts_code, 1, 4)) % 3 = 0 AND month(date) IN (3, 9), date + INTERVAL '1' MONTH, date)"})
    return monthly_price_statistics(facts, strict=False, months=True)


def fiscal_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fiscal_net_quantity(trade_facts(spark, sf_dir), strict=False)


def chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = trade_facts(spark, sf_dir).selectExpr("bigint(hts_code) AS commodity_code")
    return chapter_codes(codes, "commodity_code")


def distinct_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_sorted(trade_facts(spark, sf_dir), "hts_code")


def agri_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_agricultural_flag(trade_facts(spark, sf_dir).select("hts_code", "data"))


# One prefix of each sector, and two that no sector has.
SECTOR_PREFIXES = (
    "11 21 31 32 33 311 312 313 314 315 316 321 322 323 324 325 3254 326 327 331 332 333 334 3341 335 336 337 339 3391 "
    "99 2").split()


def naics_sector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes that meet every sector, at every prefix length, with a digit more; some are null."""
    prefixes = ", ".join(f"'{p}'" for p in SECTOR_PREFIXES)
    code = f"if(data % 37 = 0, NULL, concat(get(array({prefixes}), int(data % {len(SECTOR_PREFIXES)})), string(data % 10)))"
    return with_naics_sector(trade_facts(spark, sf_dir).selectExpr(f"{code} AS naics", "data")).select("naics", "sector", "data")


def _star(spark: SparkSession, sf_dir: str, naics: str = "r_name", unit: str = "n_name", unit_key: int = 30) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Line items as the fact, the other tables as its dimensions; some keys have no match or are null."""
    fact = table(spark, sf_dir, "lineitem").selectExpr(
        "l_shipdate AS date", "l_linenumber % 3 AS trade_id",
        "if(l_orderkey % 13 = 0, NULL, l_partkey) AS hts_id", "l_suppkey % 27 AS country_id",
        "l_linenumber - 1 AS district_id", "l_suppkey + 5 AS sitc_id", "l_linenumber AS naics_id",
        "floor(l_extendedprice) AS data", f"l_orderkey % {unit_key} AS unit1_id", "floor(l_quantity) AS qty_1",
        "l_linenumber AS unit2_id", "floor(l_quantity) * 2 AS qty_2",
    )
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    return fact, {
        "country": nation.selectExpr("n_nationkey AS id", "lower(n_name) AS country_name"),
        "hts": part.selectExpr(
            "p_partkey AS id", "lpad(string(p_partkey), 10, '0') AS hts_code", "p_name AS hts_short_desc",
            "p_size % 2 = 1 AS agri_prod",
        ),
        "sitc": supplier.selectExpr("s_suppkey AS id", "s_name AS sitc_code"),
        "naics": region.selectExpr("r_regionkey AS id", f"{naics} AS naics_code"),
        "district": region.selectExpr("r_regionkey AS id", "r_name AS district_desc"),
        "unit": nation.selectExpr("n_nationkey AS id", f"{unit} AS unit_code"),
    }


def _star_of_units(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The same with industries and units that rollups know."""
    units = "get(array('kg', 'gm', 't', 'l', 'doz', 'm3', 'pfl', 'no'), int(n_nationkey))"
    return _star(spark, sf_dir, "string(3110 + r_regionkey)", units, 9)


def star_denormalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return denormalise(*_star(spark, sf_dir))


def star_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the fact that no dimension knows."""
    return unmatched_keys(*_star(spark, sf_dir))


def star_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a star schema over the line items to a rollup by industry and quarter."""
    flat = denormalise(*_star_of_units(spark, sf_dir))
    return trade_rollup(conform(flat, PLANNING), "naics", "qtr", strict=False)


def star_prefix_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product prefix on the star schema: the product table is filtered and joined first."""
    flat = denormalise(*_star_of_units(spark, sf_dir), level="hts", level_filter="00000001")
    return trade_rollup(conform(flat, PLANNING), "hts", "yearly", strict=False)


def rollup_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sixteen layouts in one pass."""
    return trade_rollup_family(trade_facts(spark, sf_dir, country=True))


def prefix_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes by a classification with prefixes of two to seven digits, one per part; some are listed more than once."""
    prefixes = table(spark, sf_dir, "part").selectExpr(
        "left(lpad(string(p_partkey * 245489 % 100000000), 8, '0'), int(2 + p_partkey % 6)) AS prefix", "p_name AS label")
    codes = table(spark, sf_dir, "lineitem").selectExpr(
        "if(l_orderkey % 37 = 0, NULL, concat(lpad(string(l_partkey * 245489 % 100000000), 8, '0'), l_linenumber)) AS code", "l_orderkey")
    return with_prefix_label(codes, prefixes, "code", "label", shortest=2)


def union_directions(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = trade_facts(spark, sf_dir).select("trade_id", "hts_code", "data", "date")
    return concat_extracts(facts.where("trade_id = 1"), facts.where("trade_id = 2"))


def org_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records read by the organisation's contract, which does not know `naics`, by industry."""
    return trade_rollup(conform(trade_facts(spark, sf_dir), ORGANISATION), "naics", "yearly", strict=False)


def strict_prefix_yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trade_rollup(trade_facts(spark, sf_dir), "hts", "yearly", level_filter="22", strict=True)


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as landed pages, of 256 orders at most, so pages grow in number and not in size. Odd pages have a column more
    and another order, every fifth lacks one."""
    pages = trade_facts(spark, sf_dir, order=True).selectExpr(
        "orderkey div 256 AS orders", "data % 10 AS page", "hts_code AS code", "string(data) AS val", "unit_1 AS unit")

    def page(*names: str) -> str:
        header = ", ".join(f"'{n}'" for n in names)
        return f"concat(array(array({header})), transform(rows, r -> array({', '.join(f'r.{n.lower()}' for n in names)})))"

    grouped = pages.groupBy("orders", "page").agg(F.collect_list(F.struct("code", "val", "unit")).alias("rows"))
    return grouped.selectExpr(f"""to_json(
        CASE WHEN page % 10 = 5 THEN {page("UNIT", "CODE")} WHEN page % 5 = 0 THEN {page("CODE")}
             WHEN page % 2 = 1 THEN {page("VAL", "UNIT", "CODE")} ELSE {page("CODE", "VAL")} END) AS value""")


def header_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return promote_header(_responses(spark, sf_dir), ["CODE", "VAL"])


def header_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns that any page has; finding them reads the pages once more."""
    return promote_header(_responses(spark, sf_dir)).select("CODE", "VAL", "UNIT")


def queries() -> dict[str, Query]:
    rollups = {
        f"{level}_{time}": rollup_query(level, time)
        for level in ("total", "hts", "naics", "country")
        for time in ("yearly", "fiscal", "qtr", "monthly")
    }
    return rollups | stored.queries() | {
        "hts_prefix_yearly": rollup_query("hts", "yearly", level_filter="22"),
        "naics_prefix_qtr": rollup_query("naics", "qtr", level_filter="32"),
        "country_prefix_fiscal": rollup_query("country", "fiscal", level_filter="nation_1"),
        "agri_yearly": rollup_query("hts", "yearly", agriculture_filter=True),
        "range_monthly": rollup_query("total", "monthly", datetime="2008-02-15+2010-06-30"),
        "year_qtr": rollup_query("hts", "qtr", datetime="2009"),
        "corrected_hts_yearly": rollup_query("hts", "yearly", corrections=True),
        "full_join_rollup": full_join_rollup,
        "corrections": corrections,
        "unit_conversion": unit_conversion,
        "date_dims": date_dims,
        "price_quarterly": price_quarterly,
        "price_agri": price_agri,
        "price_calendar": price_calendar,
        "price_movers_top": price_movers_top,
        "price_movers_bottom": price_movers_bottom,
        "price_movers_exports": price_movers_exports,
        "price_movers_drop_null": price_movers_drop_null,
        "movers_display": movers_display,
        "latest_period": prices_of_latest_period,
        "price_statistics_monthly": price_statistics_monthly,
        "price_rolling": _statistics(*ROLLING),
        "price_rank": _statistics("price_imports", "price_exports", "rank_imports", "rank_exports"),
        "price_yoy_monthly": _statistics(*YEAR_ON_YEAR),
        "price_months": price_months,
        "fiscal_net": fiscal_net,
        "chapters": chapters,
        "distinct_codes": distinct_codes,
        "agri_flag": agri_flag,
        "naics_sector": naics_sector,
        "star_denormalise": star_denormalise,
        "union_directions": union_directions,
        "header_rows": header_rows,
        "header_union": header_union,
        "star_rollup": star_rollup,
        "star_prefix_rollup": star_prefix_rollup,
        "star_unmatched": star_unmatched,
        "rollup_layouts": rollup_layouts,
        "prefix_label": prefix_label,
        "org_rollup": org_rollup,
        "strict_prefix_yearly": strict_prefix_yearly,
    }
