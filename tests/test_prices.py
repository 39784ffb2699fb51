from __future__ import annotations

import math

from frames import day, facts

from aduana import monthly_price_statistics, price_movers, price_series
from aduana.operators.ranking import extremes_of_latest, in_display_order
from aduana.operators.series import add_calendar_change, add_market_rank, add_rank_shift, add_row_change

QUARTERS = ["2010-01-10", "2010-04-10", "2010-07-10", "2010-10-10", "2011-01-10", "2011-04-10", "2011-07-10"]


def record(date, data, qty=10, trade_id=1, code="0101000001", **more):
    return {"date": date and day(date), "data": data, "qty_1": qty, "trade_id": trade_id, "hts_code": code} | more


def by_date(df, column):
    return [(r.date and r.date.date().isoformat(), r[column]) for r in df.orderBy("hs4", "date").collect()]


def test_products_without_quantity_count_as_one_each(spark):
    df = facts(
        spark, record("2010-01-10", 100, 10), record("2010-02-10", 50, 0, code="0101000002"),
        record("2010-03-10", 50, 5, code="0101000003", unit_1="no"), record("2010-03-10", 9, 3, 2, "0102000001"),
    )
    first, second = price_series(df).collect()
    assert (first.hs4, first.imports, first.imports_qty, first.price_imports) == ("0101", 200, 12.0, 200 / 12)
    assert (first.exports, first.exports_qty, first.price_exports) == (0, 3.0, 0.0)
    assert (second.hs4, second.imports_qty, second.price_exports) == ("0102", 1.0, 3.0)


def test_series_schema(spark):
    assert [(f.name, f.dataType.simpleString()) for f in price_series(facts(spark, {})).schema] == [
        ("year", "int"), ("qtr", "int"), ("hs4", "string"), ("imports", "bigint"), ("exports", "bigint"),
        ("imports_qty", "double"), ("exports_qty", "double"), ("price_imports", "double"), ("price_exports", "double"),
        ("date", "timestamp_ntz"), ("price_imports_yoy", "double"), ("price_exports_yoy", "double"),
    ]


def test_change_counts_rows_or_calendar_quarters(spark):
    present = [q for q in QUARTERS if q != "2010-07-10"]
    df = facts(spark, *(record(q, 100 * (i + 1)) for i, q in enumerate(present)))
    by_rows = by_date(price_series(df), "price_imports_yoy")
    assert by_rows == [
        ("2010-01-01", None), ("2010-04-01", None), ("2010-10-01", None), ("2011-01-01", None),
        ("2011-04-01", 400.0), ("2011-07-01", 200.0),
    ]
    by_calendar = by_date(price_series(df, calendar=True), "price_imports_yoy")
    assert by_calendar == [
        ("2010-01-01", None), ("2010-04-01", None), ("2010-10-01", None), ("2011-01-01", 300.0),
        ("2011-04-01", 150.0), ("2011-07-01", None),
    ]


def test_a_row_without_date_counts_in_the_series(spark):
    df = facts(spark, record(None, 70), *(record(q, 100) for q in QUARTERS[:4]))
    changes = by_date(price_series(df), "price_imports_yoy")
    assert changes[0] == (None, None) and changes[4][0] == "2010-10-01"
    assert math.isclose(changes[4][1], (10 - 7) / 7 * 100)
    assert all(c is None for _, c in by_date(price_series(df, calendar=True), "price_imports_yoy"))


def test_change_from_zero(spark):
    prices = spark.createDataFrame(
        [("a", day(d), p, 0.0) for d, p in zip(QUARTERS, (0.0, 0.0, 5.0, 5.0, 0.0))],
        "hs4 string, date timestamp_ntz, price_imports double, price_exports double",
    )
    found = [c for _, c in by_date(add_row_change(prices, 1), "price_imports_yoy")]
    assert found[0] is None and math.isnan(found[1]) and found[2:] == [math.inf, 0.0, -100.0]


def test_calendar_change_by_month(spark):
    prices = spark.createDataFrame(
        [("a", 2010, 1, 4.0, 1.0), ("a", 2011, 1, 6.0, 1.0), ("a", 2011, 2, 6.0, 1.0), ("b", 2012, 1, 6.0, 1.0)],
        "hs4 string, year int, month int, price_imports double, price_exports double",
    )
    found = add_calendar_change(prices, "month").orderBy("hs4", "year", "month").collect()
    assert [r.price_imports_yoy for r in found] == [None, 50.0, None, None]


def test_corrections_always_apply(spark):
    df = facts(spark, record("2012-03-01", 100, 4, code="1004900000", unit_1="t", country="canada"))
    assert price_series(df).first().imports_qty == 4.0


def test_agricultural_series(spark):
    df = facts(spark, record("2010-01-10", 100, agri_prod=1), record("2010-01-10", 100, code="2207100000"))
    assert [r.hs4 for r in price_series(df, agriculture_filter=True).collect()] == ["0101"]


def test_monthly_statistics(spark):
    months = [f"2010-{m:02d}-05" for m in range(1, 13)] + ["2011-01-05"]
    df = facts(
        spark, *(record(m, 10 * (i + 1)) for i, m in enumerate(months)),
        *(record(m, 65, code="0202000001") for m in months),
    )
    rows = [r for r in monthly_price_statistics(df).collect() if r.hs4 == "0101"]
    assert [r.price_imports for r in rows] == [float(i) for i in range(1, 14)]
    assert [r.price_imports_mean for r in rows] == [None, None, *(float(i) for i in range(2, 13))]
    assert [r.price_imports_std for r in rows] == [None, None, *([1.0] * 11)]
    assert (rows[2].price_imports_low, rows[2].price_imports_high) == (0.0, 4.0)
    assert [r.rank_imports for r in rows] == [2] * 6 + [1] * 7
    assert [r.rank_imports_shift for r in rows] == [None] * 12 + [1]
    assert [r.price_imports_yoy for r in rows] == [None] * 12 + [1200.0]


def test_statistics_over_calendar_months(spark):
    """A month without trade leaves gaps behind it; rows without a date have no statistics."""
    months = ["2010-01-05", "2010-02-05", "2010-03-05", "2010-05-05", "2010-06-05", "2010-07-05", "2011-01-05", "2011-05-05"]
    df = facts(
        spark, *(record(m, 10 * (i + 1)) for i, m in enumerate(months)), record(None, 5),
        *(record(m, 35, code="0202000001") for m in months))
    rows = [r for r in monthly_price_statistics(df, months=True).collect() if r.hs4 == "0101"]
    assert [(r.year, r.month) for r in rows][:2] == [(None, None), (2010, 1)]
    assert [r.price_imports_mean for r in rows] == [None, None, None, 2.0, None, None, 5.0, None, None]
    assert [r.price_imports_std for r in rows] == [None, None, None, 1.0, None, None, 1.0, None, None]
    assert (rows[6].price_imports_low, rows[6].price_imports_high) == (3.0, 7.0)
    assert [r.price_imports_yoy for r in rows] == [None] * 7 + [600.0, 100.0]
    assert [r.rank_imports for r in rows][1:] == [2, 2, 2, 1, 1, 1, 1, 1]
    assert [r.rank_imports_shift for r in rows] == [None] * 7 + [1, 0]
    by_rows = [r for r in monthly_price_statistics(df).collect() if r.hs4 == "0101"]
    assert [r.price_imports_mean is None for r in by_rows] == [True, True] + [False] * 7


def test_equal_prices_share_a_rank(spark):
    prices = spark.createDataFrame(
        [(h, 2010, 1, p, 0.0) for h, p in (("a", 5.0), ("b", 9.0), ("c", 5.0), ("d", 1.0))],
        "hs4 string, year int, month int, price_imports double, price_exports double",
    )
    ranks = {r.hs4: r.rank_imports for r in add_market_rank(prices).collect()}
    assert ranks == {"a": 2, "b": 1, "c": 2, "d": 4}


def test_rank_shift_is_positive_upwards(spark):
    ranked = spark.createDataFrame(
        [("a", day("2010-01-01"), 5, 1), ("a", day("2010-02-01"), 2, 4)],
        "hs4 string, date timestamp_ntz, rank_imports int, rank_exports int",
    )
    last = add_rank_shift(ranked, rows=1).orderBy("date").collect()[1]
    assert (last.rank_imports_shift, last.rank_exports_shift) == (3, -3)


NAN, INF = math.nan, math.inf
LATEST = {"a": 5.0, "b": None, "c": NAN, "d": INF, "e": -3.0, "f": 5.0, "g": None}


def movers_frame(spark):
    rows = [(k, day("2011-01-01"), v) for k, v in LATEST.items()]
    rows += [(k, day("2010-01-01"), 1000.0) for k in "xyzabcdefg"] + [("n", None, 2000.0)]
    return spark.createDataFrame(rows, "hs4 string, date timestamp_ntz, v double").repartition(4)


def order_of(df):
    return [r.hs4 for r in df.orderBy("position").collect()]


def test_extremes_of_the_latest_date(spark):
    df = movers_frame(spark)

    def top(k, **options):
        return order_of(extremes_of_latest(df, "v", k, key="hs4", **options))

    assert top(50, largest=True) == ["b", "g", "c", "d", "a", "f", "e"]
    assert top(50, largest=False) == ["b", "g", "e", "a", "f", "d", "c"]
    assert top(3, largest=True) == ["b", "g", "c"]
    assert top(50, largest=True, drop_null=True) == ["c", "d", "a", "f", "e"]
    assert top(2, largest=False, drop_null=True) == ["e", "a"]


def test_extremes_without_any_date(spark):
    df = movers_frame(spark).where("date IS NULL")
    assert extremes_of_latest(df, "v", 5, largest=True, key="hs4").isEmpty()


def test_display_order_is_reversed(spark):
    report = extremes_of_latest(movers_frame(spark), "v", 3, largest=True, key="hs4")
    assert [r.position for r in in_display_order(report).collect()] == [3, 2, 1]


def test_movers_clamp_the_plotted_change(spark):
    headings = {"0101000001": (10, 40), "0202000001": (10, 12), "0303000001": (10, 0), "0404000001": (0, 10)}
    records = []
    for code, (before, now) in headings.items():
        records += [record(q, before, 1, code=code) for q in QUARTERS[:4]] + [record(QUARTERS[4], now, 1, code=code)]
    top = price_movers(price_series(facts(spark, *records), sort=False)).orderBy("position").collect()
    assert [(r.hs4, r.actual_yoy, r.plot_yoy) for r in top] == [
        ("0404", INF, 100.0), ("0101", 300.0, 100.0), ("0202", 20.0, 20.0), ("0303", -100.0, -100.0),
    ]
    bottom = price_movers(price_series(facts(spark, *records), sort=False), 1, largest=False).collect()
    assert [(r.hs4, r.position) for r in bottom] == [("0303", 1)]
