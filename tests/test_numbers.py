from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from aduana import price_series, trade_rollup
from aduana.functions.numbers import clamp, float_divide, percent_change, sum_or_zero
from frames import facts

INF, NAN = math.inf, math.nan


def same(a, b) -> bool:
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


@pytest.mark.parametrize(
    ("x", "y", "expected"),
    [
        (1.0, 4.0, 0.25), (5.0, 0.0, INF), (-5.0, 0.0, -INF), (0.0, 0.0, NAN), (NAN, 0.0, NAN), (NAN, 2.0, NAN),
        (None, 0.0, None), (1.0, None, None), (0.0, 3.0, 0.0),
    ],
)
def test_float_divide(spark, x, y, expected):
    df = spark.createDataFrame([(x, y)], "x double, y double")
    assert same(df.select(F.expr(float_divide("x", "y"))).first()[0], expected)


@pytest.mark.parametrize(
    ("now", "before", "expected"),
    [(5.0, 0.0, INF), (0.0, 0.0, NAN), (0.0, 5.0, -100.0), (6.0, 4.0, 50.0), (6.0, None, None), (None, 4.0, None)],
)
def test_percent_change(spark, now, before, expected):
    df = spark.createDataFrame([(now, before)], "now double, before double")
    assert same(df.select(F.expr(percent_change("now", "before"))).first()[0], expected)


def test_clamp_passes_null_and_nan(spark):
    values = [None, NAN, -INF, -101.0, -100.0, 0.0, 100.0, 100.5, INF]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    both = [r[0] for r in df.orderBy("i").select(F.expr(clamp("v", -100.0, 100.0))).collect()]
    assert all(same(a, b) for a, b in zip(both, [None, NAN, -100.0, -100.0, -100.0, 0.0, 100.0, 100.0, 100.0]))
    floor = [r[0] for r in df.orderBy("i").select(F.expr(clamp("v", low=0.0))).collect()]
    assert all(same(a, b) for a, b in zip(floor, [None, NAN, 0.0, 0.0, 0.0, 0.0, 100.0, 100.5, INF]))


def test_whole_quantities_add_up_exactly_in_any_order(spark):
    """Each sum is the true sum, rounded once, however the rows are dealt out; digits and range go beyond 64 bits."""
    rng = random.Random(7)
    factors = {"kg": 1, "gm": Fraction(1, 1000), "t": 1000, "doz": Fraction("0.70874"), "m3": Fraction("353.8322")}
    records = [
        {"unit_1": rng.choice(list(factors)), "qty_1": rng.randrange(10 ** rng.randrange(1, 19)), "country": f"c{k % 3}"}
        for k in range(3000)
    ]
    true = {c: sum(factors[r["unit_1"]] * r["qty_1"] for r in records if r["country"] == c) for c in ("c0", "c1", "c2")}
    for partitions in (1, 7):
        rng.shuffle(records)
        df = facts(spark, *records).repartition(partitions)
        found = {r.country: r.imports_qty for r in trade_rollup(df, "country", "yearly").collect()}
        assert found == {c: float(v) for c, v in true.items()}


def test_quantities_beyond_64_bits(spark):
    two = trade_rollup(facts(spark, *[{"unit_1": "t", "qty_1": 6 * 10**15}] * 2), "total", "yearly").first()
    assert two.imports_qty == 1.2e19
    one = trade_rollup(facts(spark, {"unit_1": "t", "qty_1": 9 * 10**18}), "total", "yearly").first()
    assert one.imports_qty == 9e21


def test_small_fractional_quantities_are_kept(spark):
    df = facts(spark, {}).selectExpr("* EXCEPT (qty_1)", "0.000004D AS qty_1")
    assert trade_rollup(df, "total", "yearly").first().imports_qty == 4e-06
    assert math.isclose(price_series(df).first().price_imports, 25_000_000)


def test_sum_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    assert df.agg(F.expr(sum_or_zero("v"))).first()[0] == 0.0
