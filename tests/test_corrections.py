from __future__ import annotations

import pytest
from frames import day, facts

from aduana.functions.corrections import correct_records

OILCAKE = {"date": day("2007-03-15"), "qty_1": 7540542599, "hts_code": "2304000000", "unit_1": "kg"}
BITUMEN = {"date": day("2008-06-30T23:00:00"), "qty_1": 5000000, "hts_code": "2714900000", "unit_1": "kg"}
OATS = {"date": day("2012-01-01"), "qty_1": 5, "hts_code": "1004900000", "unit_1": "t", "country": "canada"}


@pytest.mark.parametrize(
    ("record", "qty", "unit"),
    [
        (OILCAKE, 10648031, "kg"),
        (OILCAKE | {"date": day("2007-04-01")}, 7540542599, "kg"),
        (OILCAKE | {"date": day("2007-02-28T23:59:59")}, 7540542599, "kg"),
        (OILCAKE | {"qty_1": 7540542598}, 7540542598, "kg"),
        (OILCAKE | {"hts_code": "2304000001"}, 7540542599, "kg"),
        (OILCAKE | {"hts_code": None}, 7540542599, "kg"),
        (OILCAKE | {"date": None}, 7540542599, "kg"),
        (OILCAKE | {"qty_1": None}, None, "kg"),
        (OILCAKE | {"country": None}, 10648031, "kg"),
        (BITUMEN, 50000, "kg"),
        (BITUMEN | {"date": day("2009-06-15")}, 5000000, "kg"),
        (OATS, 5, "kg"),
        (OATS | {"date": day("2017-12-31T12:00:00")}, 5, "kg"),
        (OATS | {"date": day("2018-01-01")}, 5, "t"),
        (OATS | {"date": day("2011-12-31")}, 5, "t"),
        (OATS | {"unit_1": "T"}, 5, "T"),
        (OATS | {"country": "united states"}, 5, "t"),
        (OATS | {"country": "United States"}, 5, "kg"),
        (OATS | {"country": None}, 5, "t"),
        (OATS | {"unit_1": None}, 5, None),
    ],
)
def test_rules(spark, record, qty, unit):
    df = facts(spark, record)
    corrected = correct_records(df)
    assert corrected.schema == df.schema
    row = corrected.first()
    assert (row.qty_1, row.unit_1) == (qty, unit)
