"""Known errors in the published records and the values that replace them."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from aduana.functions.codes import text_literal
from aduana.functions.dates import ntz
from aduana.functions.frames import with_columns


class Correction(NamedTuple):
    column: str
    wrong: int | str
    right: int | str
    hts_code: str
    first_day: str
    end_day: str  # exclusive
    except_country: str | None = None


# Records known to be wrong.
CORRECTIONS = (
    Correction("qty_1", 7540542599, 10648031, "2304000000", "2007-03-01", "2007-04-01"),
    Correction("qty_1", 5000000, 50000, "2714900000", "2008-06-01", "2008-07-01"),
    Correction("unit_1", "t", "kg", "1004900000", "2012-01-01", "2018-01-01", "united states"),
)


def _literal(value: int | str) -> str:
    return text_literal(value) if isinstance(value, str) else str(value)


def _branch(rule: Correction) -> str:
    country = "" if rule.except_country is None else f" AND country <> {text_literal(rule.except_country)}"
    return (
        f"WHEN hts_code = '{rule.hts_code}' AND {rule.column} = {_literal(rule.wrong)} "
        f"AND date >= {ntz(rule.first_day)} AND date < {ntz(rule.end_day)}{country} THEN {_literal(rule.right)}"
    )


def correct_records(facts: DataFrame) -> DataFrame:
    """Replace the wrong values. Units and countries are compared as stored, case included; a null never matches."""
    columns = dict.fromkeys(rule.column for rule in CORRECTIONS)
    return with_columns(facts, {
        column: f"CASE {' '.join(_branch(r) for r in CORRECTIONS if r.column == column)} ELSE {column} END"
        for column in columns
    })
