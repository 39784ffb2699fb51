"""Hand-written records."""

from __future__ import annotations

from datetime import datetime

FACT = (
    "trade_id int, hts_code string, agri_prod int, country string, naics string, data bigint, "
    "unit_1 string, qty_1 bigint, unit_2 string, qty_2 bigint, date timestamp_ntz"
)

DEFAULTS = {
    "trade_id": 1, "hts_code": "0101000001", "agri_prod": 0, "country": "spain", "naics": "3111", "data": 100,
    "unit_1": "kg", "qty_1": 10, "unit_2": None, "qty_2": None, "date": datetime(2010, 5, 1),
}


def facts(spark, *records: dict):
    """Fact rows; a record states what differs from the defaults."""
    return spark.createDataFrame([tuple((DEFAULTS | r)[c] for c in DEFAULTS) for r in records], FACT)


def day(text: str) -> datetime:
    return datetime.fromisoformat(text)


def physical_plan_of(df) -> str:
    """The physical plan before adaptive changes, with nothing abbreviated."""
    modes = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode
    return df._jdf.queryExecution().explainString(modes.fromString("formatted"))
