"""Column contracts of the landing tables and of the star schema."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aduana.functions.frames import quoted

TEXT, INT, LONG, FLOAT, FLAG = T.StringType(), T.IntegerType(), T.LongType(), T.FloatType(), T.BooleanType()
MOMENT = T.TimestampNTZType()


class Contract(NamedTuple):
    """Name, columns and default values of one table."""

    name: str
    columns: dict[str, T.DataType]
    defaults: dict[str, str] = {}

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, t) for c, t in self.columns.items()])

    def ddl(self) -> str:
        return ", ".join(
            f"`{c}` {t.simpleString()}" + (f" DEFAULT {self.defaults[c]}" if c in self.defaults else "")
            for c, t in self.columns.items()
        )


# Fixed values from here on: table names, column names, types and defaults.
_MEASURE_DEFAULTS = {"data": "0", "qty_1": "0", "qty_2": "0"}

ORGANISATION = Contract(
    "inttradedata",
    {
        "trade_id": INT, "hts_code": TEXT, "hts_desc": TEXT, "agri_prod": INT, "country": TEXT, "data": LONG,
        "unit_1": TEXT, "qty_1": LONG, "unit_2": TEXT, "qty_2": LONG, "date": MOMENT,
    },
    _MEASURE_DEFAULTS,
)

PLANNING = Contract(
    "jptradedata",
    {
        "date": MOMENT, "country": TEXT, "trade_id": INT, "agri_prod": INT, "hts_code": TEXT, "hts_desc": TEXT,
        "data": LONG, "sitc": TEXT, "naics": TEXT, "unit_1": TEXT, "qty_1": LONG, "unit_2": TEXT, "qty_2": LONG,
    },
    _MEASURE_DEFAULTS,
)

_COMTRADE_FLOATS = {"qty", "altQty", "netWgt", "grossWgt", "cifvalue", "fobvalue", "primaryValue"}
_COMTRADE_COLUMNS = """
    typeCode freqCode refPeriodId refYear refMonth period reporterCode reporterISO reporterDesc flowCode flowDesc
    partnerCode partnerISO partnerDesc partner2Code partner2ISO partner2Desc classificationCode
    classificationSearchCode isOriginalClassification cmdCode cmdDesc aggrLevel isLeaf customsCode customsDesc
    mosCode motCode motDesc qtyUnitCode qtyUnitAbbr qty isQtyEstimated altQtyUnitCode altQtyUnitAbbr altQty
    isAltQtyEstimated netWgt isNetWgtEstimated grossWgt isGrossWgtEstimated cifvalue fobvalue primaryValue
    legacyEstimationFlag isReported isAggregate
""".split()

COMTRADE = Contract("comtradetable", {c: FLOAT if c in _COMTRADE_FLOATS else TEXT for c in _COMTRADE_COLUMNS})

_NOW = "localtimestamp()"

STAR_PLANNING_FACT = Contract(
    "jptradedata_star",
    {
        "id": INT, "date": MOMENT, "trade_id": INT, "hts_id": INT, "country_id": INT, "district_id": INT,
        "sitc_id": INT, "naics_id": INT, "data": INT, "end_use_i": INT, "end_use_e": INT, "unit1_id": INT,
        "qty_1": INT, "unit2_id": INT, "qty_2": INT,
    },
    {"date": _NOW, "hts_id": "1"} | _MEASURE_DEFAULTS,
)

STAR_ORGANISATION_FACT = Contract(
    "inttradedata_star",
    {
        "id": INT, "date": MOMENT, "trade_id": INT, "hts_id": INT, "country_id": INT, "data": LONG, "unit1_id": INT,
        "qty_1": LONG, "unit2_id": INT, "qty_2": LONG,
    },
    {"date": _NOW} | _MEASURE_DEFAULTS,
)

DIMENSIONS = {
    "country": Contract("countrytable", {"id": INT, "cty_code": TEXT, "country_name": TEXT}),
    "hts": Contract(
        "htstable",
        {"id": INT, "hts_code": TEXT, "hts_short_desc": TEXT, "hts_long_desc": TEXT, "agri_prod": FLAG},
    ),
    "sitc": Contract("sitctable", {"id": INT, "sitc_code": TEXT, "sitc_short_desc": TEXT, "sitc_long_desc": TEXT}),
    "naics": Contract("naicstable", {"id": INT, "naics_code": TEXT, "naics_description": TEXT}),
    "trade": Contract("tradetable", {"id": INT, "trade": TEXT}),
    "district": Contract("districttable", {"id": INT, "district_code": TEXT, "district_desc": TEXT}),
    "unit": Contract("unittable", {"id": INT, "unit_code": TEXT}),
}

STAR = (STAR_PLANNING_FACT, STAR_ORGANISATION_FACT, *DIMENSIONS.values())


def create_table(spark: SparkSession, contract: Contract, name: str | None = None) -> str:
    """Create the catalog table of a contract unless it exists, and return its name."""
    table = name or contract.name
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({contract.ddl()}) USING parquet")
    return table


def conform(df: DataFrame, contract: Contract, needed: tuple[str, ...] = ()) -> DataFrame:
    """The contract's columns that exist, in its types, followed by all others as they are.

    Only a missing column of `needed` is an error: an operation names what it reads, and Catalyst drops the rest. A
    column that already has the right type is passed through, so filters on it still reach the scan.
    """
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"{contract.name}: columns {missing} are missing")
    return df.select(
        *(F.col(c).cast(t).alias(c) for c, t in contract.columns.items() if c in df.columns),
        *(F.col(quoted(c)) for c in df.columns if c not in contract.columns),
    )
