"""Customs records derived from the benchmark tables `lineitem`, `part`, `supplier` and `nation`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns read from each table; with the schema given, reading starts no job for the file footers.
SCHEMAS = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "part": "p_partkey bigint, p_name string, p_size int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# Dates are 12 years later than the ship dates, so that they meet the periods of the known corrections.
DATED = [
    "*", "l_partkey % 40 AS bk", "floor(l_quantity) AS quantity",
    "if(l_orderkey % 997 = 0, NULL, l_shipdate + INTERVAL '12' YEAR) AS date",
]

# The code is written so that Catalyst reduces "hts_code is not null" to a test of `bk`.
RECORDS = {
    "trade_id": "CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'N' THEN 2 WHEN l_linestatus = 'O' THEN 1 ELSE 3 END",
    "hts_code": """
        CASE WHEN bk <> 0 THEN coalesce(
          CASE WHEN bk > 6
            THEN lpad(string((101 + (l_partkey % 97) * 20) * 1000000 + l_partkey % 7), 10, '0')
            ELSE get(array('2207100000', '2208700000', '2203000000', '1004900000', '2304000000', '2714900000'),
                     int(bk) - 1) END, '') END""",
    "naics": "get(array(NULL, '3254', '3256', '3341', '3391', '1111', '2123', '3111'), int(l_partkey % 8))",
    "data": "floor(l_extendedprice)",
    "unit_1": """
        if(bk = 4, get(array('t', 'T'), l_linenumber % 2),
           get(array('kg', 'KG', 'gm', 't', 'l', 'doz', 'm3', 'pfl', 'no'), int(l_orderkey % 10)))""",
    "qty_1": """
        CASE WHEN bk = 5 AND date >= TIMESTAMP_NTZ '2007-03-01' AND date < TIMESTAMP_NTZ '2007-04-01' THEN 7540542599
             WHEN bk = 6 AND date >= TIMESTAMP_NTZ '2008-06-01' AND date < TIMESTAMP_NTZ '2008-07-01' THEN 5000000
             WHEN l_linenumber = 7 AND l_orderkey % 5 = 0 THEN NULL
             ELSE quantity END""",
    "unit_2": "get(array('kg', 'gm', 't', 'l', 'pfl', 'No'), l_linenumber - 1)",
    "qty_2": "if(l_orderkey % 11 = 0, NULL, quantity * 2)",
    "date": "date",
}

AGRI_PROD = "if(p_size % 25 = 0, NULL, p_size % 2)"

COUNTRY = "CASE n_nationkey WHEN 23 THEN NULL WHEN 24 THEN 'united states' ELSE lower(n_name) END"


def trade_facts(
    spark: SparkSession, sf_dir: str, *, agri: bool = False, country: bool = False, order: bool = False
) -> DataFrame:
    """Trade records; `agri_prod` and `country` are looked up only when asked for, and `orderkey` comes with `order`.

    Their tables are joined on primary keys from the outside, so a record is never lost or repeated, and a
    query that reads neither column needs no join at all. Spark picks the join by the size of each table.
    """
    items = table(spark, sf_dir, "lineitem")
    columns = dict(RECORDS) | ({"orderkey": "l_orderkey"} if order else {})
    if agri:
        parts = table(spark, sf_dir, "part")
        items = items.join(parts, F.expr("l_partkey = p_partkey"), "left")
        columns["agri_prod"] = AGRI_PROD
    if country:
        suppliers = table(spark, sf_dir, "supplier").join(
            table(spark, sf_dir, "nation"), F.expr("s_nationkey = n_nationkey"), "left"
        )
        items = items.join(suppliers, F.expr("l_suppkey = s_suppkey"), "left")
        columns["country"] = COUNTRY
    return items.selectExpr(*DATED).selectExpr(*(f"{text} AS {name}" for name, text in columns.items()))
