"""Queries over facts that are laid out in the shared folder first, with the library's own writers.

The folder belongs to the application and the data folder; a table that is there in full is not written again.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aduana.plans.trade import trade_rollup
from aduana.session import shared_folder
from aduana.sources.contracts import COMTRADE, ORGANISATION, PLANNING, Contract, conform
from aduana.sources.readers import read_csv_with_rejects, read_header_records, read_latest, read_parquet_tree, read_source
from aduana.sources.writers import ingest_facts, write_csv, write_facts, write_parquet
from workload.facts import trade_facts


def _folder(spark: SparkSession, sf_dir: str, name: str) -> str:
    data = hashlib.md5(sf_dir.encode()).hexdigest()[:12]
    return f"{shared_folder(spark)}/trade-{spark.sparkContext.applicationId}-{data}/{name}"


def _facts(spark: SparkSession, sf_dir: str, contract: Contract) -> DataFrame:
    """All records in all columns of a contract."""
    records = trade_facts(spark, sf_dir, agri=True, country=True)
    absent = [f"CAST(NULL AS STRING) AS {c}" for c in contract.columns if c not in records.columns]
    return conform(records.selectExpr("*", *absent), contract).select(*contract.columns)


def stored_facts(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Both fact tables by source name."""
    places = {}
    for source, contract in (("org", ORGANISATION), ("jp", PLANNING)):
        places[source] = _folder(spark, sf_dir, source)
        write_facts(_facts(spark, sf_dir, contract), places[source])
    return places


def stored_org_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of dates and a product prefix: folders of other years and row groups of other products are not read."""
    facts = read_source(spark, stored_facts(spark, sf_dir), "org")
    return trade_rollup(
        facts, "hts", "monthly", datetime="2009-03-01+2010-10-15", corrections=True, level_filter="22", strict=False)


def stored_jp_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One year of agricultural products by industry."""
    facts = read_source(spark, stored_facts(spark, sf_dir), "jp")
    return trade_rollup(facts, "naics", "qtr", datetime="2010", agriculture_filter=True, level_filter="3", strict=False)


def stored_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the latest date, found in the files' footers."""
    return read_latest(spark, stored_facts(spark, sf_dir), "org").select("date", "trade_id", "hts_code", "country", "data")


def ingested_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored facts whose year 2010 comes anew from two CSV extracts, with twice the value."""
    facts, path = _facts(spark, sf_dir, ORGANISATION), _folder(spark, sf_dir, "ingested")
    write_facts(facts, path)
    revised = facts.where("date >= TIMESTAMP_NTZ '2010-01-01' AND date < TIMESTAMP_NTZ '2011-01-01'").withColumn("data", facts["data"] * 2)
    imports, exports = _folder(spark, sf_dir, "imports-2010"), _folder(spark, sf_dir, "exports-2010")
    write_csv(revised.where("trade_id = 1"), imports)
    write_csv(revised.where("trade_id <> 1"), exports)
    ingest_facts(spark, imports, exports, ORGANISATION, path, only_years=True)
    return trade_rollup(read_source(spark, {"org": path}), "hts", "yearly", strict=False)


def landed_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed records in their wide contract, of files at several depths below one folder; a folder beside it is not read."""
    root = _folder(spark, sf_dir, "landed")
    records = trade_facts(spark, sf_dir).selectExpr(
        "trade_id", "string(year(date)) AS refYear", "CASE trade_id WHEN 1 THEN 'M' WHEN 2 THEN 'X' ELSE 'other' END AS flowCode",
        "hts_code AS cmdCode", "data AS primaryValue", "qty_1 AS qty")
    for trade_id, place in ((1, "316/imports"), (2, "316/2010/a/exports"), (3, "317/others")):
        write_parquet(conform(records.where(f"trade_id = {trade_id}").drop("trade_id"), COMTRADE), f"{root}/{place}")
    landed = conform(read_parquet_tree(spark, f"{root}/316", "*.parquet"), COMTRADE, ("flowCode", "refYear", "primaryValue"))
    return landed.groupBy("flowCode", "refYear").agg(
        F.count("*").alias("records"), F.sum(F.col("primaryValue").cast("long")).alias("value"), F.sum(F.col("qty").cast("double")).alias("quantity"))


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of a CSV extract that are no numbers and no dates, counted by column, and the rows that stay with them."""
    path = _folder(spark, sf_dir, "untidy")
    write_csv(trade_facts(spark, sf_dir, order=True).selectExpr(
        "hts_code", "if(data % 50 = 0, 'n/a', string(data)) AS data", "if(data % 70 = 0, '12.5', string(qty_1)) AS qty_1",
        "if(orderkey % 90 = 0, 'soon', date_format(date, 'yyyy-MM-dd')) AS day"), path)
    rows, rejects = read_csv_with_rejects(spark, path, "hts_code string, data bigint, qty_1 bigint, day date")
    found = rejects.groupBy("field", "value").count()
    kept = rows.selectExpr("'(rows)' AS field", "'' AS value").groupBy("field", "value").count()
    return found.unionByName(kept).selectExpr("field", "value", "count AS cells")


def header_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed responses of many rows each, read record by record; odd ones have a column more and another order."""
    path = _folder(spark, sf_dir, "responses")
    facts = trade_facts(spark, sf_dir, order=True)
    pages = facts.selectExpr("orderkey div 20000 AS page", "hts_code AS code", "string(data) AS val", "unit_1 AS unit")
    pages = pages.selectExpr("*", "row_number() OVER (PARTITION BY page ORDER BY val) AS place", "count(1) OVER (PARTITION BY page) AS n")
    row = "if(page % 2 = 1, to_json(array(val, unit, code)), to_json(array(code, val)))"
    header = """if(page % 2 = 1, '[["VAL", "UNIT", "CODE"],', '[["CODE", "VAL"],')"""
    lines = pages.selectExpr("page", "place", f"concat(if(place = 1, {header}, ''), {row}, if(place = n, ']', ',')) AS value")
    write_text_files(lines, path)
    return read_header_records(spark, path, ["CODE", "VAL", "UNIT"])


def write_text_files(lines: DataFrame, path: str) -> None:
    """One file per page, its lines in order."""
    ordered = lines.repartition("page").sortWithinPartitions("page", "place").select("page", "value")
    ordered.write.mode("ignore").partitionBy("page").text(path)


def queries() -> dict:
    found = (stored_org_rollup, stored_jp_rollup, stored_latest, landed_tree, ingested_update, csv_rejects, header_split)
    return {f.__name__: f for f in found}
