"""Object front end: one session, the places of the two fact tables, and the operations as methods."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aduana.functions.corrections import correct_records
from aduana.functions.units import convert_units
from aduana.operators.rollup import as_doubles, direction_sums, rollup
from aduana.plans.prices import monthly_price_statistics, price_series
from aduana.plans.trade import trade_rollup
from aduana.sources.readers import read_source


class TradeDesk:
    """`locations` maps "org" and "jp" to a Parquet folder or a catalog table; only those used need to be there."""

    def __init__(self, spark: SparkSession, locations: dict[str, str]):
        self.spark = spark
        self.locations = locations

    def pull_int_org(self) -> DataFrame:
        return read_source(self.spark, self.locations, "org")

    def pull_int_jp(self) -> DataFrame:
        return read_source(self.spark, self.locations, "jp")

    def process_int_jp(
        self,
        level: str,
        time_frame: str,
        datetime: str = "",
        agriculture_filter: bool = False,
        corrections: bool = False,
        source: str = "org",
        level_filter: str = "",
    ) -> DataFrame:
        facts = read_source(self.spark, self.locations, source)
        return trade_rollup(facts, level, time_frame, datetime, agriculture_filter, corrections, level_filter)

    def process_data(self, time_frame: str, level: str, base: DataFrame) -> DataFrame:
        return rollup(base, level, time_frame)

    def filter_data(self, df: DataFrame, filter: list[str]) -> DataFrame:
        """Sums per direction; a direction without rows is null here and 0 in `process_data`."""
        return as_doubles(direction_sums(df, filter, fill=False))

    def process_price(self, agriculture_filter: bool = False) -> DataFrame:
        return price_series(self.pull_int_org(), agriculture_filter)

    def price_statistics(self, agriculture_filter: bool = False, months: bool = False) -> DataFrame:
        return monthly_price_statistics(self.pull_int_org(), agriculture_filter, months=months)

    def conversion(self, df: DataFrame) -> DataFrame:
        return convert_units(df, exact=True)

    def corrections(self, df: DataFrame) -> DataFrame:
        return correct_records(df)
