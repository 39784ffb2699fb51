"""Trade statistics on Spark: customs records to rollups, unit prices and price reports."""

from aduana.desk import TradeDesk
from aduana.functions.corrections import correct_records
from aduana.functions.units import convert_units
from aduana.operators.filters import latest_period
from aduana.operators.lookups import denormalise, unmatched_keys, with_agricultural_flag, with_naics_sector, with_prefix_label
from aduana.operators.rollup import rollup
from aduana.plans.prices import monthly_price_statistics, price_movers, price_series
from aduana.plans.trade import chapter_codes, chapter_list, fiscal_net_quantity, trade_rollup, trade_rollup_family
from aduana.session import shared_folder, spark_session

__all__ = [
    "TradeDesk", "chapter_codes", "chapter_list", "convert_units", "correct_records", "denormalise",
    "fiscal_net_quantity", "latest_period", "monthly_price_statistics", "price_movers", "price_series", "rollup",
    "shared_folder", "spark_session", "trade_rollup", "trade_rollup_family", "unmatched_keys", "with_agricultural_flag",
    "with_naics_sector", "with_prefix_label",
]
