"""Print monthly trade by product.

    spark-submit main.py /data/organisation_facts
"""

from __future__ import annotations

import sys

from aduana import TradeDesk, spark_session


def main(location: str) -> None:
    desk = TradeDesk(spark_session("monthly trade by product"), {"org": location})
    desk.process_int_jp(level="hts", time_frame="monthly").show(50, truncate=False)


if __name__ == "__main__":
    main(*sys.argv[1:])
