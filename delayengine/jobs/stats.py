"""Delay statistics by route, carrier and hour, from one scan.

python -m delayengine.jobs.stats --input FLIGHTS --output STATS [--year Y] [--month M]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from delayengine.operators.clean import flown
from delayengine.operators.stats import all_stats, with_hour
from delayengine.session import get_session
from delayengine.sinks.tables import write_stats
from delayengine.sources.flights import scan_months


def run(
    spark: SparkSession, source: str, output: str, year: int | None = None, month: int | None = None
) -> None:
    flights = scan_months(spark, source, year, month)
    write_stats(all_stats(with_hour(flown(flights))), output)


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--input", required=True)
    args.add_argument("--output", required=True)
    args.add_argument("--year", type=int)
    args.add_argument("--month", type=int)
    given = args.parse_args()
    run(get_session("delay-stats"), given.input, given.output, given.year, given.month)


if __name__ == "__main__":
    main()
