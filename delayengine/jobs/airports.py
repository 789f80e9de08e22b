"""Load the airports CSV into the stored reference.

python -m delayengine.jobs.airports --input airports.csv --table AIRPORTS [--countries countries.csv]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from delayengine.session import get_session
from delayengine.sinks.tables import write_airports
from delayengine.sources.airports import (
    read_airport_text,
    rejected_airports,
    to_airports,
    with_country_names,
)
from delayengine.streaming.snapshots import SnapshotTable


def run(spark: SparkSession, source: str, table: str, countries: str | None = None) -> int:
    """Returns how many airports were refused for an unreadable position."""
    text = read_airport_text(spark, source)
    airports = to_airports(text)
    if countries:
        names = spark.read.option("header", True).csv(countries)
        airports = with_country_names(airports, names.select("code", F.col("name").alias("country_name")))
    write_airports(SnapshotTable(spark, table), airports)
    return rejected_airports(text).count()


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--input", required=True)
    args.add_argument("--table", required=True)
    args.add_argument("--countries", help="CSV with code,name to replace country codes by names")
    given = args.parse_args()
    refused = run(get_session("airports"), given.input, given.table, given.countries)
    print(f"{refused} airports refused")


if __name__ == "__main__":
    main()
