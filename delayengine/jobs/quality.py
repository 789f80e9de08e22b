"""Run the data-quality checks; the exit code is 1 when any fails.

python -m delayengine.jobs.quality --target all --flights FLIGHTS --history LIVE/history --state LIVE/state
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayengine.operators.latest import union_all
from delayengine.operators.quality import enriched_report, flight_report, live_report, report_of_partials, roll_up
from delayengine.session import get_session
from delayengine.sinks.partials import refresh_partials
from delayengine.sources.flights import scan_months
from delayengine.sources.stored import whole_table
from delayengine.streaming.messages import to_messages
from delayengine.streaming.history import History
from delayengine.streaming.snapshots import SnapshotTable
from delayengine.streaming.state import StateTable

TARGETS = ("flights", "enriched", "live", "all")


def report(
    spark: SparkSession, target: str, flights: str | None, history: str | None, state: str | None,
    partials: str | None = None,
) -> DataFrame:
    """With ``partials``, figures are kept there month by month and only months written since the last check are read."""
    found = []
    if target in ("flights", "all"):
        if partials:
            store = SnapshotTable(spark, partials)
            refresh_partials(spark, flights, store, F.current_date())
            found.append(report_of_partials(store.read(), scan_months(spark, flights).columns, F.current_date()))
        else:
            found.append(flight_report(whole_table(spark, flights), F.current_date()))
    if target in ("enriched", "all"):
        stored = History(spark, history).read()
        found.append(enriched_report(spark.createDataFrame([], "icao24 string") if stored is None else stored))
    if target in ("live", "all"):
        current = StateTable(spark, state).read()
        empty = spark.createDataFrame([], "value string")
        found.append(live_report(empty if current is None else to_messages(current)))
    return union_all(found)


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--target", choices=TARGETS, default="all")
    args.add_argument("--flights")
    args.add_argument("--history")
    args.add_argument("--state")
    args.add_argument("--partials", help="where to keep the flights' figures by month")
    given = args.parse_args()
    checks = report(
        get_session("flight-quality"), given.target, given.flights, given.history, given.state, given.partials
    ).persist()
    for line in checks.select("message").collect():  # one short line per check
        print(line.message)
    passed, total = roll_up(checks).first()
    print(f"{passed}/{total} checks passed")
    if passed < total:
        raise SystemExit(1)


if __name__ == "__main__":
    main()
