"""CSV text to month-partitioned Parquet.

python -m delayengine.jobs.ingest --input RAW --output FLIGHTS [--keep-rejects]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from delayengine.operators.clean import with_open_keys
from delayengine.session import get_session
from delayengine.sinks.tables import write_months
from delayengine.sources.flights import failure_counts, read_csv_text, read_mixed_csv, to_flights


def write_observed(
    raw: DataFrame, output: str, compact: bool = True, strict: bool = False, keep_rejects: bool = False
) -> dict[str, int]:
    """Write the rows and tell how many there were, from a single read.

    Rows without a readable date go to the partition without year and month, or nowhere. The result counts ``rows``, ``undated``
    and, per numeric column, texts that are no numbers; Spark sums these while it writes.
    """
    texts, dates = Observation(), Observation()
    flights = with_open_keys(to_flights(raw.observe(texts, F.count(F.lit(1)).alias("rows"), *failure_counts(raw))), strict)
    flights = flights.observe(dates, F.count_if(F.col("year").isNull()).alias("undated"))
    write_months(flights if keep_rejects else flights.filter(F.col("year").isNotNull()), output, compact)
    return {**texts.get, **dates.get}


def run(
    spark: SparkSession, source: str, output: str, compact: bool = True, strict: bool = False,
    keep_rejects: bool = False, one_header: bool = False,
) -> dict[str, int]:
    raw = read_csv_text(spark, source) if one_header else read_mixed_csv(spark, source)
    return write_observed(raw, output, compact, strict, keep_rejects)


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--input", required=True)
    args.add_argument("--output", required=True)
    args.add_argument("--keep-rejects", action="store_true", help="keep rows without a readable date in a partition of their own")
    args.add_argument("--one-header", action="store_true", help="all files have the same columns in the same order: saves a pass")
    args.add_argument("--no-compact", action="store_true", help="input already comes month by month")
    args.add_argument("--strict-dates", action="store_true", help="accept yyyy-MM-dd only")
    given = args.parse_args()
    found = run(
        get_session("flights-ingest"), given.input, given.output, not given.no_compact, given.strict_dates,
        given.keep_rejects, given.one_header,
    )
    print(", ".join(f"{name} {count}" for name, count in found.items()))


if __name__ == "__main__":
    main()
