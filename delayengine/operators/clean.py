"""Partition columns and the filters every statistic starts from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayengine.functions.clock import flight_date


def with_month_keys(flights: DataFrame, strict: bool = False) -> DataFrame:
    """Add ``year`` and ``month``; rows without a readable date are left out."""
    day = flight_date(F.col("FL_DATE"), strict)
    return flights.filter(day.isNotNull()).withColumns(
        {"year": F.year(day), "month": F.month(day)}
    )


def with_open_keys(flights: DataFrame, strict: bool = False) -> DataFrame:
    """Add ``year`` and ``month``, NULL for rows without a readable date: those then share a partition of their own."""
    day = flight_date(F.col("FL_DATE"), strict)
    return flights.withColumns({"year": F.year(day), "month": F.month(day)})


def undated(flights: DataFrame, strict: bool = False) -> DataFrame:
    """The rows ``with_month_keys`` leaves out."""
    return flights.filter(flight_date(F.col("FL_DATE"), strict).isNull())


def flown(flights: DataFrame) -> DataFrame:
    """Not cancelled and with a known departure delay. Both predicates reach the scan."""
    return flights.filter(
        (F.col("CANCELLED") == F.lit(0.0).cast("float")) & F.col("DEP_DELAY").isNotNull()
    )
