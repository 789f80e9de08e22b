"""Dates, scheduled hours and event times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flight_date(text: Column, strict: bool = False) -> Column:
    """Date of an ``FL_DATE`` text; NULL where it is no date.

    ``strict`` accepts ``yyyy-MM-dd`` only; the default also takes shortened
    forms such as ``2024-1-5``.
    """
    if strict:
        return F.try_to_date(text, "yyyy-MM-dd")
    return text.try_cast("date")


def scheduled_hour(hhmm: Column) -> Column:
    """Hour 0..23 of an HHMM integer; 2400 is midnight."""
    return (hhmm / F.lit(100)).cast("int") % F.lit(24)


def utc_clock(value: Column, kind: str) -> Column:
    """Event time as a zone-free UTC timestamp, from epoch seconds or ISO text.

    The session runs in UTC. An offset written in the text is dropped, not applied.
    """
    if kind == "string":
        return value.try_cast("timestamp_ntz")
    if kind in ("timestamp", "timestamp_ntz"):
        return value.cast("timestamp_ntz")
    if kind in ("float", "double"):
        return F.timestamp_micros((value * F.lit(1e6)).cast("bigint")).cast("timestamp_ntz")
    return F.timestamp_seconds(value).cast("timestamp_ntz")


def iso_utc(moment: Column) -> Column:
    """ISO text with offset; the fraction is written only when there is one."""
    text = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.replace(text, F.lit(".000000"), F.lit("")), F.lit("+00:00"))


def iso_minute(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm':00+00:00'")
