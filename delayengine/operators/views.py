"""Row-level dashboard views of normalised flights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayengine.functions.risk import MEDIUM_MINUTES, congestion_band
from delayengine.functions.rounding import nearest
from delayengine.functions.text import ground_status, route_text, title_case


def at_airports(rows: DataFrame, airports: Sequence[str], column: str = "nearest_airport") -> DataFrame:
    """Rows whose nearest airport or origin is listed; an empty list keeps everything."""
    if not airports:
        return rows
    return rows.filter(F.col(column).isin(*airports) | F.col("origin").isin(*airports))


def with_risk(rows: DataFrame, risk: str = "all", column: str = "risk_label") -> DataFrame:
    if risk == "all":
        return rows
    return rows.filter(F.lower(column) == F.lit(risk))


def in_hubs(rows: DataFrame, hubs: Sequence[str], column: str = "hub") -> DataFrame:
    return rows.filter(F.col(column).isin(*hubs)) if hubs else rows


def delays(flights: DataFrame, minimum: float = MEDIUM_MINUTES) -> DataFrame:
    """Flights at least ``minimum`` minutes late, worst first (ties by aircraft)."""
    return delay_rows(flights, minimum).orderBy(F.desc("duration_minutes"), "icao24")


def delay_rows(flights: DataFrame, minimum: float = MEDIUM_MINUTES) -> DataFrame:
    """``delays`` without the sort, for callers that count or sort themselves."""
    minutes = F.coalesce("predicted_delay_minutes", F.lit(0.0))
    return flights.filter(minutes >= F.lit(float(minimum))).select(
        "flight_id",
        "icao24",
        "callsign",
        "origin",
        "dest",
        F.coalesce(F.nullif("nearest_airport", F.lit("")), "origin").alias("airport"),
        nearest(minutes, 1).alias("duration_minutes"),
        title_case(F.coalesce("risk_label", F.lit("low"))).alias("risk_level"),
        "lat",
        "lon",
        "velocity",
        "on_ground",
    )


def risk_table(
    delayed: DataFrame, airports: Sequence[str] = (), risk: str = "all"
) -> DataFrame:
    """The table under the map, from ``delays``."""
    rows = with_risk(at_airports(delayed, airports, "airport"), risk, "risk_level")
    return rows.select(
        F.coalesce("callsign", F.lit("UNKNOWN")).alias("callsign"),
        route_text(
            F.coalesce("origin", "airport", F.lit("UNK")), F.coalesce("dest", F.lit("UNK"))
        ).alias("route"),
        "duration_minutes",
        "risk_level",
        ground_status(F.col("on_ground")).alias("status"),
        "velocity",
    )


def map_points(flights: DataFrame, airports: Sequence[str] = (), risk: str = "all") -> DataFrame:
    """What a map marker needs: position, size, colour value and hover text fields."""
    rows = with_risk(at_airports(flights, airports), risk)
    score = F.coalesce("delay_risk", F.lit(0.0))
    return rows.select(
        "lat",
        "lon",
        F.when(F.col("on_ground"), F.lit(15.0)).otherwise(F.lit(8.0) + F.lit(8.0) * score).alias("size"),
        score.alias("color"),
        F.coalesce("callsign", "icao24", F.lit("UNKNOWN")).alias("text"),
        "origin",
        "dest",
        "altitude",
        "velocity",
        "predicted_delay_minutes",
        F.upper(F.coalesce("risk_label", F.lit("low"))).alias("risk"),
        ground_status(F.col("on_ground")).alias("status"),
    )


def congestion_bars(congestion: DataFrame, hubs: Sequence[str] = ()) -> DataFrame:
    """Congestion in chart order (lowest first) with its colour band."""
    return (
        in_hubs(congestion, hubs)
        .select("hub", "score", congestion_band(F.col("score")).alias("band"))
        .orderBy("score", "hub")
    )
