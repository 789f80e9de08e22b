"""Live records in whatever spelling, brought to one layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delayengine.functions.clock import iso_utc
from delayengine.functions.risk import label_from_minutes, score_from_minutes
from delayengine.functions.rounding import nearest
from delayengine.functions.text import pick

# --- Dashboard layout: accepted spellings per field, first one wins (fixed values) ---
LAT = ("lat", "latitude")
LON = ("lon", "longitude")
ORIGIN = ("origin", "airport", "nearest_airport", "estDepartureAirport")
DEST = ("dest", "destination", "estArrivalAirport")
NEAREST = ("nearest_airport", "airport", "origin")
DELAY = ("predicted_delay_minutes", "delay_minutes", "prediction")
RISK_LABEL = ("risk_label", "risk")
RISK_SCORE = ("delay_risk", "risk_score")
CALLSIGN = ("callsign", "call_sign")
CARRIER = ("carrier", "airline")
TIME = ("timestamp", "last_seen", "time", "time_position")
FLIGHT_ID = ("flight_id", "icao24", "id")
ALTITUDE = ("altitude", "baro_altitude", "geo_altitude")
VELOCITY = ("velocity", "speed")
HEADING = ("heading", "true_track")
DEPARTURE = ("crs_dep_time", "scheduled_departure_time")
DEFAULT_DISTANCE = 500.0
DEFAULT_DEPARTURE = 1200


def _time_text(records: DataFrame, aliases: tuple[str, ...], as_of: Column) -> Column:
    """ISO text of the first present time: text stays as it is, numbers are epoch seconds."""
    texts = []
    for name in aliases:
        if name not in records.columns:
            continue
        kind = records.schema[name].dataType
        if isinstance(kind, T.StringType):
            texts.append(F.nullif(F.col(name), F.lit("")))
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            texts.append(iso_utc(F.col(name)))
        elif isinstance(kind, T.IntegralType):
            texts.append(iso_utc(F.timestamp_seconds(F.col(name))))
        else:
            micros = (F.col(name).cast("decimal(20,6)") * F.lit(1000000)).cast("bigint")
            texts.append(iso_utc(F.timestamp_micros(micros)))
    return F.coalesce(*texts, iso_utc(as_of))


def normalized(records: DataFrame, as_of: Column) -> DataFrame:
    """The 24-column dashboard layout; ``as_of`` stands for now where a time is missing.

    A record without a delay takes it from its risk score (1 = an hour); the score is
    otherwise recomputed from the delay.
    """
    named = records.select(
        pick(records, LAT, "double").alias("lat"),
        pick(records, LON, "double").alias("lon"),
        pick(records, ORIGIN, "string", F.lit("UNK")).alias("origin"),
        pick(records, DEST, "string", F.lit("UNK")).alias("dest"),
        pick(records, NEAREST, "string").alias("nearest"),
        pick(records, DELAY, "double").alias("given_delay"),
        pick(records, RISK_SCORE, "double", F.lit(0.0)).alias("given_risk"),
        pick(records, RISK_LABEL, "string").alias("given_label"),
        F.coalesce(
            F.nullif(F.trim(pick(records, CALLSIGN, "string")), F.lit("")), F.lit("UNKNOWN")
        ).alias("callsign"),
        pick(records, CARRIER, "string").alias("given_carrier"),
        pick(records, FLIGHT_ID, "string").alias("given_id"),
        pick(records, ("icao24",), "string", F.lit("")).alias("icao24"),
        F.coalesce(pick(records, ALTITUDE, "double"), F.lit(0.0)).alias("altitude"),
        F.coalesce(pick(records, VELOCITY, "double"), F.lit(0.0)).alias("velocity"),
        F.coalesce(pick(records, HEADING, "double"), F.lit(0.0)).alias("heading"),
        pick(records, ("on_ground",), "boolean", F.lit(False)).alias("on_ground"),
        pick(
            records, DEPARTURE, "int", F.hour(as_of) * F.lit(100) + F.minute(as_of)
        ).alias("crs_dep_time"),
        pick(
            records, ("distance",), "double", F.lit(DEFAULT_DISTANCE), zero_is_empty=True
        ).alias("distance"),
        pick(records, ("month",), "int", F.month(as_of), zero_is_empty=True).alias("month"),
        _time_text(records, TIME, as_of).alias("timestamp"),
        pick(records, ("source",), "string", F.lit("api")).alias("source"),
    )
    delay = F.coalesce("given_delay", nearest(F.col("given_risk") * F.lit(60.0), 1))
    prefix = F.when(F.length("callsign") >= 3, F.substring("callsign", 1, 3))
    risk = F.when(F.col("given_delay").isNull(), F.col("given_risk")).otherwise(
        score_from_minutes(F.col("given_delay"))
    )
    return named.withColumn("delay", delay).select(
        F.coalesce("given_id", "callsign").alias("flight_id"),
        "icao24",
        "callsign",
        F.coalesce("given_carrier", prefix, F.lit("UNK")).alias("carrier"),
        "origin",
        "dest",
        F.col("origin").alias("airport"),
        F.coalesce("nearest", "origin").alias("nearest_airport"),
        "lat",
        "lon",
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        F.col("altitude").cast("int").alias("altitude"),
        nearest(F.col("velocity"), 1).alias("velocity"),
        "heading",
        "on_ground",
        "crs_dep_time",
        "distance",
        "month",
        nearest(F.col("delay"), 1).alias("predicted_delay_minutes"),
        F.lower(F.coalesce("given_label", label_from_minutes(F.col("delay")))).alias("risk_label"),
        risk.alias("delay_risk"),
        "timestamp",
        "source",
    )


def positioned(flights: DataFrame) -> DataFrame:
    """Flights with both coordinates."""
    return flights.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())


# --- Service layout: spellings where zero and empty text both fall through (fixed values) ---
API_LAT = ("latitude", "lat")
API_LON = ("longitude", "lon")
API_TIME = ("timestamp", "last_seen")


def _plain(records: DataFrame, name: str, kind: str, default: Column) -> Column:
    """The column as it stands; the default only where the record set has no such column."""
    return F.col(name).cast(kind) if name in records.columns else default.cast(kind)


def _first_there(records: DataFrame, aliases: tuple[str, ...]) -> tuple[str, ...]:
    """The first spelling that the record set has, whatever its values: a later one stands in for an absent key only."""
    return tuple(a for a in aliases if a in records.columns)[:1]


def api_records(records: DataFrame, as_of: Column) -> DataFrame:
    """The 17-column service layout; records without a position are left out."""
    origin = pick(records, ORIGIN, "string", F.lit("UNK"))
    callsign = F.trim(pick(records, CALLSIGN, "string", F.lit("UNKNOWN")))
    named = records.select(
        pick(records, _first_there(records, API_LAT), "double").alias("lat"),
        pick(records, _first_there(records, API_LON), "double").alias("lon"),
        callsign.alias("callsign"),
        F.coalesce(pick(records, FLIGHT_ID[:2], "string"), callsign).alias("flight_id"),
        _plain(records, "icao24", "string", F.lit("")).alias("icao24"),
        F.coalesce(
            pick(records, CARRIER[:1], "string"), F.substring(callsign, 1, 3)
        ).alias("carrier"),
        origin.alias("origin"),
        pick(records, DEST, "string", F.lit("UNK")).alias("dest"),
        F.coalesce(pick(records, NEAREST[:1], "string"), origin).alias("nearest_airport"),
        pick(records, ALTITUDE, "double", F.lit(0.0), zero_is_empty=True).alias("altitude"),
        _plain(records, "velocity", "double", F.lit(0.0)).alias("velocity"),
        pick(records, HEADING, "double", F.lit(0.0), zero_is_empty=True).alias("heading"),
        F.coalesce(
            _plain(records, "on_ground", "boolean", F.lit(False)), F.lit(False)
        ).alias("on_ground"),
        _plain(records, "crs_dep_time", "int", F.lit(DEFAULT_DEPARTURE)).alias("crs_dep_time"),
        _plain(records, "distance", "double", F.lit(DEFAULT_DISTANCE)).alias("distance"),
        _plain(records, "month", "int", F.month(as_of)).alias("month"),
        _time_text(records, API_TIME, as_of).alias("timestamp"),
    )
    return positioned(named).select(
        "flight_id", "icao24", "callsign", "carrier", "origin", "dest", "nearest_airport",
        "lat", "lon", "altitude", "velocity", "heading", "on_ground", "crs_dep_time",
        "distance", "month", "timestamp",
    )


def first_records(records: DataFrame, limit: int = 500) -> DataFrame:
    """The first ``limit`` service records by aircraft; the feature is the limit itself."""
    return records.orderBy("icao24").limit(limit)
