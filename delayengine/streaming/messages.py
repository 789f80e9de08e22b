"""State messages: reading raw vectors and JSON, writing JSON. Batch or streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayengine.functions.clock import iso_utc
from delayengine.schema import LIVE_STATE_DDL, STATE_VECTOR_TYPES

CORRUPT = "_corrupt_record"


def parse_states(raw: DataFrame) -> DataFrame:
    """Struct ``flight`` out of the JSON text ``value``, next to the columns of ``raw``.

    A wrong-typed field becomes NULL and the text is kept in ``flight._corrupt_record``.
    """
    schema = f"{LIVE_STATE_DDL}, {CORRUPT} string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return raw.withColumn("flight", F.from_json(F.col("value").cast("string"), schema, options))


def flat_states(parsed: DataFrame) -> DataFrame:
    """The flight's fields with ``event_ts``: the poll time, at most the time of arrival.

    A message without a readable poll time takes the time of arrival. One from the
    future does too: left alone it would expire every other aircraft.
    """
    arrived = F.col("arrived_at") if "arrived_at" in parsed.columns else F.lit(None)
    polled = F.col("flight.polled_at").try_cast("timestamp")
    return parsed.withColumn(
        "event_ts", F.least(polled, arrived.cast("timestamp"))
    ).select("flight.*", "event_ts").drop(CORRUPT)


def without_key() -> Column:
    """True for a message that names no aircraft."""
    return F.coalesce(F.col("flight.icao24"), F.lit("")) == F.lit("")


def reject_reason(parsed: DataFrame) -> Column:
    """Why a message can't become a state: no aircraft, or neither a readable poll time nor an arrival. NULL if it can."""
    timed = F.col("flight.polled_at").try_cast("timestamp").isNotNull()
    if "arrived_at" in parsed.columns:
        timed = timed | F.col("arrived_at").isNotNull()
    return F.when(without_key(), F.lit("no aircraft")).when(~timed, F.lit("no time"))


def parse_vectors(raw: DataFrame, polled_at: Column) -> DataFrame:
    """One row per state vector of the polled documents in ``value``.

    A document is ``{"time": ..., "states": [[...], ...]}``; positions missing from a
    short vector are NULL.
    """
    document = F.from_json("value", "time bigint, states array<array<string>>")
    fields = [
        F.get("vector", F.lit(i)).try_cast(kind).alias(name)
        for i, (name, kind) in enumerate(STATE_VECTOR_TYPES.items())
    ]
    return (
        raw.withColumn("polled_at", iso_utc(polled_at))
        .select("polled_at", F.explode(document.getField("states")).alias("vector"))
        .select(*fields, "polled_at")
    )


def to_messages(states: DataFrame, key: str = "icao24") -> DataFrame:
    """Key and JSON value of each state, ready for a topic; NULL fields are written out."""
    return states.select(
        F.col(key).alias("key"),
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"),
    )
