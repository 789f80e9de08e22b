"""Labels, temporal features and scoring features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayengine.functions.carriers import carrier_from_callsign, carrier_or_prefix
from delayengine.functions.clock import flight_date, scheduled_hour, utc_clock
from delayengine.schema import FEATURES, LABEL, WEIGHT

LATE_ARRIVAL_MINUTES = 15  # fixed value
DELAYED_WEIGHT = 2.0  # fixed value

# What tells one flight from another, for a split that does not depend on partitioning.
FLIGHT_IDENTITY = ("FL_DATE", "OP_CARRIER", "ORIGIN", "DEST", "CRS_DEP_TIME")


def labelled(flights: DataFrame, threshold: float = LATE_ARRIVAL_MINUTES) -> DataFrame:
    """Completed flights with ``is_delayed`` = arrival more than ``threshold`` minutes late."""
    arrived = (F.col("CANCELLED") != F.lit(1.0).cast("float")) & F.col("ARR_DELAY").isNotNull()
    late = F.col("ARR_DELAY") > F.lit(float(threshold)).cast("float")
    return flights.filter(arrived).withColumn(LABEL, late.cast("int"))


def with_calendar(flights: DataFrame) -> DataFrame:
    """Add hour of day, day of week (1 = Sunday) and month.

    A ``month`` partition column is used as it stands; otherwise it comes from the date.
    """
    day = flight_date(F.col("FL_DATE"))
    month = F.col("month").cast("int") if "month" in flights.columns else F.month(day)
    return flights.withColumns(
        {
            "hour_of_day": scheduled_hour(F.col("CRS_DEP_TIME")),
            "day_of_week": F.dayofweek(day),
            "month": month,
        }
    )


def feature_rows(flights: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The four features and the label, plus any columns named in ``keep``."""
    return flights.select(
        F.col("OP_CARRIER").alias("carrier"), "hour_of_day", "day_of_week", "month", LABEL, *keep
    )


def holdout_flag(identity: Sequence[str] = FLIGHT_IDENTITY, seed: int = 42) -> Column:
    """True for the fifth of the flights held out for testing.

    Decided by a hash of the flight's own identity, so the same flight always falls
    on the same side however the data is partitioned, and in any engine that has MD5.
    """
    own = F.concat_ws("|", F.lit(str(seed)), *(F.col(c).cast("string") for c in identity))
    return F.conv(F.substring(F.md5(own), 1, 8), 16, 10).cast("bigint") % 10 >= F.lit(8)


def split_rows(
    flights: DataFrame, extra_identity: Sequence[str] = (), seed: int = 42
) -> DataFrame:
    """Feature rows of labelled flights with ``held_out`` telling test from training.

    The flag is set before the features are cut out: equal features must not all land
    on one side.
    """
    flag = holdout_flag((*FLIGHT_IDENTITY, *extra_identity), seed)
    return feature_rows(with_calendar(flights.withColumn("held_out", flag)), ["held_out"])


def train_and_test(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Weighted training rows and unweighted test rows out of ``split_rows``.

    Rows tallied into ``flights`` weigh that many times as much.
    """
    train = weighted(rows.filter(~F.col("held_out")).drop("held_out"))
    test = weighted(rows.filter(F.col("held_out")).drop("held_out"), 1.0)
    if "flights" in rows.columns:
        train = train.withColumn(WEIGHT, F.col(WEIGHT) * F.col("flights")).drop("flights")
    return train, test


def weighted(rows: DataFrame, delayed_weight: float = DELAYED_WEIGHT) -> DataFrame:
    heavy = F.when(F.col(LABEL) == F.lit(1), F.lit(float(delayed_weight)))
    return rows.withColumn(WEIGHT, heavy.otherwise(F.lit(1.0)))


def usable(rows: DataFrame) -> DataFrame:
    """Rows the assembler accepts: it refuses NULL numbers. A NULL carrier is allowed."""
    return rows.dropna(subset=[c for c in FEATURES if c != "carrier"])


def state_carrier(states: DataFrame, mode: str = "strict") -> Column:
    """Carrier of a live state.

    ``strict`` maps the callsign prefix and gives NULL (no prediction) for an unknown
    airline; ``fallback`` maps the ``carrier`` column or the callsign prefix and falls
    back to the first two letters.
    """
    if mode == "strict":
        return carrier_from_callsign(F.col("callsign"))
    if mode != "fallback":
        raise ValueError(f"carrier mode must be strict or fallback, not {mode!r}")
    prefix = F.substring(F.trim("callsign"), 1, 3)
    if "carrier" in states.columns:
        prefix = F.coalesce(F.nullif(F.col("carrier"), F.lit("")), prefix)
    return carrier_or_prefix(prefix)


def state_features(
    states: DataFrame,
    as_of: Column,
    mode: str = "strict",
    times: Sequence[str] = ("time_position", "timestamp"),
    timezone: str | None = None,
) -> DataFrame:
    """Add the four model features to live states.

    The time is the first of ``times`` that is there (epoch seconds other than 0, or ISO text other
    than an empty one); where that can't be read, or none is there, it is ``as_of``. Hours are UTC; ``timezone`` names a column with a zone to use instead.
    """
    now = as_of.cast("timestamp_ntz")
    moment = now
    for name in reversed([t for t in times if t in states.columns]):
        kind = states.schema[name].dataType.simpleString()
        value = F.col(name)
        given = value.isNotNull()
        if kind == "string":
            given = given & (value != F.lit(""))
        elif kind not in ("timestamp", "timestamp_ntz"):
            given = given & (value != F.lit(0).cast(kind))
        moment = F.when(given, F.coalesce(utc_clock(value, kind), now)).otherwise(moment)
    if timezone:
        zoned = F.from_utc_timestamp(moment.cast("timestamp"), F.col(timezone))
        moment = F.coalesce(zoned.cast("timestamp_ntz"), moment)
    return states.withColumns(
        {
            "carrier": state_carrier(states, mode),
            "hour_of_day": F.hour(moment),
            "day_of_week": F.dayofweek(moment),
            "month": F.month(moment),
        }
    )
