"""The given star-schema tables seen as flights, live states and airports.

Each view is a projection of one large table; only the 25-row nation table is joined,
so no view shuffles its rows. The fact rows therefore stream straight from the scan
into the operator under test.
"""

from __future__ import annotations

import datetime
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delayengine.functions.clock import iso_utc
from delayengine.schema import CSV_NAMES, FLIGHT_TYPES, HUB_POSITIONS, ICAO_TO_IATA

# The first airlines known by prefix, and a prefix that is not.
CARRIERS = tuple(ICAO_TO_IATA.values())[:8]
PREFIXES = (*tuple(ICAO_TO_IATA)[:8], "ZZZ")
HUBS = tuple(HUB_POSITIONS)
ROW_ID = ("l_orderkey", "l_linenumber")
# Events reach the streams in so many parts; every LATE_EVERY-th comes one part later.
ARRIVALS, LATE_EVERY = 3, 53


@cache
def _layout(sf_dir: str, name: str) -> T.StructType:
    return SparkSession.active().read.parquet(f"{sf_dir}/{name}.parquet").schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table; its footer is read for the schema once per process."""
    # Epoch seconds and the calendar fields derived from them are UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.schema(_layout(sf_dir, name)).parquet(f"{sf_dir}/{name}.parquet")


def _one_of(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + F.lit(1))


def _nation(spark: SparkSession, sf_dir: str, key: str, name: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return nation.select(F.col("n_nationkey").cast("bigint").alias(key), F.col("n_name").alias(name))


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as canonical flights, with the line's key as row id."""
    order, part, supplier = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    cancelled = F.col("l_linenumber") == F.lit(7)
    hour = F.when(order % 25 == 24, F.lit(0)).otherwise(order % 25)
    # Later hours and some carriers run later, so that there is something to learn.
    dep = F.when(~cancelled, F.col("l_quantity") - F.lit(55.0) + hour * 2 + supplier % 8 * 3)
    arr = dep + (part % 21) - F.lit(10.0)
    cause = F.when(arr > F.lit(15.0), arr)
    odd = F.col("l_linenumber") % 2 == F.lit(1)
    rows = table(spark, sf_dir, "lineitem").select(
        *ROW_ID,
        F.col("l_shipdate").cast("date").cast("string").alias("FL_DATE"),
        _one_of(CARRIERS, supplier % 8).alias("OP_CARRIER"),
        (supplier % 25).alias("origin_key"),
        (part % 25).alias("dest_key"),
        F.when(order % 25 == 24, F.lit(2400))
        .otherwise((order % 25) * 100 + part % 60)
        .cast("int")
        .alias("CRS_DEP_TIME"),
        dep.cast("float").alias("DEP_DELAY"),
        arr.cast("float").alias("ARR_DELAY"),
        cancelled.cast("float").alias("CANCELLED"),
        (F.lit(100) + (part * 37) % 2500).cast("float").alias("DISTANCE"),
        F.when(~odd, cause).cast("float").alias("CARRIER_DELAY"),
        F.when(odd, cause).cast("float").alias("WEATHER_DELAY"),
    )
    return (
        rows.join(_nation(spark, sf_dir, "origin_key", "ORIGIN"), "origin_key")
        .join(_nation(spark, sf_dir, "dest_key", "DEST"), "dest_key")
        .select(*ROW_ID, *FLIGHT_TYPES)
    )


def flight_texts(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The same flights as the source's text columns, with flaws an ingest must survive.

    Some dates and departure times are no dates or numbers, some integers carry
    decimals, NULLs are blank, and there is one column too many.
    """
    rows = flights(spark, sf_dir)
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    departure = F.col("CRS_DEP_TIME").cast("string")
    texts = {name: F.col(name).cast("string") for name in FLIGHT_TYPES}
    texts["FL_DATE"] = F.when(order % 97 == 0, F.lit("not-a-date")).otherwise(F.col("FL_DATE"))
    texts["CRS_DEP_TIME"] = (
        F.when(order % 101 == 0, F.lit("x"))
        .when(line % 3 == 0, F.concat(departure, F.lit(".00")))
        .otherwise(departure)
    )
    named = [text.alias(CSV_NAMES[name]) for name, text in texts.items()]
    return rows.select(*keep, *named, F.concat(F.lit("row "), order.cast("string")).alias("Remarks"))


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as live states, with ``event_ts`` and ``event_id`` as tie-break."""
    return states_from_events(table(spark, sf_dir, "events"))


def states_from_events(events: DataFrame) -> DataFrame:
    event, user, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    address = F.lower(F.hex(user))
    placed = event % 50 != 49
    seconds = F.unix_seconds(ts.cast("timestamp"))
    return events.select(
        F.concat(F.repeat(F.lit("0"), F.lit(6) - F.length(address)), address).alias("icao24"),
        F.concat(_one_of(PREFIXES, user % 9), (user % 900 + 100).cast("string")).alias("callsign"),
        F.concat(F.lit("NATION_"), (user % 30).cast("string")).alias("origin_country"),
        F.when(placed, (event % 3600) / 10.0 - 180.0).cast("float").alias("longitude"),
        F.when(placed, (event % 1800) / 10.0 - 90.0).cast("float").alias("latitude"),
        (event % 400 * 100).cast("float").alias("baro_altitude"),
        F.col("value").cast("float").alias("velocity"),
        (event % 360).cast("float").alias("true_track"),
        (F.col("event_type") == F.lit("signup")).alias("on_ground"),
        iso_utc(ts).alias("polled_at"),
        seconds.alias("time_position"),
        (seconds + 1).alias("last_contact"),
        (event % 400 * 100 + 50).cast("float").alias("geo_altitude"),
        F.lit(None).cast("float").alias("vertical_rate"),
        ts.alias("event_ts"),
        "event_id",
    )


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with ``arrival``, the part of the delivery they come in."""
    events = table(spark, sf_dir, "events")
    last = events.agg(F.max("event_id")).first()[0]  # one column, one value
    place = F.floor(F.col("event_id") * F.lit(ARRIVALS) / F.lit((last or 0) + 1))
    late = F.when(F.col("event_id") % LATE_EVERY == 0, 1).otherwise(0)
    return events.withColumn("arrival", F.least(place + late, F.lit(ARRIVALS - 1)).cast("int"))


def history_day(spark: SparkSession, sf_dir: str) -> datetime.date:
    """The day a third of the way through the events."""
    low, high = table(spark, sf_dir, "events").agg(F.min("ts"), F.max("ts")).first()
    return (low + (high - low) / ARRIVALS).date()


def with_trip(live: DataFrame) -> DataFrame:
    """Add origin, destination and a predicted delay (absent for every seventh event).

    Two hubs take a fourth and a fifth of the aircraft, so that congestion differs between hubs.
    """
    user = F.conv("icao24", 16, 10).cast("bigint")
    event = F.col("event_id")
    return live.withColumns(
        {
            "origin": F.when(user % 13 == 12, F.lit("ZZZ"))
            .when(user % 4 == 0, F.lit(HUBS[0]))
            .when(user % 5 == 1, F.lit(HUBS[1]))
            .otherwise(_one_of(HUBS, user % 10)),
            "dest": _one_of(HUBS, (user * 3 + 4) % 10),
            "predicted_delay_minutes": F.when(event % 7 != 6, (event % 90) / 2.0),
        }
    )


def live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_trip(states(spark, sf_dir))


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``states`` as key and JSON, with what a topic may hold: every 43rd without a key, every 41st cut off."""
    own = states(spark, sf_dir)
    sent = own.withColumn("icao24", F.when(F.col("event_id") % 43 != 0, F.col("icao24")))
    text = F.to_json(F.struct(*[c for c in sent.columns if c not in ("event_ts", "event_id")]), {"ignoreNullFields": "false"})
    return sent.select(
        "event_id", F.col("icao24").alias("key"),
        F.when(F.col("event_id") % 41 == 0, F.substring(text, 1, 8)).otherwise(text).alias("value"),
    )


def airport_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``supplier`` as the airports file: text columns and the order of loading."""
    key = F.col("s_suppkey")
    kinds = ("large_airport", "medium_airport", "small_airport")
    rows = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").cast("bigint").alias("nation_key"),
        _one_of(kinds, key % 3).alias("type"),
        F.when(key % 11 == 0, F.lit("")).otherwise(F.concat(F.lit("S"), (key % 60).cast("string"))).alias("iata_code"),
        F.col("s_name").alias("name"),
        F.when(key % 17 == 0, F.lit("unknown")).otherwise((key % 180 - 90).cast("string")).alias("latitude_deg"),
        (key % 360 - 180).cast("string").alias("longitude_deg"),
        F.concat(F.lit("TZ_"), (F.col("s_nationkey") % 5).cast("string")).alias("tz_database_timezone"),
        key.alias("load_order"),
    )
    return rows.join(_nation(spark, sf_dir, "nation_key", "iso_country"), "nation_key").drop("nation_key")


def newest(spark: SparkSession, sf_dir: str) -> Column:
    """"Now" for the views: the newest event time, as a literal.

    One value from a one-column scan. As a literal it folds into every expression
    that needs it and reaches the scan in time filters.
    """
    return F.lit(table(spark, sf_dir, "events").agg(F.max("ts")).first()[0])
