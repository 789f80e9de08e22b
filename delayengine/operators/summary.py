"""Dashboard summaries of normalised flights."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayengine.functions.clock import iso_minute
from delayengine.functions.risk import ALERT_SCORE, HIGH_MINUTES, MEDIUM_MINUTES
from delayengine.functions.rounding import nearest
from delayengine.operators.views import in_hubs
from delayengine.schema import HUB_POSITIONS

# Congestion score per aircraft, per unit of mean risk, per aircraft on the ground (fixed values).
SCORE_WEIGHTS = {"risk": (1.2, 55.0, 2.5), "load": (1.4, 0.0, 4.0)}
TREND_WINDOWS = (15, 30, 60, 90)
HISTOGRAM_BINS = 18
HISTOGRAM_MARKERS = (MEDIUM_MINUTES, HIGH_MINUTES)


def hub_of(flights: DataFrame, names: Sequence[str] = ("nearest_airport", "airport", "origin")) -> Column:
    present = [F.nullif(F.col(n), F.lit("")) for n in names if n in flights.columns]
    return F.coalesce(*present, F.lit("UNK"))


def _grounded() -> Column:
    return F.coalesce("on_ground", F.lit(False))


def delay_signal() -> Column:
    """An aircraft on the ground, or one at medium or high risk."""
    return _grounded() | F.coalesce(F.col("risk_label").isin("medium", "high"), F.lit(False))


def density(flights: DataFrame, as_of: Column) -> DataFrame:
    """Aircraft and ground-delay signals per hub.

    A hub outside the fixed position table sits where its first aircraft (by id) is.
    """
    table = F.create_map(
        *chain.from_iterable(
            (F.lit(code), F.struct(F.lit(lat).alias("lat"), F.lit(lon).alias("lon")))
            for code, (lat, lon) in HUB_POSITIONS.items()
        )
    )
    first = F.min_by(F.struct("lat", "lon"), F.struct("icao24", "flight_id"))
    grouped = flights.groupBy(hub_of(flights).alias("region")).agg(
        F.count(F.lit(1)).alias("count"),
        F.count_if(delay_signal()).alias("ground_delay_count"),
        first.alias("first"),
    )
    place = F.coalesce(F.try_element_at(table, F.col("region")), F.col("first"))
    return grouped.select(
        "region",
        place.getField("lat").alias("lat"),
        place.getField("lon").alias("lon"),
        "count",
        "ground_delay_count",
        iso_minute(as_of).alias("timestamp"),
    )


def density_series(flights: DataFrame, time: str) -> DataFrame:
    """``density`` counts per minute of ``time``: the history the activity trend reads."""
    return flights.groupBy(
        F.date_trunc("minute", F.col(time)).alias("timestamp"), hub_of(flights).alias("region")
    ).agg(F.count(F.lit(1)).alias("count"), F.count_if(delay_signal()).alias("ground_delay_count"))


def service_density(records: DataFrame, as_of: Column) -> DataFrame:
    """Aircraft and aircraft on the ground per hub, for the service layout."""
    hub = hub_of(records, ("nearest_airport", "origin"))
    return records.groupBy(hub.alias("region")).agg(
        F.count(F.lit(1)).alias("count"), F.count_if(_grounded()).alias("ground_delay_count")
    ).withColumn("timestamp", iso_minute(as_of))


def _hub_totals(flights: DataFrame, hub: Column, *more: Column) -> DataFrame:
    # Risk is summed as a decimal: exact, so the score does not depend on row order.
    risk = F.coalesce("delay_risk", F.lit(0.0)) if "delay_risk" in flights.columns else F.lit(0.0)
    return flights.groupBy(hub.alias("hub")).agg(
        F.count(F.lit(1)).alias("aircraft_count"),
        F.count_if(_grounded()).alias("ground_count"),
        F.sum(risk.cast("decimal(18,6)")).cast("double").alias("risk_sum"),
        *more,
    )


def _score(model: str) -> Column:
    per_aircraft, per_risk, per_ground = SCORE_WEIGHTS[model]
    score = F.col("aircraft_count") * F.lit(per_aircraft)
    if per_risk:
        score = score + F.col("risk_sum") / F.col("aircraft_count") * F.lit(per_risk)
    score = score + F.col("ground_count") * F.lit(per_ground)
    return F.least(F.lit(100.0), nearest(score, 1))


def congestion(flights: DataFrame, model: str = "risk") -> DataFrame:
    """Score per hub, at most 100, highest first.

    ``risk`` weighs aircraft, mean delay risk and aircraft on the ground; ``load`` is
    the service's variant without risk.
    """
    names = ("nearest_airport", "airport", "origin") if model == "risk" else ("nearest_airport", "origin")
    return (
        _hub_totals(flights, hub_of(flights, names))
        .select("hub", _score(model).alias("score"), "aircraft_count", "ground_count")
        .orderBy(F.desc("score"), "hub")
    )


def kpis(flights: DataFrame, online: bool = True) -> DataFrame:
    """One row of headline figures.

    Everything is summed per hub first and over hubs second, so the alert count and
    the flight counts come from the same scan.
    """
    airborne = ~_grounded()
    altitude = F.when(airborne, F.coalesce("altitude", F.lit(0)).cast("bigint"))
    hubs = _hub_totals(
        flights,
        hub_of(flights),
        F.count_if(F.coalesce("predicted_delay_minutes", F.lit(0.0)) >= F.lit(MEDIUM_MINUTES)).alias("delayed"),
        F.count_if(F.col("risk_label") == F.lit("high")).alias("high_risk"),
        F.count_if(airborne).alias("airborne"),
        F.sum(altitude).alias("altitude_sum"),
    )

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0).cast("bigint"))

    mean = total("altitude_sum") / F.greatest(total("airborne"), F.lit(1).cast("bigint"))
    return hubs.agg(
        total("aircraft_count").alias("total_flights"),
        total("delayed").alias("delayed_flights"),
        total("high_risk").alias("high_risk_flights"),
        F.count_if(_score("risk") >= F.lit(ALERT_SCORE)).alias("congestion_alerts"),
        mean.cast("int").alias("avg_altitude_ft"),
    ).withColumn("api_status", F.lit("online" if online else "mock/offline"))


def activity_trend(
    series: DataFrame,
    minutes: int = 60,
    regions: Sequence[str] = (),
    newest: Column | None = None,
) -> DataFrame:
    """Active aircraft and ground-delay signals over the last ``minutes`` of ``series``.

    Text timestamps that do not parse are left out. ``newest`` is the series' latest
    time where known; otherwise a scalar subquery finds it.
    """
    rows = in_hubs(series, regions, "region")
    rows = rows.withColumn("timestamp", F.col("timestamp").try_cast("timestamp_ntz"))
    if newest is None:
        newest = rows.agg(F.max("timestamp")).scalar()
    start = newest - F.make_dt_interval(mins=F.lit(minutes))
    return rows.filter(F.col("timestamp") >= start).groupBy("timestamp").agg(
        F.sum("count").alias("active_aircraft"),
        F.sum("ground_delay_count").alias("ground_delays"),
    )


def delay_histogram(flights: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Flights per equal-width bin of predicted minutes; a missing prediction counts as 0.

    Bins are numbered from 1 and closed below; the last also holds the maximum.
    Empty bins give no row.
    """
    minutes = flights.select(F.coalesce("predicted_delay_minutes", F.lit(0.0)).alias("m"))
    bounds = minutes.agg(F.struct(F.min("m").alias("low"), F.max("m").alias("high"))).scalar()
    low, high = bounds.getField("low"), bounds.getField("high")
    # Equal bounds give a NULL bucket, the maximum one past the last.
    bucket = F.coalesce(F.width_bucket(F.col("m"), low, high, F.lit(bins)), F.lit(1).cast("bigint"))
    counted = minutes.groupBy(F.least(bucket, F.lit(bins).cast("bigint")).alias("bin")).agg(
        F.count(F.lit(1)).alias("flights")
    )
    width = (high - low) / F.lit(float(bins))
    return counted.select(
        "bin", (low + (F.col("bin") - F.lit(1)) * width).alias("bin_start"), "flights"
    )
