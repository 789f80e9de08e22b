"""Historical delay statistics by route, carrier and hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayengine.functions.clock import scheduled_hour

LATE_MINUTES = 15.0  # fixed value; strictly more than this is late

# Table name -> grouping columns.
STAT_KEYS = {
    "by_route": ("ORIGIN", "DEST"),
    "by_carrier": ("OP_CARRIER",),
    "by_hour": ("hour_of_day",),
}
METRICS = ("flight_count", "mean_dep_delay", "pct_delayed_15min")


def with_hour(flights: DataFrame) -> DataFrame:
    return flights.withColumn("hour_of_day", scheduled_hour(F.col("CRS_DEP_TIME")))


def _measures() -> list[Column]:
    late = (F.col("DEP_DELAY") > F.lit(LATE_MINUTES)).cast("double")
    return [
        F.count(F.lit(1)).alias("flight_count"),
        F.avg("DEP_DELAY").alias("mean_dep_delay"),
        F.avg(late).alias("pct_delayed_15min"),
    ]


def delay_stats(flights: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Count, mean departure delay and late share per key.

    All three combine on the map side, so a hot key costs one small row per task.
    """
    return flights.groupBy(*keys).agg(*_measures())


def by_route(flights: DataFrame) -> DataFrame:
    return delay_stats(flights, STAT_KEYS["by_route"])


def by_carrier(flights: DataFrame) -> DataFrame:
    return delay_stats(flights, STAT_KEYS["by_carrier"])


def by_hour(flights: DataFrame) -> DataFrame:
    return delay_stats(flights, STAT_KEYS["by_hour"])


def all_stats(flights: DataFrame) -> DataFrame:
    """The three tables from a single scan; ``stat`` names the table of each row."""
    columns = [c for keys in STAT_KEYS.values() for c in keys]
    sets = [[F.col(c) for c in keys] for keys in STAT_KEYS.values()]
    stat = F.coalesce(
        *[
            F.when(F.grouping(keys[0]) == F.lit(0), F.lit(name))
            for name, keys in STAT_KEYS.items()
        ]
    )
    return flights.groupingSets(sets, *columns).agg(stat.alias("stat"), *_measures())


def split_stats(combined: DataFrame) -> dict[str, DataFrame]:
    """The three tables back out of ``all_stats``."""
    return {
        name: combined.filter(F.col("stat") == F.lit(name)).select(*keys, *METRICS)
        for name, keys in STAT_KEYS.items()
    }


def with_route_history(flights: DataFrame, route_stats: DataFrame) -> DataFrame:
    """Each flight with its route's historical statistics; unknown routes get NULLs.

    ``route_stats`` should be a stored table (see ``session.stage``): its file size
    lets Catalyst choose a broadcast while it is small.
    """
    return flights.join(route_stats, list(STAT_KEYS["by_route"]), "left")
