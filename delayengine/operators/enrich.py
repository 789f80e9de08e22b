"""Live states joined with the airport reference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def country_reference(airports: DataFrame, coherent: bool = False) -> DataFrame:
    """One airport per country, so that the join below keeps one row per state.

    By default the smallest code, name and timezone are taken independently and may
    stem from different airports; ``coherent`` takes all three from the airport with
    the smallest code (then name).
    """
    if not coherent:
        return airports.groupBy("country").agg(
            F.min("code").alias("code"),
            F.min("name").alias("name"),
            F.min("timezone").alias("timezone"),
        )
    first = F.min(F.struct("code", "name", "timezone"))
    return airports.groupBy("country").agg(first.alias("a")).select("country", "a.*")


def with_airport(states: DataFrame, reference: DataFrame) -> DataFrame:
    """Left join on the country of origin; works on batch and streaming states.

    ``reference`` is ``country_reference`` stored as a table: its file size decides
    between a broadcast and, beyond the threshold, a shuffle join that adaptive
    execution can split at a hot country.
    """
    lookup = reference.select(
        F.col("country").alias("origin_country"),
        F.col("code").alias("origin_airport_icao_code"),
        F.col("name").alias("origin_airport_name"),
        F.col("timezone").alias("origin_airport_timezone"),
    )
    joined = states.join(lookup, "origin_country", "left")
    return joined.select(*states.columns, *lookup.columns[1:])
