"""Airport reference data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SERVED_TYPES = ("large_airport", "medium_airport")  # fixed values


def read_airport_text(spark: SparkSession, path: str) -> DataFrame:
    """The airports CSV as text, with ``load_order`` telling later records from earlier ones."""
    text = spark.read.option("header", True).option("multiLine", False).csv(path)
    return text.withColumn(
        "load_order",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def _readable_position() -> tuple:
    lat = F.col("latitude_deg").try_cast("double")
    lon = F.col("longitude_deg").try_cast("double")
    return lat, lon


def _served():
    return F.col("type").isin(*SERVED_TYPES) & (F.coalesce("iata_code", F.lit("")) != F.lit(""))


def to_airports(text: DataFrame) -> DataFrame:
    """Large and medium airports with a code and a readable position."""
    lat, lon = _readable_position()
    columns = [
        F.col("iata_code").alias("code"),
        F.col("name"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        F.col("tz_database_timezone").alias("timezone"),
        F.col("iso_country").alias("country"),
    ]
    if "load_order" in text.columns:
        columns.append(F.col("load_order"))
    return text.filter(_served() & lat.isNotNull() & lon.isNotNull()).select(*columns)


def rejected_airports(text: DataFrame) -> DataFrame:
    """Airports that would be served but for an unreadable position."""
    lat, lon = _readable_position()
    return text.filter(_served() & (lat.isNull() | lon.isNull()))


def reference_scan(spark: SparkSession, source: str, **options: str) -> DataFrame:
    """The stored reference from any Spark data source, such as a document store's.

    Only the columns the enrichment needs are asked of it.
    """
    stored = spark.read.format(source).options(**options).load()
    return stored.select("code", "name", "timezone", "country")


def with_country_names(airports: DataFrame, names: DataFrame) -> DataFrame:
    """Replace a country code by its name, from ``names(code, country_name)``.

    Live states carry country names while the airport file carries two-letter
    codes; an airport whose code is not in ``names`` keeps the code.
    """
    lookup = names.select(F.col("code").alias("country"), "country_name")
    return (
        airports.join(lookup, "country", "left")
        .withColumn("country", F.coalesce("country_name", "country"))
        .select(*airports.columns)
    )
