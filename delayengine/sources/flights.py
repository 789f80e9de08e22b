"""Reading flights: raw CSV text and the month-partitioned Parquet table."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delayengine.schema import CSV_NAMES, FLIGHT_TYPES, REQUIRED_FLIGHT_COLUMNS


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Every CSV below ``path`` with all columns as text.

    Columns are known by header name. ``enforceSchema`` is off, so a file whose
    header disagrees with the first one fails instead of filling wrong columns.
    """
    return (
        spark.read.option("header", True)
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", False)
        .option("recursiveFileLookup", True)
        .csv(path)
    )


def csv_headers(spark: SparkSession, path: str) -> DataFrame:
    """``header`` and ``files`` for each kind of first line below ``path``.

    One pass over the text without parsing it: a header is the line, in a file's first block, that names all
    required columns. A file without one is listed under a NULL header.
    """
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(path)
    at = F.col("_metadata.file_path").alias("file")
    bare = F.regexp_replace("value", r'^\x{FEFF}|["\r]', "")
    cells = F.transform(F.split(bare, ","), F.trim)
    needed = F.array(*[F.lit(CSV_NAMES[c]) for c in REQUIRED_FLIGHT_COLUMNS])
    # cheap test first: most lines hold no column name
    named = F.col("value").contains(CSV_NAMES[REQUIRED_FLIGHT_COLUMNS[0]]) & (F.size(F.array_except(needed, cells)) == 0)
    found = text.select(at, F.when(named & (F.col("_metadata.file_block_start") == 0), F.concat_ws(",", cells)).alias("header"))
    first = found.groupBy("file").agg(F.min("header").alias("header"))
    return first.groupBy("header").agg(F.array_sort(F.collect_list("file")).alias("files"))


def read_mixed_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every CSV below ``path`` as text, whatever columns each file has and in which order.

    Files of one header are read together; the parts are put together by name, with NULL where a file lacks a column.
    Files that don't name the required columns are an error.
    """
    kinds = csv_headers(spark, path).collect()  # a row for each kind of header; a reader needs the file names anyway
    unreadable = [f for k in kinds if k.header is None for f in k.files]
    if unreadable:
        raise ValueError(f"required columns absent from the CSV header of {len(unreadable)} files: {unreadable[:5]}")
    if not kinds:
        raise FileNotFoundError(f"no CSV files below {path}")
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
    parts = [reader.csv(k.files) for k in sorted(kinds, key=lambda k: k.header)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _number(text: Column, kind: str) -> Column:
    # Through double: '12.00' is a valid integer text in these files; NaN is no value.
    value = text.try_cast("double")
    value = F.when(~F.isnan(value), value)
    return value.try_cast(kind)


def to_flights(raw: DataFrame) -> DataFrame:
    """Canonical columns from source-named text columns; unreadable values become NULL."""
    missing = [c for c in REQUIRED_FLIGHT_COLUMNS if CSV_NAMES[c] not in raw.columns]
    if missing:
        raise ValueError(f"required columns absent from the CSV header: {missing}")
    out = []
    for name, kind in FLIGHT_TYPES.items():
        source = CSV_NAMES[name]
        if source not in raw.columns:
            value = F.lit(None).cast(kind)
        elif kind == "string":
            value = F.col(source)
        else:
            value = _number(F.col(source), kind)
        out.append(value.alias(name))
    return raw.select(*out)


def failure_counts(raw: DataFrame) -> list[Column]:
    """Per numeric column, how many non-empty texts do not convert: aggregates, or metrics to observe."""
    counts = []
    for name, kind in FLIGHT_TYPES.items():
        source = CSV_NAMES[name]
        if kind == "string" or source not in raw.columns:
            continue
        text = F.col(source)
        lost = (F.trim(text) != F.lit("")) & _number(text, kind).isNull()
        counts.append(F.count_if(lost).alias(name))
    return counts


def cast_failures(raw: DataFrame) -> DataFrame:
    """One row of ``failure_counts``."""
    return raw.agg(*failure_counts(raw))


def scan_months(
    spark: SparkSession, root: str, year: int | None = None, month: int | None = None
) -> DataFrame:
    """The ``year=/month=`` directories of ``root``; siblings with other layouts are not read.

    The two filters are on partition columns, so they prune directories.
    """
    root = root.rstrip("/")
    flights = spark.read.option("basePath", root).parquet(f"{root}/year=*/month=*")
    return in_month(flights.filter(F.col("year").isNotNull()), year, month)


def scan_rejects(spark: SparkSession, root: str) -> DataFrame:
    """Rows without a readable date, which the ingest keeps in the partition without year and month."""
    root = root.rstrip("/")
    flights = spark.read.option("basePath", root).parquet(f"{root}/year=*/month=*")
    return flights.filter(F.col("year").isNull()).drop("year", "month")


def in_month(flights: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    if year is not None:
        flights = flights.filter(F.col("year") == F.lit(year))
    if month is not None:
        flights = flights.filter(F.col("month") == F.lit(month))
    return flights


def scan_years(spark: SparkSession, root: str, years: Iterable[int]) -> DataFrame:
    """Only the named year directories are listed and read."""
    root = root.rstrip("/")
    folders = [f"{root}/year={int(y)}" for y in years]
    if not folders:
        raise ValueError("name at least one year")
    return spark.read.option("basePath", root).parquet(*folders)
