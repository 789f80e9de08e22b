"""Quality figures kept month by month, so that a check reads only the months written since the last one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delayengine.operators.quality import flight_partials
from delayengine.sources.flights import scan_months
from delayengine.streaming.snapshots import SnapshotTable

KEYS = ["year", "month"]


def month_files(spark: SparkSession, root: str) -> DataFrame:
    """A fingerprint of each month's files (names, sizes, times of change). Files are listed, not opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root)
    files = listed.select("path", "length", "modificationTime").where(F.col("path").rlike(r"/year=\d+/month=\d+/[^/]+$"))
    part = lambda name: F.regexp_extract("path", rf"/{name}=(\d+)/", 1).cast("int").alias(name)
    one = F.struct(F.regexp_extract("path", r"[^/]+$", 0), "length", "modificationTime")
    return files.groupBy(part("year"), part("month")).agg(F.xxhash64(F.array_sort(F.collect_list(one))).alias("files"))


def refresh_partials(spark: SparkSession, root: str, store: SnapshotTable, as_of: Column) -> list[tuple[int, int]]:
    """Bring the stored partial rows up to date with the flights below ``root``; returns the months read.

    Only months whose files have changed since their row was made are scanned; rows of months that are gone are dropped.
    The store is small (a row for each month) and versioned, so a failed run leaves the last one in place.
    """
    now = month_files(spark, root)
    old = store.read()
    open_ = now if old is None else now.join(old.select(*KEYS, "files"), [*KEYS, "files"], "left_anti")
    months = sorted((r.year, r.month) for r in open_.select(*KEYS).collect())  # at most a row for each month
    if months:
        flights = scan_months(spark, root)
        wanted = F.lit(False)
        for year, month in months:
            wanted = wanted | ((F.col("year") == F.lit(year)) & (F.col("month") == F.lit(month)))
        fresh = flight_partials(flights.filter(wanted), as_of).join(now, KEYS)
        rows = fresh
        if old is not None:
            rows = fresh.unionByName(old.join(now.select(*KEYS, "files"), [*KEYS, "files"], "left_semi"))
    elif old is not None and old.join(now, [*KEYS, "files"], "left_anti").isEmpty():
        return []
    else:
        rows = old.join(now.select(*KEYS, "files"), [*KEYS, "files"], "left_semi")
    store.write(rows.coalesce(1), (store.versions() or [-1])[-1] + 1)
    return months
