"""Versioned tables: each write is a whole new version, readers take the newest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from delayengine.streaming.folders import Files


class SnapshotTable:
    """A small keyed table kept as ``root/version=<n>`` directories.

    A version counts once its ``_SUCCESS`` marker is there, so readers never see a
    half-written one. ``keep`` older versions stay for readers still using them.
    """

    def __init__(self, spark: SparkSession, root: str, keep: int = 3):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep = keep
        self._files = Files(spark, self.root)

    def _folder(self, version: int) -> str:
        return f"{self.root}/version={version}"

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        names = [n.removeprefix("version=") for n in self._files.committed("") if n.startswith("version=")]
        return sorted(int(n) for n in names if n.isdigit())

    def at(self, version: int) -> DataFrame:
        return self.spark.read.parquet(self._folder(version))

    def read(self, before: int | None = None) -> DataFrame | None:
        """The newest version, or the newest one older than ``before``."""
        fitting = [v for v in self.versions() if before is None or v < before]
        return self.spark.read.parquet(self._folder(fitting[-1])) if fitting else None

    def write(self, rows: DataFrame, version: int) -> None:
        rows.write.mode("overwrite").parquet(self._folder(version))
        for old in [v for v in self.versions() if v < version][: -self.keep]:
            self._files.drop(f"version={old}")
