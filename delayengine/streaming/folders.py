"""What the live pipeline's tables share: who wrote a batch, committed folders, and small versioned manifests."""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

DIRECT = "direct"  # stands for the query of a batch that no streaming query wrote


class Origin(NamedTuple):
    """The streaming query (its id lives in its checkpoint) and the batch of it."""

    query: str
    batch: int


def origin(rows: DataFrame, batch_id: int) -> Origin:
    """Whose batch this is. Inside ``foreachBatch`` Spark names the query in a local property.

    A query started from a new checkpoint has a new id, so its batch 0 is not the batch 0 of the one before.
    """
    query = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return Origin(query or DIRECT, batch_id)


class Files:
    """The few file operations Spark's readers and writers lack, on whatever file system ``root`` is on."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        """Names below a folder of ``root``, in order; none if it is not there."""
        path = self._path(f"{self.root}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def committed(self, folder: str) -> list[str]:
        """Those with Spark's commit marker."""
        return [n for n in self.names(folder) if self._fs.exists(self._path(f"{self.root}/{folder}/{n}/_SUCCESS"))]

    def drop(self, folder: str) -> None:
        self._fs.delete(self._path(f"{self.root}/{folder}"), True)


class Manifest:
    """A small document of which each change is a new version; a version counts once its commit marker is there.

    Numbers grow on their own, whoever writes. One writer at a time, as for any streaming sink.
    """

    def __init__(self, spark: SparkSession, root: str, keep: int = 3):
        self.spark, self.keep = spark, keep
        self.files = Files(spark, root)

    def versions(self) -> list[int]:
        return sorted(int(n.removeprefix("version=")) for n in self.files.committed("manifest") if n.startswith("version="))

    def read(self, version: int) -> dict:
        return json.loads(self.spark.read.text(f"{self.files.root}/manifest/version={version}").first().value)

    def newest(self) -> dict | None:
        found = self.versions()
        return self.read(found[-1]) if found else None

    def write(self, content: dict) -> int:
        found = self.versions()
        version = found[-1] + 1 if found else 0
        line = self.spark.createDataFrame([(json.dumps(content),)], "value string").coalesce(1)
        line.write.mode("overwrite").text(f"{self.files.root}/manifest/version={version}")
        for old in found[: -self.keep]:
            self.files.drop(f"manifest/version={old}")
        return version


class BatchTable:
    """Append-only rows below ``root/query=<id>/batch_id=<n>``: a replayed batch overwrites its own folder and no other."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, self.root)

    def folder(self, by: Origin) -> str:
        return f"{self.root}/query={by.query}/batch_id={by.batch}"

    def write(self, rows: DataFrame, by: Origin) -> None:
        rows.write.mode("overwrite").parquet(self.folder(by))

    def batches(self) -> list[Origin]:
        """The committed batches."""
        found = []
        for query in self.files.names(""):
            if query.startswith("query="):
                own = [n for n in self.files.committed(query) if n.startswith("batch_id=")]
                found += [Origin(query.removeprefix("query="), int(n.removeprefix("batch_id="))) for n in own]
        return sorted(found)

    def read(self, batches: list[Origin] | None = None) -> DataFrame | None:
        """The rows of the given batches (all committed ones), with ``query`` and ``batch_id``; nothing if there are none."""
        chosen = self.batches() if batches is None else batches
        if not chosen:
            return None
        reader = self.spark.read.option("basePath", self.root).option("mergeSchema", True)
        return reader.parquet(*map(self.folder, chosen))
