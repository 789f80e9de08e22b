"""The newest unexpired state of each aircraft, in hash buckets of which a batch rewrites those it touches."""

from __future__ import annotations

import datetime
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from delayengine.operators.latest import latest, union_all, unexpired
from delayengine.streaming.folders import Files, Manifest, Origin

DEFAULT_TTL_SECONDS = 60  # fixed value
BUCKETS = 64
_EPOCH = datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)


def tied(states: DataFrame) -> DataFrame:
    """A last sort key from the row's content, so that equal times have a fixed order."""
    return states.withColumn("tie", F.xxhash64(*states.columns))


class StateTable:
    """One row for each ``key``, by event time.

    A version is a manifest: for each bucket the folder with its rows, and the minutes of its oldest and newest state. A batch reads and
    rewrites only the buckets of its own keys; a bucket whose newest state has expired leaves the manifest unread. Expired states in
    buckets that a batch does not touch stay in their files until it does, and are left out by ``read``.

    The manifest also names the last batch applied of each query: a replay of it changes nothing, while batch 0
    of a query with a new checkpoint is one more batch. Choose ``buckets`` so that one holds some ten thousand
    live keys or more; they are fixed once the table is there.
    """

    def __init__(
        self, spark: SparkSession, root: str, ttl_seconds: int = DEFAULT_TTL_SECONDS, key: str = "icao24",
        buckets: int = BUCKETS, keep: int = 3,
    ):
        self.spark, self.root, self.ttl_seconds, self.key, self.buckets = spark, root.rstrip("/"), ttl_seconds, key, buckets
        self.files = Files(spark, self.root)
        self.manifest = Manifest(spark, self.root, keep)

    def versions(self) -> list[int]:
        return self.manifest.versions()

    def _folders(self, state: dict, buckets: list[str]) -> list[str]:
        return [f"{self.root}/data/{state['buckets'][b]['folder']}/bucket={b}" for b in buckets]

    def read(self, as_of: Column | None = None) -> DataFrame | None:
        """The states unexpired at the newest event seen, or at ``as_of``; nothing before the first batch with rows."""
        state = self.manifest.newest()
        if state is None or not state["schema"]:
            return None
        schema = StructType.fromJson(json.loads(state["schema"]))
        folders = self._folders(state, list(state["buckets"]))
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(*folders)
        return unexpired(rows, self.ttl_seconds, horizon=F.timestamp_micros(F.lit(state["horizon"])) if as_of is None else as_of)

    def apply(self, states: DataFrame, by: Origin) -> list[int]:
        """Merge a batch; returns the buckets rewritten. Newest is by event time, so a late message replaces no newer one."""
        state = self.manifest.newest() or {"horizon": None, "applied": {}, "buckets": {}, "schema": None, "size": self.buckets}
        if state["size"] != self.buckets:
            raise ValueError(f"the table has {state['size']} buckets, not {self.buckets}")
        if state["applied"].get(by.query, -1) >= by.batch:
            return []
        own = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        arrived = latest(tied(states), self.key, ["event_ts", "tie"]).drop("tie").persist()
        try:
            met = arrived.groupBy(own.alias("bucket")).agg(F.unix_micros(F.max("event_ts")).alias("newest")).collect()  # at most ``buckets``
            applied = {**state["applied"], by.query: by.batch}
            if not met:
                self.manifest.write({**state, "applied": applied})
                return []
            horizon = max([r.newest for r in met] + ([state["horizon"]] if state["horizon"] is not None else []))
            touched = [str(r.bucket) for r in met]
            held = self._folders(state, [b for b in touched if b in state["buckets"]])
            parts = [self.spark.read.parquet(*held), arrived] if held else [arrived]
            merged = latest(tied(union_all(parts)), self.key, ["event_ts", "tie"]).drop("tie")
            merged = unexpired(merged, self.ttl_seconds, horizon=F.timestamp_micros(F.lit(horizon)))
            folder = uuid.uuid4().hex
            merged.withColumn("bucket", own).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.root}/data/{folder}")
        finally:
            arrived.unpersist()
        schema = merged.schema
        limit = horizon - self.ttl_seconds * 1_000_000
        buckets = {b: x for b, x in state["buckets"].items() if b not in touched and x["newest"] > limit}
        stored = self.spark.read.schema(StructType.fromDDL(f"{schema.toDDL()}, bucket int")).parquet(f"{self.root}/data/{folder}")
        ages = stored.groupBy("bucket").agg(F.unix_micros(F.min("event_ts")), F.unix_micros(F.max("event_ts")), F.count("*"))
        for bucket, oldest, newest, rows in ages.collect():  # at most ``buckets``
            buckets[str(bucket)] = {"folder": folder, "oldest": oldest, "newest": newest, "rows": rows}
        self.manifest.write({**state, "horizon": horizon, "applied": applied, "buckets": buckets, "schema": schema.json()})
        self._clean()
        return sorted(int(b) for b in touched)

    def due(self) -> list[tuple[datetime.datetime, int]]:
        """When each bucket's last state expires, soonest first: the index that ``apply`` drops buckets by."""
        state = self.manifest.newest() or {"buckets": {}}
        ends = [(x["newest"] + self.ttl_seconds * 1_000_000, int(b)) for b, x in state["buckets"].items()]
        return [(_EPOCH + datetime.timedelta(microseconds=at), b) for at, b in sorted(ends)]

    def _clean(self) -> None:
        """Folders that no kept version names; a folder being written is newer than all versions but named by none, so only one writer may run."""
        named = {x["folder"] for v in self.versions() for x in self.manifest.read(v)["buckets"].values()}
        for folder in self.files.names("data"):
            if folder not in named:
                self.files.drop(f"data/{folder}")
