"""The history of enriched states: a folder a batch at first, days after compaction."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayengine.operators.latest import union_all
from delayengine.streaming.folders import BatchTable, Files, Manifest, Origin

DAY = "event_date"


class History:
    """Append-only rows with ``event_ts``.

    Batches are written below ``live``, each under its own name. ``compact`` rewrites the committed ones as days, each run into a folder of its own,
    and then names folder and batches in a new version of the manifest: readers take a batch either from its own folder or from the days, never
    from both and never a half-written one. A day that several runs have added to is rewritten once it has ``fold`` folders.
    """

    def __init__(self, spark: SparkSession, root: str, fold: int = 8):
        self.spark, self.root, self.fold = spark, root.rstrip("/"), fold
        self.live = BatchTable(spark, f"{self.root}/live")
        self.files = Files(spark, self.root)
        self.manifest = Manifest(spark, self.root)

    def append(self, rows: DataFrame, by: Origin) -> DataFrame:
        """Store the rows of a batch; returns them as stored."""
        self.live.write(rows, by)
        return self.spark.read.schema(rows.schema).parquet(self.live.folder(by))

    def _state(self) -> dict:
        # days: date -> folders that hold rows of it; covered: query -> batches up to here are in the days
        return self.manifest.newest() or {"days": {}, "covered": {}}

    def _open(self, state: dict) -> list[Origin]:
        return [b for b in self.live.batches() if b.batch > state["covered"].get(b.query, -1)]

    def _folder(self, run: str, day: str) -> str:
        return f"{self.root}/days/{run}/{DAY}={day}"

    def read(self, day: datetime.date | None = None) -> DataFrame | None:
        """All rows, or those of one day: then only that day's folders are listed, and the batches not yet compacted."""
        state = self._state()
        chosen = [str(day)] if day is not None else sorted(state["days"])
        parts = [self.spark.read.parquet(self._folder(run, d)) for d in chosen for run in state["days"].get(d, ())]
        recent = self.live.read(self._open(state))
        if recent is not None:
            recent = recent.drop("query", "batch_id")
            parts.append(recent if day is None else recent.where(F.to_date("event_ts") == F.lit(day)))
        return union_all(parts) if parts else None

    def _write_days(self, rows: DataFrame) -> tuple[str, list[str]]:
        """Rows as days in a new folder: its name and the days in it."""
        run = uuid.uuid4().hex
        dated = rows.withColumn(DAY, F.to_date("event_ts")).hint("rebalance", DAY)
        dated.write.partitionBy(DAY).parquet(f"{self.root}/days/{run}")
        return run, [n.removeprefix(f"{DAY}=") for n in self.files.names(f"days/{run}") if n.startswith(f"{DAY}=")]

    def compact(self) -> int:
        """Move the committed batches into days; returns how many. Readers go on meanwhile. A replay of a batch that was moved changes nothing.

        Not while a batch is being written: the last one may be replayed, which must not differ from what was moved, and
        Spark promises just that.
        """
        state = self._state()
        batches = self._open(state)
        if not batches:
            return 0
        run, found = self._write_days(self.live.read(batches).drop("query", "batch_id"))
        days = {d: [*state["days"].get(d, ()), *([run] if d in found else ())] for d in {*state["days"], *found}}
        for day in [d for d, runs in days.items() if len(runs) > self.fold]:
            rows = union_all([self.spark.read.parquet(self._folder(r, day)) for r in days[day]])
            days[day] = [self._write_days(rows)[0]]
        covered = dict(state["covered"])
        for b in batches:
            covered[b.query] = max(b.batch, covered.get(b.query, -1))
        self.manifest.write({"days": days, "covered": covered})
        return len(batches)

    def clean(self) -> None:
        """Delete batch folders that the manifest covers, except the last of each query, and day folders no kept version names.

        Run it when no reader that began before the last compaction is left.
        """
        state = self._state()
        last = dict(self.live.batches())  # in order, so the last batch of each query stays
        for b in self.live.batches():
            if b.batch <= state["covered"].get(b.query, -1) and b.batch < last[b.query]:
                self.files.drop(f"live/query={b.query}/batch_id={b.batch}")
        named = {(run, d) for v in self.manifest.versions() for d, runs in self.manifest.read(v)["days"].items() for run in runs}
        for run in self.files.names("days"):
            for day in self.files.names(f"days/{run}"):
                if day.startswith(f"{DAY}=") and (run, day.removeprefix(f"{DAY}=")) not in named:
                    self.files.drop(f"days/{run}/{day}")
