"""Writing flights, statistics, airports, models and metrics."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayengine.operators.latest import upsert
from delayengine.operators.stats import split_stats
from delayengine.session import stage
from delayengine.streaming.snapshots import SnapshotTable


def write_months(flights: DataFrame, root: str, compact: bool = True) -> None:
    """Replace the months present in ``flights`` and leave all others as they are.

    ``compact`` groups rows by month before the write to avoid many small files; it is
    a rebalance, so adaptive execution splits a month that is too large for one task.
    Turn it off where the input already arrives month by month.
    """
    rows = flights.hint("rebalance", "year", "month") if compact else flights
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("year", "month")
        .parquet(root)
    )


def write_stats(combined: DataFrame, root: str) -> None:
    """The three statistics tables under ``root``, from one scan of the flights.

    The combined aggregate is small; it is stored once and split from there. The
    rebalance leaves one file per table as long as the table is small.
    """
    stored = stage(combined, "stats")
    for name, table in split_stats(stored).items():
        table.hint("rebalance").write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")


def write_airports(table: SnapshotTable, incoming: DataFrame, order: str = "load_order") -> None:
    """Upsert airports by code into the stored reference; the last record wins."""
    version = (table.versions() or [-1])[-1] + 1
    stored = table.read()
    if stored is None:
        stored = incoming.drop(order).limit(0)
    table.write(upsert(stored, incoming, "code", [order]), version)


def write_model(model: PipelineModel, models: str, version: str) -> str:
    path = f"{models.rstrip('/')}/{version}"
    model.write().overwrite().save(path)
    return path


def write_metrics(metrics: DataFrame, models: str, version: str) -> str:
    """One line of JSON per model version, next to the model directory."""
    path = f"{models.rstrip('/')}/{version}_metrics.json"
    metrics.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode(
        "overwrite"
    ).text(path)
    return path
