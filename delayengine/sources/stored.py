"""Reading back what the pipeline stored."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession

from delayengine.operators.normalize import api_records, first_records
from delayengine.streaming.snapshots import SnapshotTable
from delayengine.streaming.state import DEFAULT_TTL_SECONDS, StateTable


def whole_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet as it lies, for the quality checks."""
    return spark.read.parquet(path)


def airport_table(spark: SparkSession, root: str) -> DataFrame:
    """The newest version of the stored airport reference."""
    airports = SnapshotTable(spark, root).read()
    if airports is None:
        raise FileNotFoundError(f"no airports stored at {root}")
    return airports


def live_records(
    spark: SparkSession, root: str, as_of: Column, limit: int = 500, ttl_seconds: int = DEFAULT_TTL_SECONDS
) -> DataFrame:
    """Positioned records of the current state in the service layout, first by aircraft.

    States older than ``ttl_seconds`` at ``as_of`` (now) are left out, also those that have grown so since the last batch.
    """
    state = StateTable(spark, root, ttl_seconds).read(as_of)
    if state is None:
        raise FileNotFoundError(f"no live state at {root}")
    return first_records(api_records(state, as_of), limit)


def fitted_model(path: str) -> PipelineModel:
    """A saved model, read by Spark straight from its storage."""
    return PipelineModel.load(path)
