"""Keyed merges: the newest row per key, expiry, and upserts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` for each key; rows without a key are left out.

    An aggregate rather than a window: each task reduces a hot key to one row before
    the shuffle.
    """
    rest = [c for c in rows.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    return (
        rows.filter(F.coalesce(F.col(key), F.lit("")) != F.lit(""))
        .groupBy(key)
        .agg(newest.alias("row"))
        .select(key, "row.*")
        .select(*rows.columns)
    )


def unexpired(
    states: DataFrame, ttl_seconds: int, time: str = "event_ts", horizon: Column | None = None
) -> DataFrame:
    """States younger than ``ttl_seconds``, measured from the newest event seen.

    ``horizon`` gives that newest event time where it is already known; otherwise it
    is a scalar subquery over ``states``.
    """
    if horizon is None:
        horizon = states.agg(F.max(time)).scalar()
    return states.filter(F.col(time) > horizon - F.make_dt_interval(secs=F.lit(ttl_seconds)))


def current(
    states: DataFrame, key: str, order: Sequence[str], ttl_seconds: int, horizon: Column | None = None
) -> DataFrame:
    """The newest unexpired state per key; ``order`` starts with the event time.

    Expired states are dropped first: that leaves the same result, as a key's newest
    state is expired only if all of its states are, and the time filter can reach the
    scan so that old history is never read.
    """
    return latest(unexpired(states, ttl_seconds, order[0], horizon), key, order)


def upsert(stored: DataFrame, incoming: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """``stored`` with ``incoming`` written over it by key; the last incoming row wins.

    Columns ``incoming`` does not carry keep their stored values. One shuffle with
    map-side reduction; ``stored`` holds each key once.
    """
    carried = [c for c in stored.columns if c != key and c in incoming.columns]
    kept = [c for c in stored.columns if c != key and c not in incoming.columns]
    blank_order = F.lit(None).cast(incoming.select(F.struct(*order).alias("o")).schema["o"].dataType)
    old = stored.select(
        key, F.struct(*carried).alias("values"), F.lit(0).alias("age"),
        blank_order.alias("position"), *kept,
    )
    blanks = [F.lit(None).cast(stored.schema[c].dataType).alias(c) for c in kept]
    values = F.struct(*[F.col(c).cast(stored.schema[c].dataType).alias(c) for c in carried])
    new = incoming.select(
        key, values.alias("values"), F.lit(1).alias("age"),
        F.struct(*order).alias("position"), *blanks,
    )
    merged = old.unionByName(new).groupBy(key).agg(
        F.max_by("values", F.struct("age", "position")).alias("values"),
        *[F.max(c).alias(c) for c in kept],
    )
    return merged.select(key, "values.*", *kept).select(*stored.columns)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
