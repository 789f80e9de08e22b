"""The live pipeline: parse, enrich, keep current state and history, count, score."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from delayengine.operators.enrich import country_reference, with_airport
from delayengine.operators.features import state_features
from delayengine.operators.latest import current, union_all
from delayengine.operators.model import ScoreTable, score
from delayengine.session import stage
from delayengine.streaming.folders import BatchTable, origin
from delayengine.streaming.history import History
from delayengine.streaming.messages import flat_states, parse_states, reject_reason
from delayengine.streaming.snapshots import SnapshotTable
from delayengine.streaming.state import DEFAULT_TTL_SECONDS, StateTable, tied

REFERENCE_VERSION = "reference_version"


def merge_state(
    previous: DataFrame | None, states: DataFrame, ttl_seconds: int = DEFAULT_TTL_SECONDS
) -> DataFrame:
    """Current state after ``states`` arrived: newest per aircraft, expired ones gone.

    Newest is by event time, so a late message does not replace a newer one. ``StateTable`` keeps
    the same rows bucket by bucket.
    """
    arrived = union_all([previous, states]) if previous is not None else states
    return current(tied(arrived), "icao24", ["event_ts", "tie"], ttl_seconds).drop("tie")


def enriched_states(raw: DataFrame, reference: DataFrame) -> DataFrame:
    """Usable states of a raw stream or batch, joined with the airport reference."""
    parsed = parse_states(raw)
    return with_airport(flat_states(parsed.filter(reject_reason(parsed).isNull())), reference)


class NewestReference:
    """The country reference out of the newest committed version of a stored airport table.

    Asked once a batch: it is reduced and stored anew only when a version has been added, so an upsert shows in the next batch.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.table = SnapshotTable(spark, root)
        self.version: int | None = None
        self.rows: DataFrame | None = None

    def __call__(self) -> tuple[DataFrame, int]:
        versions = self.table.versions()
        if not versions:
            raise FileNotFoundError(f"no airports stored at {self.table.root}")
        if versions[-1] != self.version:
            self.rows, self.version = stage(country_reference(self.table.at(versions[-1])), "countries"), versions[-1]
        return self.rows, self.version


def live_sink(
    reference: DataFrame | Callable[[], tuple[DataFrame, int]],
    state: StateTable,
    history: History,
    rejects: BatchTable,
    extras: Sequence[Callable[[DataFrame, int], None]] = (),
) -> Callable[[DataFrame, int], None]:
    """What to do with a raw micro-batch: append the history, refresh the state table.

    The batch is read twice, for what is kept and for the rejects, and never cached: parsed messages take many times
    the room of their source, and a task would hold and read its whole part as one block. The enriched rows are stored first and
    the state is merged from the stored rows, so the join runs once. Every write is keyed by query and batch, so a replay after
    a failure repeats it instead of adding to it, and a query with a new checkpoint adds to what is there.
    History rows carry the version of the reference they were joined with (NULL for a fixed one).
    """

    def handle(raw: DataFrame, batch_id: int) -> None:
        by = origin(raw, batch_id)
        airports, version = (reference, None) if isinstance(reference, DataFrame) else reference()
        parsed = parse_states(raw)
        parsed = parsed.withColumn("reason", reject_reason(parsed))
        good = flat_states(parsed.filter(F.col("reason").isNull()).drop("reason"))
        enriched = with_airport(good, airports).withColumn(REFERENCE_VERSION, F.lit(version).cast("long"))
        stored = history.append(enriched, by)
        rejects.write(parsed.filter(F.col("reason").isNotNull()).select("value", "reason"), by)
        stored = stored.drop(REFERENCE_VERSION)
        state.apply(stored, by)
        for extra in extras:
            extra(stored, batch_id)

    return handle


def run(
    stream: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "append",
    **trigger,
) -> StreamingQuery:
    """Start the query; the checkpoint is explicit, and with no trigger named it runs on and on."""
    writer = stream.writeStream.foreachBatch(sink).outputMode(output_mode)
    writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def minute_density(
    states: DataFrame, hub: str | Column, lateness: str = "2 minutes", signal: Column | None = None
) -> DataFrame:
    """Aircraft and ground-delay signals per minute and hub, over event time.

    ``signal`` is by default an aircraft on the ground. ``lateness`` bounds the stream's state: once the newest event is
    that much past a minute's end, the minute is forgotten and its rows are dropped; ``late_rows`` tells which. On a
    batch the watermark has no effect.
    """
    hub = F.col(hub) if isinstance(hub, str) else hub
    grounded = F.coalesce("on_ground", F.lit(False))
    return (
        states.withWatermark("event_ts", lateness)
        .groupBy(F.window("event_ts", "1 minute").alias("w"), hub.alias("region"))
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.count_if(grounded if signal is None else signal).alias("ground_delay_count"),
        )
        .select(F.col("w.start").alias("timestamp"), "region", "count", "ground_delay_count")
    )


def counts_sink(counts: BatchTable) -> Callable[[DataFrame, int], None]:
    """Sink for ``minute_density`` in update mode: each batch stores the counts it changed."""

    def handle(changed: DataFrame, batch_id: int) -> None:
        counts.write(changed, origin(changed, batch_id))

    return handle


def newest_counts(changes: DataFrame) -> DataFrame:
    """The count of each minute and hub out of everything ``counts_sink`` stored.

    A query's last count replaces its earlier ones; counts of several queries (checkpoints) are of
    different rows and add up.
    """
    counts = F.struct("count", "ground_delay_count")
    last = changes.groupBy("query", "timestamp", "region").agg(F.max_by(counts, "batch_id").alias("c"))
    return last.groupBy("timestamp", "region").agg(
        F.sum("c.count").alias("count"), F.sum("c.ground_delay_count").alias("ground_delay_count")
    )


def late_rows(arrived: DataFrame, counted: DataFrame) -> DataFrame:
    """Per minute and hub how many rows that arrived are not counted: those the watermark dropped.

    ``arrived`` is ``minute_density`` of the stored history, ``counted`` is ``newest_counts``; both must have seen
    the same batches. Counting by difference is exact, while the state operator's own metric
    (``dropped_partials``) is of rows already summed per task.
    """
    given = counted.select("timestamp", "region", F.col("count").alias("kept"))
    joined = arrived.select("timestamp", "region", "count").join(given, ["timestamp", "region"], "left")
    late = F.col("count") - F.coalesce("kept", F.lit(0))
    return joined.select("timestamp", "region", late.alias("late")).where(F.col("late") > 0)


def with_late(counted: DataFrame, late: DataFrame) -> DataFrame:
    """The counts and, in a row of its own without minute and hub, how many rows came too late."""
    blank = [F.lit(None).cast(counted.schema[c].dataType).alias(c) for c in ("timestamp", "region")]
    total = late.agg(F.coalesce(F.sum("late"), F.lit(0)).alias("late"))
    return counted.withColumn("late", F.lit(0).cast("long")).unionByName(
        total.select(*blank, *[F.lit(0).cast("long").alias(c) for c in ("count", "ground_delay_count")], "late")
    )


def dropped_partials(query: StreamingQuery) -> int:
    """How many partial sums the state operators of the recent batches dropped as late."""
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"])


def scored_sink(
    scores: ScoreTable, output: BatchTable, mode: str = "strict"
) -> Callable[[DataFrame, int], None]:
    """Score each micro-batch of flat states; unknown airlines get no prediction."""

    def handle(states: DataFrame, batch_id: int) -> None:
        features = state_features(states, F.col("event_ts"), mode)
        output.write(score(scores, features), origin(states, batch_id))

    return handle
