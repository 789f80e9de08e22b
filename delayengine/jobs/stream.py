"""The live pipeline: messages to current state, history, per-minute counts and scores.

python -m delayengine.jobs.stream --servers S --topic T --airports AIRPORTS --output LIVE [--model M]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from delayengine.operators.enrich import country_reference
from delayengine.operators.model import tabulate
from delayengine.session import get_session, stage
from delayengine.sinks.topics import publish_kafka
from delayengine.sources.live import kafka_stream, text_stream
from delayengine.sources.stored import fitted_model
from delayengine.streaming import pipeline
from delayengine.streaming.folders import BatchTable
from delayengine.streaming.history import History
from delayengine.streaming.state import BUCKETS, DEFAULT_TTL_SECONDS, StateTable

# Keeps the counts' state on local disk instead of the executors' heap.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start(
    spark: SparkSession, raw: DataFrame, airports: DataFrame | str, output: str,
    ttl_seconds: int = DEFAULT_TTL_SECONDS, model: str | None = None,
    enriched_topic: tuple[str, str] | None = None, buckets: int = BUCKETS, **trigger,
) -> list[StreamingQuery]:
    """State and history (and scores, and the enriched topic) in one query, counts in another.

    ``airports`` is a stored table, asked for its newest version in each batch, or rows fixed for the run.
    ``enriched_topic`` is (servers, topic); a replayed batch is published again.
    """
    root = output.rstrip("/")
    extras = []
    if model:
        scored = BatchTable(spark, f"{root}/scored")
        extras.append(pipeline.scored_sink(tabulate(spark, fitted_model(model)), scored))
    if enriched_topic:
        extras.append(lambda states, _: publish_kafka(states, *enriched_topic))
    newest = pipeline.NewestReference(spark, airports) if isinstance(airports, str) else None
    fixed = newest()[0] if newest else stage(country_reference(airports), "countries")
    live = pipeline.live_sink(
        newest or fixed, StateTable(spark, f"{root}/state", ttl_seconds, buckets=buckets), History(spark, f"{root}/history"),
        BatchTable(spark, f"{root}/rejects"), extras,
    )
    # The counts' hub is the airport; theirs is the reference of the start.
    hub = F.coalesce("origin_airport_icao_code", F.lit("UNK"))
    counts = pipeline.minute_density(pipeline.enriched_states(raw, fixed), hub)
    keep = pipeline.counts_sink(BatchTable(spark, f"{root}/counts"))
    return [
        pipeline.run(raw, live, f"{root}/checkpoints/live", **trigger),
        pipeline.run(counts, keep, f"{root}/checkpoints/counts", "update", **trigger),
    ]


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--servers")
    args.add_argument("--topic")
    args.add_argument("--folder", help="JSON lines instead of a topic")
    args.add_argument("--airports", required=True)
    args.add_argument("--output", required=True)
    args.add_argument("--model")
    args.add_argument("--enriched-topic", help="also publish enriched states, to the same servers")
    args.add_argument("--ttl-seconds", type=int, default=DEFAULT_TTL_SECONDS)
    args.add_argument("--buckets", type=int, default=BUCKETS, help="of the state table, for some ten thousand aircraft each")
    args.add_argument("--compact", action="store_true", help="move the history's batches into days, drop what the last compaction moved, and end")
    args.add_argument("--once", action="store_true", help="process what is there and end")
    given = args.parse_args()
    spark = get_session("live-states", spark__sql__streaming__stateStore__providerClass=ROCKSDB)
    if given.compact:
        history = History(spark, f"{given.output.rstrip('/')}/history")
        history.clean()
        print(f"{history.compact()} batches compacted")
        return
    if given.folder:
        raw = text_stream(spark, given.folder)
    else:
        raw = kafka_stream(spark, given.servers, given.topic)
    trigger = {"availableNow": True} if given.once else {}
    queries = start(
        spark, raw, given.airports, given.output, given.ttl_seconds,
        given.model, (given.servers, given.enriched_topic) if given.enriched_topic else None,
        given.buckets, **trigger,
    )
    for query in queries:
        query.awaitTermination()


if __name__ == "__main__":
    main()
