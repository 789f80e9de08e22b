"""Turn polled documents into one message per state.

python -m delayengine.jobs.publish --input DOCUMENTS (--folder DIR | --servers S --topic T)
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from delayengine.session import get_session
from delayengine.sinks.topics import publish_files, publish_kafka
from delayengine.streaming.messages import parse_vectors


def run(
    spark: SparkSession, source: str, folder: str | None = None,
    servers: str | None = None, topic: str | None = None,
) -> None:
    """``source`` holds one JSON document per line."""
    states = parse_vectors(spark.read.text(source), F.current_timestamp())
    if folder:
        publish_files(states, folder)
    if topic:
        publish_kafka(states, servers, topic)


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--input", required=True)
    args.add_argument("--folder")
    args.add_argument("--servers")
    args.add_argument("--topic")
    given = args.parse_args()
    if not given.folder and not (given.servers and given.topic):
        args.error("give --folder, or --servers and --topic")
    run(get_session("publish-states"), given.input, given.folder, given.servers, given.topic)


if __name__ == "__main__":
    main()
