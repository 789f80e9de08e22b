"""Score a table of features or of live states.

python -m delayengine.jobs.score --model MODELS/v1 --input TABLE --output SCORED --rejects PATH
(or --history LIVE/history instead of --input)
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayengine.operators.features import state_features
from delayengine.operators.model import rejected, score, tabulate
from delayengine.schema import FEATURES
from delayengine.session import get_session
from delayengine.sources.stored import fitted_model, whole_table
from delayengine.streaming.history import History


def run(
    spark: SparkSession, model: str, rows: DataFrame, output: str, rejects: str | None = None,
    mode: str = "strict",
) -> None:
    """Features are used as they are; without them they are derived from live states."""
    if not set(FEATURES) <= set(rows.columns):
        rows = state_features(rows, F.current_timestamp(), mode)
    score(tabulate(spark, fitted_model(model)), rows).write.mode("overwrite").parquet(output)
    if rejects:
        rejected(rows).write.mode("overwrite").parquet(rejects)


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--model", required=True)
    source = args.add_mutually_exclusive_group(required=True)
    source.add_argument("--input", help="a table")
    source.add_argument("--history", help="the live pipeline's history")
    args.add_argument("--output", required=True)
    args.add_argument("--rejects")
    args.add_argument("--carrier-mode", choices=["strict", "fallback"], default="strict")
    given = args.parse_args()
    spark = get_session("delay-score")
    rows = whole_table(spark, given.input) if given.input else History(spark, given.history).read()
    if rows is None:
        raise SystemExit(f"no history at {given.history}")
    run(spark, given.model, rows, given.output, given.rejects, given.carrier_mode)


if __name__ == "__main__":
    main()
