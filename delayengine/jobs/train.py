"""Fit, evaluate and save the delay classifier.

python -m delayengine.jobs.train --input FLIGHTS --models MODELS --version v2 --trees 50 --depth 8
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from delayengine.operators.evaluate import metrics, tally
from delayengine.operators.features import labelled, split_rows, train_and_test, usable
from delayengine.operators.model import counted, fit
from delayengine.session import get_session, stage
from delayengine.sinks.tables import write_metrics, write_model
from delayengine.sources.flights import scan_years


def run(
    spark: SparkSession, source: str, models: str, version: str, years: Sequence[int],
    seed: int = 42, mode: str = "collapsed", extra_identity: Sequence[str] = (), **params,
) -> dict:
    """Returns the metrics, with the row counts seen on the way.

    One scan tallies the flights; evaluation works on the tallied test rows. Training
    does the same, whatever the number of flights, and bags row by row, from a second
    scan, only in mode ``rows``.
    """
    if mode not in ("collapsed", "rows"):
        raise ValueError(f"mode must be collapsed or rows, not {mode!r}")
    raw, raw_seen = counted(scan_years(spark, source, years), "raw")
    rows, seen = counted(split_rows(labelled(raw), extra_identity, seed), "features")
    cells = stage(tally(usable(rows), "held_out"), "tally")
    sizes = cells.agg(
        F.sum("flights").alias("all"),
        F.sum(F.when(~F.col("held_out"), F.col("flights"))).alias("train"),
    ).first()
    collapsed = mode == "collapsed"
    train, test = train_and_test(cells)
    if not collapsed:
        train, _ = train_and_test(rows)
    model = fit(train, collapsed, seed=seed, **params)
    path = write_model(model, models, version)
    row = metrics(model.transform(test))
    write_metrics(row, models, version)
    found = json.loads(row.select(F.to_json(F.struct("*"))).first()[0])
    counts = {
        "raw": raw_seen.get["rows"],
        "features": seen.get["rows"],
        "train": sizes["train"],
        "test": sizes["all"] - sizes["train"],
    }
    return {"model": path, "mode": mode, "rows": counts, **found}


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--input", required=True)
    args.add_argument("--models", required=True)
    args.add_argument("--version", default="v1")
    args.add_argument("--years", default="2021,2022,2023")
    args.add_argument("--trees", type=int, default=20)
    args.add_argument("--depth", type=int, default=5)
    args.add_argument("--max-bins", type=int, default=64)
    args.add_argument("--seed", type=int, default=42)
    args.add_argument("--mode", choices=["collapsed", "rows"], default="collapsed", help="see README")
    given = args.parse_args()
    found = run(
        get_session("delay-train"), given.input, given.models, given.version,
        [int(y) for y in given.years.split(",") if y.strip()],
        given.seed, given.mode,
        trees=given.trees, depth=given.depth, max_bins=given.max_bins,
    )
    print(json.dumps(found))


if __name__ == "__main__":
    main()
