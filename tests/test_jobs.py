"""The job entry points, one after the other, as a user would run them."""

import importlib
import json
import sys

import pytest
from pyspark.sql import functions as F

from delayengine.plans import tables
from delayengine.sinks.topics import publish_kafka
from delayengine.sources.flights import scan_rejects
from delayengine.streaming.folders import BatchTable
from delayengine.streaming.history import History
from delayengine.streaming.state import StateTable

SF = "/root/testdata/sf0.001"


def run(monkeypatch, job, *args):
    monkeypatch.setattr(sys, "argv", [job, *map(str, args)])
    importlib.import_module(f"delayengine.jobs.{job}").main()


@pytest.fixture
def raw(spark, tmp_path):
    tables.flight_texts(spark, SF).write.option("header", True).csv(f"{tmp_path}/raw")
    tables.airport_texts(spark, SF).drop("load_order").write.option("header", True).csv(f"{tmp_path}/airports_csv")
    states = tables.states(spark, SF).orderBy(F.desc("event_id")).limit(200)
    vector = F.array("icao24", "callsign", "origin_country", F.col("time_position").cast("string"))
    document = F.to_json(F.struct(F.lit(1).alias("time"), F.array(vector).alias("states")))
    states.select(document.alias("value")).write.text(f"{tmp_path}/docs")
    return tmp_path


def test_all_jobs(spark, raw, monkeypatch, capsys):
    d = raw
    run(monkeypatch, "ingest", "--input", d / "raw", "--output", d / "flights", "--keep-rejects")
    said = capsys.readouterr().out
    rejects = scan_rejects(spark, f"{d}/flights").count()
    assert rejects > 0 and f"undated {rejects}" in said and "CRS_DEP_TIME" in said
    run(monkeypatch, "stats", "--input", d / "flights", "--output", d / "stats", "--year", 1997)
    assert spark.read.parquet(f"{d}/stats/by_hour").count() == 24 + 1  # and the unreadable times
    run(monkeypatch, "train", "--input", d / "flights", "--models", d / "models", "--years", "1996,1997", "--trees", 3, "--depth", 3, "--mode", "collapsed")
    trained = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert trained["auc"] > 0.6 and trained["model"].endswith("models/v1")
    run(monkeypatch, "airports", "--input", d / "airports_csv", "--table", d / "airports")
    run(monkeypatch, "publish", "--input", d / "docs", "--folder", d / "topic")
    run(monkeypatch, "stream", "--folder", d / "topic", "--airports", d / "airports", "--output", d / "live",
        "--model", trained["model"], "--once")
    run(monkeypatch, "stream", "--airports", d / "airports", "--output", d / "live", "--compact")
    assert "1 batches compacted" in capsys.readouterr().out
    history = History(spark, f"{d}/live/history").read()
    assert history.count() == 200 and history.filter("origin_airport_name is not null").count() > 0
    state = StateTable(spark, f"{d}/live/state").read()
    assert 0 < state.count() == state.select("icao24").distinct().count()
    assert 0 < BatchTable(spark, f"{d}/live/scored").read().count() < 200
    run(monkeypatch, "score", "--model", trained["model"], "--history", d / "live/history", "--output", d / "scored", "--rejects", d / "srej")
    assert spark.read.parquet(f"{d}/scored").count() + spark.read.parquet(f"{d}/srej").count() == 200
    capsys.readouterr()
    run(monkeypatch, "quality", "--target", "live", "--state", d / "live/state")
    assert capsys.readouterr().out.strip().endswith("3/3 checks passed")
    with pytest.raises(SystemExit) as stop:  # the test flights are older than the first expected year
        run(monkeypatch, "quality", "--flights", d / "flights", "--history", d / "live/history", "--state", d / "live/state", "--partials", d / "partials")
    out = capsys.readouterr().out
    assert stop.value.code == 1 and "FAIL year from 2019" in out and "PASS icao24 not NULL: violations=0" in out


def test_publish_needs_a_target(monkeypatch, tmp_path):
    with pytest.raises(SystemExit):
        run(monkeypatch, "publish", "--input", tmp_path)


def test_kafka_sink_needs_its_package(spark):
    states = spark.createDataFrame([("a",)], "icao24 string")
    with pytest.raises(Exception, match="(?i)kafka"):
        publish_kafka(states, "nowhere:9092", "flights-raw")
