"""The live pipeline over file streams: replays, lateness, expiry, counts, scores."""

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from delayengine.jobs import quality as quality_job
from delayengine.jobs import stream as stream_job
from delayengine.operators import model
from delayengine.operators.enrich import country_reference
from delayengine.session import get_session, new_folder, shared_folder, stage
from delayengine.sources.airports import reference_scan
from delayengine.sources.live import kafka_stream, text_stream
from delayengine.sinks.tables import write_airports
from delayengine.streaming import messages, pipeline
from delayengine.streaming.folders import BatchTable, Manifest, Origin, origin
from delayengine.streaming.history import History
from delayengine.streaming.snapshots import SnapshotTable
from delayengine.streaming.state import StateTable


def message(icao24, time, **more):
    return json.dumps({"icao24": icao24, "polled_at": f"2024-05-01T{time}+00:00", **more})


@pytest.fixture(scope="module")
def airports(spark):
    return spark.createDataFrame(
        [("KAA", "Alpha", "T1", "X"), ("KAB", "Beta", "T0", "X")],
        "code string, name string, timezone string, country string",
    )


def drop(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    hidden = os.path.join(folder, f".{name}")
    with open(hidden, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    os.rename(hidden, os.path.join(folder, name))


def finish(queries):
    for query in queries:
        query.awaitTermination()


def live(spark, airports, base, ttl=60, model_path=None):
    raw = text_stream(spark, f"{base}/in", files_per_trigger=1)
    finish(stream_job.start(spark, raw, airports, f"{base}/out", ttl, model_path, availableNow=True))
    return StateTable(spark, f"{base}/out/state", ttl).read()


def history(spark, base):
    return History(spark, f"{base}/out/history").read()


def counts(spark, base):
    return pipeline.newest_counts(BatchTable(spark, f"{base}/out/counts").read())


def test_state_history_and_rejects(spark, airports, tmp_path):
    base = str(tmp_path)
    drop(f"{base}/in", "1.json", message("a", "10:00:00", origin_country="X", velocity=1.0), message("b", "10:00:10", on_ground=True), "{broken", "{}")
    state = {r.icao24: r for r in live(spark, airports, base).collect()}
    assert set(state) == {"a", "b"}
    assert (state["a"].origin_airport_icao_code, state["a"].origin_airport_timezone) == ("KAA", "T0")
    assert state["b"].origin_airport_name is None
    drop(f"{base}/in", "2.json", message("a", "10:00:40", velocity=2.0))
    drop(f"{base}/in", "3.json", message("a", "10:00:20", velocity=9.0), message("c", "10:01:11"))
    state = {r.icao24: r.velocity for r in live(spark, airports, base).collect()}
    assert state == {"a": 2.0, "c": None}  # the late message lost, b expired
    out = f"{base}/out"
    assert history(spark, base).count() == 5
    assert BatchTable(spark, f"{out}/rejects").read().count() == 2
    found = counts(spark, base).collect()
    assert sum(r["count"] for r in found) == 5 and sum(r.ground_delay_count for r in found) == 1
    assert {r.region for r in found} == {"KAA", "UNK"}
    report = quality_job.report(spark, "enriched", None, f"{out}/history", None).first()
    assert report.passed
    assert all(r.passed for r in quality_job.report(spark, "live", None, None, f"{out}/state").collect())
    assert not all(r.passed for r in quality_job.report(spark, "live", None, None, f"{out}/none").collect())


def test_stream_joins_the_reference_directly(spark, airports, tmp_path):
    """The enrichment is a stream-static left join in its own right."""
    drop(f"{tmp_path}/in", "1.json", message("a", "10:00:00", origin_country="X"), message("b", "10:00:00"))
    reference = stage(country_reference(airports), "countries")
    enriched = pipeline.enriched_states(text_stream(spark, f"{tmp_path}/in"), reference)
    assert enriched.isStreaming
    out = f"{tmp_path}/out"
    query = enriched.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{tmp_path}/c")
    query.trigger(availableNow=True).start().awaitTermination()
    rows = {r.icao24: r.origin_airport_icao_code for r in spark.read.parquet(out).collect()}
    assert rows == {"a": "KAA", "b": None}


def test_reference_from_any_source(spark, airports, tmp_path):
    path = str(tmp_path / "airports")
    airports.withColumn("extra", F.lit(1)).write.json(path)
    read = reference_scan(spark, "json", path=path)
    assert read.columns == ["code", "name", "timezone", "country"] and read.count() == 2


def batch(spark, *lines):
    return spark.createDataFrame([(x,) for x in lines], "value string").withColumn("arrived_at", F.current_timestamp())


def everything(spark, root):
    tables = StateTable(spark, f"{root}/state").read(), History(spark, f"{root}/history").read(), BatchTable(spark, f"{root}/rejects").read()
    return [sorted(map(str, t.collect())) for t in tables]


def test_replayed_batch_changes_nothing(spark, airports, tmp_path):
    root = str(tmp_path)
    state, stored = StateTable(spark, f"{root}/state"), History(spark, f"{root}/history")
    sink = pipeline.live_sink(country_reference(airports), state, stored, BatchTable(spark, f"{root}/rejects"))
    first = batch(spark, message("a", "10:00:00"), message("b", "10:00:01"))
    second = batch(spark, message("a", "10:00:30", velocity=5.0), "bad")
    sink(first, 0)
    sink(second, 1)
    before, versions = everything(spark, root), state.versions()
    assert [len(x) for x in before] == [2, 3, 1]
    sink(second, 1)
    assert everything(spark, root) == before and state.versions() == versions
    stored.compact()
    sink(second, 1)  # also once the batch has been moved
    assert everything(spark, root) == before


def test_new_checkpoint_adds_to_the_output(spark, airports, tmp_path):
    """Batch 0 of a new query is not the batch 0 of the one before."""
    base = str(tmp_path)
    sink = pipeline.live_sink(
        country_reference(airports), StateTable(spark, f"{base}/out/state"), History(spark, f"{base}/out/history"), BatchTable(spark, f"{base}/out/rejects")
    )
    for n, lines in enumerate(([message("a", "10:00:00"), message("b", "10:00:10")], [message("c", "10:00:20")])):
        drop(f"{base}/in{n}", "1.json", *lines)
        raw = text_stream(spark, f"{base}/in{n}")
        pipeline.run(raw, sink, f"{base}/checkpoint-{n}", availableNow=True).awaitTermination()
    assert {r.icao24 for r in StateTable(spark, f"{base}/out/state").read().collect()} == {"a", "b", "c"}
    assert history(spark, base).count() == 3
    found = History(spark, f"{base}/out/history").live.batches()
    assert [b.batch for b in found] == [0, 0] and len({b.query for b in found}) == 2


def test_counts_of_two_checkpoints_add_up(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "counts"))
    row = "timestamp timestamp, region string, count long, ground_delay_count long"
    minute = datetime.datetime(2024, 5, 1, 10)
    for by, n in ((Origin("q", 9), 2), (Origin("q", 10), 5), (Origin("r", 0), 1)):
        table.write(spark.createDataFrame([(minute, "X", n, 0)], row), by)
    assert [r["count"] for r in pipeline.newest_counts(table.read()).collect()] == [6]


def test_unusable_messages_say_why(spark):
    raw = batch(spark, "{broken", json.dumps({"icao24": "a", "polled_at": "never"}), message("", "10:00:00"), message("b", "10:00:00"))
    for frame, want in ((raw, ["no aircraft", None, "no aircraft", None]), (raw.drop("arrived_at"), ["no aircraft", "no time", "no aircraft", None])):
        parsed = messages.parse_states(frame)
        assert [r.r for r in parsed.select(messages.reject_reason(parsed).alias("r")).collect()] == want


def states_at(spark, *rows):
    frame = spark.createDataFrame(rows, "icao24 string, t string, velocity double")
    return frame.withColumn("event_ts", F.concat(F.lit("2024-05-01 "), "t").cast("timestamp")).drop("t")


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "s"), buckets=16)
    assert table.read() is None and table.due() == []
    many = [(f"k{i}", "10:00:00", float(i)) for i in range(200)]
    assert table.apply(states_at(spark, *many), Origin("q", 0)) == list(range(16))
    before = table.manifest.newest()["buckets"]
    touched = table.apply(states_at(spark, ("k7", "10:00:30", 70.0)), Origin("q", 1))
    after = table.manifest.newest()["buckets"]
    assert len(touched) == 1 and {b for b in before if before[b] != after[b]} == {str(touched[0])}
    rows = {r.icao24: r.velocity for r in table.read().collect()}
    assert len(rows) == 200 and rows["k7"] == 70.0
    # the others expire; the one bucket of k7 stays, in part, and the rest leave the manifest unread
    assert table.apply(states_at(spark, ("k7", "10:01:10", 71.0)), Origin("q", 2)) == touched
    assert [r.icao24 for r in table.read().collect()] == ["k7"] and list(table.manifest.newest()["buckets"]) == [str(touched[0])]
    assert [b for _, b in table.due()] == touched
    assert len(table.files.names("data")) <= 3
    with pytest.raises(ValueError, match="16 buckets"):
        StateTable(spark, table.root, buckets=8).apply(states_at(spark, ("a", "10:00:00", 1.0)), Origin("q", 3))


def test_late_and_empty_batches(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "s"), buckets=4)
    table.apply(states_at(spark, ("x", "10:00:00", 1.0)).limit(0), Origin("q", 0))
    assert table.read() is None
    table.apply(states_at(spark, ("a", "10:00:40", 1.0), ("a", "10:00:50", 2.0), ("a", "10:00:50", 2.0)), Origin("q", 1))
    table.apply(states_at(spark, ("a", "10:00:45", 3.0), ("b", "09:00:00", 4.0)), Origin("q", 2))  # late: one older, one expired
    assert [(r.icao24, r.velocity) for r in table.read().collect()] == [("a", 2.0)]
    now = F.lit("2024-05-01 10:05:00").cast("timestamp")
    assert table.read(now).count() == 0


def test_compaction_moves_batches_into_days(spark, tmp_path):
    table = History(spark, str(tmp_path / "h"), fold=2)
    assert table.read() is None and table.compact() == 0
    day = datetime.date

    def add(n, *moments):
        rows = spark.createDataFrame([(f"{n}", m) for m in moments], "icao24 string, t string")
        table.append(rows.withColumn("event_ts", F.col("t").cast("timestamp")), Origin("q", n))

    add(0, "2024-05-01 23:59:59", "2024-05-02 00:00:00")
    add(1, "2024-05-02 10:00:00")
    before = sorted(map(str, table.read().collect()))
    assert table.compact() == 2 and sorted(map(str, table.read().collect())) == before
    one = table.read(day(2024, 5, 2))
    assert one.count() == 2 and all("/event_date=2024-05-02/" in f for f in one.inputFiles())
    add(2, "2024-05-02 11:00:00")
    assert table.read().count() == 4 and table.read(day(2024, 5, 2)).count() == 3
    os.makedirs(tmp_path / "h" / "live" / "query=q" / "batch_id=9")  # not committed
    for n in (3, 4):
        assert table.compact() == 1
        add(n, "2024-05-02 12:00:00", "2024-05-03 12:00:00")
    assert table.compact() == 1
    assert {d: len(r) for d, r in table._state()["days"].items()} == {"2024-05-01": 1, "2024-05-02": 2, "2024-05-03": 2}
    whole = sorted(map(str, table.read().collect()))
    assert len(whole) == 8 and table.read(day(2024, 5, 3)).count() == 2 and table.read(day(2024, 6, 1)) is None
    table.clean()
    assert sorted(map(str, table.read().collect())) == whole
    assert [b.batch for b in table.live.batches()] == [4]  # the last may be replayed


def test_manifests_count_once_committed(spark, tmp_path):
    manifest = Manifest(spark, str(tmp_path / "m"), keep=2)
    assert manifest.newest() is None
    for n in range(4):
        assert manifest.write({"n": n}) == n
    os.makedirs(tmp_path / "m" / "manifest" / "version=9")
    assert manifest.versions() == [1, 2, 3] and manifest.newest() == {"n": 3}
    assert origin(spark.range(1), 5) == Origin("direct", 5)


def test_an_upsert_shows_in_the_next_batch(spark, airports, tmp_path):
    base = str(tmp_path)
    root = f"{base}/airports"
    with pytest.raises(FileNotFoundError):
        pipeline.NewestReference(spark, root)()
    write_airports(SnapshotTable(spark, root), airports.withColumn("load_order", F.lit(1)))
    for n, name in enumerate(("Alpha", "Aaa")):
        drop(f"{base}/in", f"{n}.json", message("a", f"10:00:0{n}", origin_country="X"))
        live(spark, root, base)
        found = {r.reference_version: r.origin_airport_name for r in history(spark, base).collect()}
        assert found == dict(enumerate(["Alpha", "Aaa"][:n + 1])) and name in found.values()
        write_airports(SnapshotTable(spark, root), spark.createDataFrame([("KAA", "Aaa", "T1", "X", 2)], "code string, name string, timezone string, country string, load_order int"))


def test_the_watermark_drops_and_reports_late_rows(spark, tmp_path):
    base = str(tmp_path)
    table = BatchTable(spark, f"{base}/counts")
    seen = []
    for n, rows in enumerate(([("a", "10:00:10"), ("b", "10:09:00")], [("c", "10:00:20"), ("d", "10:08:00"), ("e", "10:10:00")])):
        states_at(spark, *[(k, t, 1.0) for k, t in rows]).withColumns({"on_ground": F.lit(True), "hub": F.lit("H")}).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema("icao24 string, velocity double, event_ts timestamp, on_ground boolean, hub string").parquet(f"{base}/in")
        query = pipeline.run(pipeline.minute_density(stream, "hub"), pipeline.counts_sink(table), f"{base}/c", "update", availableNow=True)
        query.awaitTermination()
        seen.append(pipeline.dropped_partials(query))
    counted = pipeline.newest_counts(table.read())
    arrived = pipeline.minute_density(spark.read.parquet(f"{base}/in"), "hub")
    late = pipeline.late_rows(arrived, counted)
    assert [(r.timestamp.minute, r.region, r.late) for r in late.collect()] == [(0, "H", 1)]
    assert seen == [0, 1]
    rows = pipeline.with_late(counted, late).collect()
    assert sum(r["count"] for r in rows) == 4 and [r.late for r in rows if r.timestamp is None] == [1]


def test_batches_and_one_batch_agree(spark, airports, tmp_path):
    lines = [message(f"{i % 5}", f"10:00:{i:02d}", velocity=float(i)) for i in range(50)]
    many, single = str(tmp_path / "many"), str(tmp_path / "single")
    for i in range(0, 50, 10):
        drop(f"{many}/in", f"{i}.json", *lines[i:i + 10])
    drop(f"{single}/in", "all.json", *lines)
    a, b = (live(spark, airports, base) for base in (many, single))
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert {r.velocity for r in a.collect()} == {45.0, 46.0, 47.0, 48.0, 49.0}
    found = [counts(spark, base) for base in (many, single)]
    assert found[0].exceptAll(found[1]).count() == 0 == found[1].exceptAll(found[0]).count()


def test_snapshots_keep_committed_versions_only(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), keep=2)
    assert table.read() is None and table.versions() == []
    for version in range(5):
        table.write(spark.range(version + 1), version)
    assert table.versions() == [2, 3, 4] and table.read().count() == 5
    assert table.read(before=4).count() == 4
    os.makedirs(tmp_path / "t" / "version=9")
    assert table.versions()[-1] == 4


def test_scores_in_the_stream(spark, airports, tmp_path):
    rows = [("AA", h, d, 5, int(h > 12), 1.0) for h in range(24) for d in (1, 4)]
    train = spark.createDataFrame(rows, "carrier string, hour_of_day int, day_of_week int, month int, is_delayed int, class_weight double")
    path = str(tmp_path / "model")
    model.fit(train, trees=3, depth=3).write().overwrite().save(path)
    base = str(tmp_path / "s")
    drop(f"{base}/in", "1.json", message("a", "20:00:00", callsign="AAL1"), message("b", "03:00:00", callsign="AAL2"), message("c", "03:00:00", callsign="QQQ2"))
    live(spark, airports, base, model_path=path)
    scored = {r.icao24: r for r in BatchTable(spark, f"{base}/out/scored").read().collect()}
    assert set(scored) == {"a", "b"}
    assert scored["a"].delay_probability > 0.5 > scored["b"].delay_probability
    assert (scored["a"].hour_of_day, scored["a"].risk_label) == (20, "high")


def test_kafka_needs_its_package(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_stream(spark, "nowhere:9092", "flights-raw", per_trigger=10)


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder and new_folder(spark, "x").startswith(f"{folder}/delayengine/x-")
    assert get_session("tests").sparkContext is spark.sparkContext


def test_a_batch_is_not_cached(spark, airports, tmp_path):
    """A cached batch is one block for each task, many times the size of its source."""
    base, plans = str(tmp_path), []

    class Watched(BatchTable):
        def write(self, rows, by):
            plans.append(rows._jdf.queryExecution().executedPlan().toString())
            super().write(rows, by)

    rejects = Watched(spark, f"{base}/rejects")
    sink = pipeline.live_sink(country_reference(airports), StateTable(spark, f"{base}/state"), History(spark, f"{base}/history"), rejects)
    sink(spark.createDataFrame([(message("a", "10:00:00"),), ("{}",)], "value string"), 0)
    assert len(plans) == 1 and "InMemoryTableScan" not in plans[0]
    assert rejects.read().count() == 1 and StateTable(spark, f"{base}/state").read().count() == 1
