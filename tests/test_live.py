"""Normalisation, summaries, keyed merges and airports on hand-made records."""

import json

import pytest
from pyspark.sql import functions as F

from delayengine.functions.clock import iso_utc
from delayengine.operators import enrich, latest, normalize, summary, views
from delayengine.plans.dashboard import normalized_live, payload
from delayengine.sinks.tables import write_airports
from delayengine.sources import airports as airport_source
from delayengine.sources.stored import airport_table, live_records
from delayengine.streaming import messages
from delayengine.streaming.folders import Origin
from delayengine.streaming.snapshots import SnapshotTable
from delayengine.streaming.state import StateTable

NOW = "2024-05-01 10:11:12"
NORMALIZED = (
    "flight_id icao24 callsign carrier origin dest airport nearest_airport lat lon latitude longitude "
    "altitude velocity heading on_ground crs_dep_time distance month predicted_delay_minutes risk_label "
    "delay_risk timestamp source"
).split()


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def one(spark, ddl, *values):
    return spark.createDataFrame([values], ddl)


def test_defaults_of_an_almost_empty_record(spark):
    row = normalize.normalized(one(spark, "icao24 string", "abc"), now()).first()
    assert row.__fields__ == NORMALIZED
    assert row.asDict() == {
        "flight_id": "abc", "icao24": "abc", "callsign": "UNKNOWN", "carrier": "UNK",
        "origin": "UNK", "dest": "UNK", "airport": "UNK", "nearest_airport": "UNK",
        "lat": None, "lon": None, "latitude": None, "longitude": None,
        "altitude": 0, "velocity": 0.0, "heading": 0.0, "on_ground": False,
        "crs_dep_time": 1011, "distance": 500.0, "month": 5,
        "predicted_delay_minutes": 0.0, "risk_label": "low", "delay_risk": 0.0,
        "timestamp": "2024-05-01T10:11:12+00:00", "source": "api",
    }


def test_aliases_and_conversions(spark):
    record = one(
        spark,
        "icao24 string, call_sign string, latitude string, lon double, estDepartureAirport string, destination string, "
        "baro_altitude double, speed double, true_track double, on_ground boolean, time_position bigint, "
        "risk_score double, risk string, distance double, month int, nearest_airport string",
        "abc", " DAL5 ", "33.5", -84.0, "ATL", "JFK", 1234.9, 431.27, 90.0, True, 1714558272, 0.5, "HIGH", 0.0, 0, "",
    )
    row = normalize.normalized(record, now()).first()
    assert (row.callsign, row.carrier, row.origin, row.dest, row.nearest_airport) == ("DAL5", "DAL", "ATL", "JFK", "ATL")
    assert (row.lat, row.lon, row.altitude, row.velocity, row.heading) == (33.5, -84.0, 1234, 431.3, 90.0)
    assert (row.predicted_delay_minutes, row.delay_risk, row.risk_label) == (30.0, 0.5, "high")
    assert (row.distance, row.month, row.timestamp) == (500.0, 5, "2024-05-01T10:11:12+00:00")
    assert (row.on_ground, row.flight_id) == (True, "abc")


def test_given_delay_sets_score_and_label(spark):
    row = normalize.normalized(one(spark, "delay_minutes double, delay_risk double", 34.55, 0.9), now()).first()
    assert (row.predicted_delay_minutes, row.delay_risk, row.risk_label) == (round(34.55, 1), 0.58, "high")


def test_positionless_records_go(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (1.0, None)], "lat double, lon double")
    assert normalized_live(frame, now()).count() == 1


def test_service_layout_lets_zero_fall_through(spark):
    record = one(
        spark,
        "icao24 string, callsign string, latitude double, longitude double, heading double, true_track double, "
        "altitude double, baro_altitude double, geo_altitude double, velocity double, distance double, origin string",
        "abc", "UAL12", 1.0, 2.0, 0.0, 77.0, 0.0, None, 900.0, 0.0, 0.0, "",
    )
    row = normalize.api_records(record, now()).first()
    assert (row.heading, row.altitude, row.velocity, row.distance) == (77.0, 900.0, 0.0, 0.0)
    assert (row.carrier, row.origin, row.nearest_airport, row.crs_dep_time, row.month) == ("UAL", "UNK", "UNK", 1200, 5)
    assert row.timestamp == "2024-05-01T10:11:12+00:00" and len(row) == 17
    assert normalize.api_records(record.withColumn("latitude", F.lit(None).cast("double")), now()).count() == 0


FLIGHT_DDL = (
    "icao24 string, callsign string, origin string, lat double, lon double, altitude double, on_ground boolean, "
    "predicted_delay_minutes double, velocity double"
)


def current(spark, *rows):
    return normalized_live(spark.createDataFrame(list(rows), FLIGHT_DDL), now())


@pytest.fixture
def flights(spark):
    return current(
        spark,
        ("a", "AAL1", "ATL", 1.0, 1.0, 1000.0, False, 40.0, 1.0),
        ("b", "DAL1", "ATL", 2.0, 2.0, 2001.0, False, 5.0, 2.0),
        ("c", "UAL1", "ATL", 3.0, 3.0, 9000.0, True, 0.0, 3.0),
        ("e", "UAL2", "XXX", 5.0, 5.0, 0.0, False, 4.9, 4.0),
        ("d", "UAL3", "XXX", 4.0, 4.5, 0.0, False, 30.0, 5.0),
    )


def test_density(flights):
    rows = {r.region: r for r in summary.density(flights, now()).collect()}
    assert tuple(rows["ATL"]) == ("ATL", 33.6407, -84.4277, 3, 3, "2024-05-01T10:11:00+00:00")
    assert tuple(rows["XXX"])[1:5] == (4.0, 4.5, 2, 1)  # placed where aircraft d is


def test_congestion_models(spark, flights):
    risk = [tuple(r) for r in summary.congestion(flights).collect()]
    atl = round(3 * 1.2 + (0.67 + 0.08 + 0.02) / 3 * 55 + 1 * 2.5, 1)
    xxx = round(2 * 1.2 + (0.08 + 0.5) / 2 * 55, 1)
    assert risk == [("ATL", atl, 3, 1), ("XXX", xxx, 2, 0)]
    load = [tuple(r) for r in summary.congestion(flights, model="load").collect()]
    assert load == [("ATL", 8.2, 3, 1), ("XXX", 2.8, 2, 0)]
    crowd = current(spark, *[(str(i), "A", "ATL", 1.0, 1.0, 0.0, True, 90.0, 0.0) for i in range(60)])
    assert summary.congestion(crowd).first().score == 100.0


def test_kpis(spark, flights):
    row = summary.kpis(flights).first()
    assert tuple(row) == (5, 3, 1, 0, 750, "online")
    empty = summary.kpis(flights.limit(0), online=False).first()
    assert tuple(empty) == (0, 0, 0, 0, 0, "mock/offline")


def test_kpis_agree_with_the_panels(flights):
    panels = payload(flights, now())
    kpi = panels["kpi"].first()
    assert kpi.total_flights == panels["flights"].count()
    assert kpi.delayed_flights == panels["delays"].count()
    assert sum(r.flights for r in panels["delay_distribution"].collect()) == kpi.total_flights
    assert {r.risk for r in panels["map"].collect()} <= {"LOW", "MEDIUM", "HIGH"}


def test_delays_are_sorted_and_titled(flights):
    rows = views.delays(flights).collect()
    assert [(r.icao24, r.duration_minutes, r.risk_level) for r in rows] == [
        ("a", 40.0, "High"), ("d", 30.0, "Medium"), ("b", 5.0, "Medium"),
    ]


def test_risk_table_filters(flights):
    late = views.delays(flights)
    assert [r.route for r in views.risk_table(late, ["ATL"], "medium").collect()] == ["ATL → UNK"]
    assert views.risk_table(late).count() == 3
    assert views.map_points(flights, ["ATL"], "high").count() == 1
    sizes = {r.text: r.size for r in views.map_points(flights).collect()}
    assert sizes["UAL1"] == 15.0 and sizes["AAL1"] == 8 + 8 * 0.67


def test_congestion_bars(flights):
    bars = views.congestion_bars(summary.congestion(flights)).collect()
    assert [b.hub for b in bars] == ["XXX", "ATL"] and {b.band for b in bars} == {"green"}
    assert views.congestion_bars(summary.congestion(flights), ["ATL"]).count() == 1


def test_trend_window_and_bad_timestamps(spark):
    rows = [
        ("ATL", 5, 1, "2024-05-01T10:00:00+00:00"), ("JFK", 7, 0, "2024-05-01T10:00:00+00:00"),
        ("ATL", 3, 2, "2024-05-01T09:45:00+00:00"), ("ATL", 9, 9, "2024-05-01T09:44:00+00:00"),
        ("ATL", 9, 9, "soon"), ("ATL", 9, 9, None),
    ]
    series = spark.createDataFrame(rows, "region string, count bigint, ground_delay_count bigint, timestamp string")
    got = sorted((str(r.timestamp), r.active_aircraft, r.ground_delays) for r in summary.activity_trend(series, 15).collect())
    assert got == [("2024-05-01 09:45:00", 3, 2), ("2024-05-01 10:00:00", 12, 1)]
    only = summary.activity_trend(series, 15, ["JFK"]).collect()
    assert [r.active_aircraft for r in only] == [7]


def test_histogram_edges(spark):
    def bins(*minutes):
        frame = spark.createDataFrame([(m,) for m in minutes], "predicted_delay_minutes double")
        return {r.bin: (r.bin_start, r.flights) for r in summary.delay_histogram(frame).collect()}

    assert bins(0.0, 18.0, 17.9, 1.0, None) == {1: (0.0, 2), 2: (1.0, 1), 18: (17.0, 2)}
    assert bins(3.0, 3.0) == {1: (3.0, 2)}


STATE = "icao24 string, event_ts timestamp, n int"


def test_latest_and_expiry(spark):
    rows = spark.sql(
        "select * from values ('a', timestamp'2024-01-01 00:00:00', 1), ('a', timestamp'2024-01-01 00:00:50', 2),"
        " ('b', timestamp'2023-12-31 23:59:50', 3), ('b', timestamp'2023-12-31 23:59:49', 4),"
        " ('', timestamp'2024-01-01 00:00:50', 5), (null, timestamp'2024-01-01 00:00:50', 6) t(icao24, event_ts, n)"
    )
    newest = latest.latest(rows, "icao24", ["event_ts", "n"])
    assert {r.icao24: r.n for r in newest.collect()} == {"a": 2, "b": 3}
    assert newest.columns == rows.columns
    kept = latest.current(rows, "icao24", ["event_ts", "n"], 60)
    assert {r.icao24 for r in kept.collect()} == {"a"}
    assert {r.icao24 for r in latest.unexpired(newest, 61).collect()} == {"a", "b"}


def test_hot_key_is_reduced_before_the_shuffle(spark):
    rows = spark.range(0, 50_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("icao24"),
        F.timestamp_seconds("id").alias("event_ts"), F.col("id").cast("int").alias("n"),
    )
    newest = latest.latest(rows, "icao24", ["event_ts"])
    assert "partial_max_by" in newest._jdf.queryExecution().executedPlan().toString()
    assert newest.filter("icao24 = 'hot'").first().n == 49_998
    assert newest.count() == 33_333 + 1


def test_upsert_keeps_what_is_not_carried(spark):
    stored = spark.createDataFrame([("A", "old", 1.0, 7), ("B", "stays", 2.0, 8)], "code string, name string, latitude double, elevation int")
    incoming = spark.createDataFrame(
        [("A", "first", 3.0, 1), ("A", "last", None, 2), ("C", "new", 4.0, 3)], "code string, name string, latitude double, load_order int"
    )
    got = sorted(map(tuple, latest.upsert(stored, incoming, "code", ["load_order"]).collect()))
    assert got == [("A", "last", None, 7), ("B", "stays", 2.0, 8), ("C", "new", 4.0, None)]


AIRPORT_CSV = """id,type,name,latitude_deg,longitude_deg,iata_code,iso_country,tz_database_timezone
1,large_airport,"First, Big",1.5,2.5,AAA,US,TZ/A
2,small_airport,Small,1,2,BBB,US,TZ/B
3,medium_airport,No code,1,2,,US,TZ/C
4,medium_airport,Bad place,north,2,CCC,US,TZ/D
5,medium_airport,No place,,2,DDD,US,TZ/E
6,medium_airport,Other,3,4,EEE,CA,
7,large_airport,Second,5,6,AAA,US,TZ/Z
"""


def test_airport_load_and_reference(spark, tmp_path):
    from delayengine.jobs import airports as job

    (tmp_path / "airports.csv").write_text(AIRPORT_CSV)
    (tmp_path / "countries.csv").write_text("code,name\nUS,United States\n")
    root = str(tmp_path / "table")
    refused = job.run(spark, str(tmp_path / "airports.csv"), root, str(tmp_path / "countries.csv"))
    assert refused == 2
    rows = {r.code: tuple(r) for r in airport_table(spark, root).collect()}
    assert rows == {
        "AAA": ("AAA", "Second", 5.0, 6.0, "TZ/Z", "United States"),
        "EEE": ("EEE", "Other", 3.0, 4.0, None, "CA"),
    }
    (tmp_path / "more.csv").write_text(AIRPORT_CSV.splitlines()[0] + "\n9,large_airport,Third,7,8,AAA,US,TZ/T\n")
    text = airport_source.read_airport_text(spark, str(tmp_path / "more.csv"))
    write_airports(SnapshotTable(spark, root), airport_source.to_airports(text))
    assert {r.code: r.name for r in airport_table(spark, root).collect()} == {"AAA": "Third", "EEE": "Other"}


def test_one_airport_per_country(spark):
    airports = spark.createDataFrame(
        [("B", "Alpha", "T2", "X"), ("A", "Zulu", "T9", "X"), ("C", None, "T1", "Y")],
        "code string, name string, timezone string, country string",
    )
    mixed = {r.country: tuple(r)[1:] for r in enrich.country_reference(airports).collect()}
    assert mixed == {"X": ("A", "Alpha", "T2"), "Y": ("C", None, "T1")}
    whole = {r.country: tuple(r)[1:] for r in enrich.country_reference(airports, coherent=True).collect()}
    assert whole["X"] == ("A", "Zulu", "T9")
    states = spark.createDataFrame([("a", "X"), ("b", "Z"), ("c", None)], "icao24 string, origin_country string")
    rows = {r.icao24: r.origin_airport_icao_code for r in enrich.with_airport(states, enrich.country_reference(airports)).collect()}
    assert rows == {"a": "A", "b": None, "c": None}


def test_hot_country_is_split_when_the_reference_is_too_large_to_broadcast(spark):
    states = spark.range(0, 300_000, numPartitions=8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("icao24"),
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), (F.col("id") % 500).cast("string"))).alias("origin_country"),
    )
    reference = spark.range(501).select(
        F.when(F.col("id") == 500, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id").cast("string"))).alias("country"),
        F.lit("K").alias("code"), F.lit("N").alias("name"), F.lit("T").alias("timezone"),
    )
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        joined = enrich.with_airport(states, reference)
        assert joined.filter("origin_airport_icao_code is not null").count() == 300_000
        done = joined.select(F.count("icao24"), F.count("origin_airport_icao_code"))
        assert tuple(done.collect()[0]) == (300_000, 300_000)
        assert "skew=true" in done._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in conf:
            spark.conf.unset(key)


def test_messages_survive_bad_json(spark):
    raw = spark.createDataFrame(
        [('{"icao24":"a","longitude":1.5,"extra":1,"polled_at":"2024-05-01T10:11:12.5+00:00"}',),
         ('{"icao24":"b","longitude":"oops"}',), ('{"icao24":"f","polled_at":"2999-01-01T00:00:00+00:00"}',), ("{broken",), (None,), ('{"callsign":"X"}',)],
        "value string",
    ).withColumn("arrived_at", F.lit("2024-05-02 00:00:00").cast("timestamp"))
    parsed = messages.parse_states(raw)
    good = {r.icao24: r for r in messages.flat_states(parsed.filter(~messages.without_key())).collect()}
    assert set(good) == {"a", "b", "f"}
    assert str(good["f"].event_ts) == "2024-05-02 00:00:00"
    assert str(good["a"].event_ts) == "2024-05-01 10:11:12.500000" and good["a"].longitude == 1.5
    assert good["b"].longitude is None and str(good["b"].event_ts) == "2024-05-02 00:00:00"
    assert parsed.filter(messages.without_key()).count() == 3


def test_vectors(spark):
    document = {"time": 1, "states": [
        ["a", "AAL1 ", "X", 10, 11, -1.5, 2.5, None, True, 3.0, 4.0, None, [1, 2], 5.0, "7700", False, 0],
        ["b", "DAL"],
    ]}
    raw = spark.createDataFrame([(json.dumps(document),), ('{"time":2,"states":[]}',), ('{"time":3,"states":null}',), ("x",)], "value string")
    rows = {r.icao24: r for r in messages.parse_vectors(raw, now()).collect()}
    assert set(rows) == {"a", "b"}
    a = rows["a"]
    assert (a.time_position, a.longitude, a.on_ground, a.baro_altitude, a.squawk, a.spi, a.position_source) == (10, -1.5, True, None, "7700", False, 0)
    assert a.sensors == "[1,2]" and a.polled_at == "2024-05-01T10:11:12+00:00"
    assert rows["b"].callsign == "DAL" and rows["b"].squawk is None


def test_published_messages_parse_back(spark, tmp_path):
    from delayengine.jobs import publish

    (tmp_path / "docs.json").write_text(json.dumps({"time": 1, "states": [["a", "AAL1"], ["b", None]]}) + "\n")
    publish.run(spark, str(tmp_path / "docs.json"), folder=str(tmp_path / "topic"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "topic")).collect()]
    assert {l["icao24"]: l["callsign"] for l in lines} == {"a": "AAL1", "b": None}
    assert len(lines[0]) == 18


def stored_state(spark, root, rows):
    states = spark.createDataFrame(rows, "icao24 string, latitude double, longitude double, t string")
    states = states.withColumn("event_ts", F.col("t").cast("timestamp")).drop("t")
    StateTable(spark, root).apply(states, Origin("q", 0))


def test_live_records_come_ordered_and_limited(spark, tmp_path):
    root = str(tmp_path / "state")
    stored_state(spark, root, [(f"{i:03d}", 1.0, 1.0, "2024-05-01 10:11:00") for i in range(20)] + [("zzz", None, 1.0, "2024-05-01 10:11:00")])
    got = live_records(spark, root, now(), 5).collect()
    assert [r.icao24 for r in got] == ["000", "001", "002", "003", "004"]
    with pytest.raises(FileNotFoundError):
        live_records(spark, str(tmp_path / "none"), now())


def test_live_records_expire_on_reading(spark, tmp_path):
    root = str(tmp_path / "state")
    stored_state(spark, root, [("old", 1.0, 1.0, "2024-05-01 10:10:12"), ("new", 1.0, 1.0, "2024-05-01 10:10:13")])
    assert [r.icao24 for r in live_records(spark, root, now()).collect()] == ["new"]
    assert live_records(spark, root, now(), ttl_seconds=120).count() == 2


def test_iso_of_as_of(spark):
    assert spark.range(1).select(iso_utc(now())).first()[0] == "2024-05-01T10:11:12+00:00"
