"""Scalar expressions against plain Python."""

from datetime import datetime, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from delayengine.functions import carriers, clock, risk, rounding, text
from delayengine.schema import ICAO_TO_IATA


def evaluate(spark, values, kind, *columns):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = frame.select("i", *columns).orderBy("i").collect()
    return [tuple(r)[1:] if len(columns) > 1 else r[1] for r in rows]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(-1e7, 1e7) | st.integers(-10**6, 10**6).map(lambda k: k / 1000), min_size=1, max_size=300))
def test_rounding_matches_python(spark, values):
    for digits in (1, 2, 4):
        assert evaluate(spark, values, "double", rounding.nearest(F.col("v"), digits)) == [
            round(v, digits) for v in values
        ]


def test_rounding_at_ties_and_edges(spark):
    values = [0.25, 0.35, 0.575, 2.675, 34.05, 0.125, 1e15, None, -0.05, 2.5]
    assert evaluate(spark, values, "double", rounding.nearest(F.col("v"), 1)) == [
        None if v is None else round(v, 1) for v in values
    ]


def test_scheduled_hour(spark):
    got = evaluate(spark, [1430, 30, 2359, 2400, 0, None], "int", clock.scheduled_hour(F.col("v")))
    assert got == [14, 0, 23, 0, 0, None]


def test_flight_date_modes(spark):
    loose, strict = clock.flight_date(F.col("v")), clock.flight_date(F.col("v"), strict=True)
    got = evaluate(spark, ["2024-01-15", "2024-1-5", "not-a-date", "", None], "string",
                   loose.cast("string"), strict.cast("string"))
    assert got == [("2024-01-15", "2024-01-15"), ("2024-01-05", None), (None, None), (None, None), (None, None)]


def test_iso_text_matches_python(spark):
    moments = [datetime(2024, 5, 1, 10, 11, 12, 123456), datetime(2024, 5, 1), datetime(1999, 12, 31, 23, 59, 59, 500000)]
    got = evaluate(spark, moments, "timestamp_ntz", clock.iso_utc(F.col("v")))
    assert got == [m.replace(tzinfo=timezone.utc).isoformat() for m in moments]


def test_utc_clock_takes_seconds_and_text(spark):
    moment = datetime(2024, 5, 1, 10, 11, 12)
    seconds = int(moment.replace(tzinfo=timezone.utc).timestamp())
    assert evaluate(spark, [seconds], "bigint", clock.utc_clock(F.col("v"), "bigint")) == [moment]
    texts = ["2024-05-01T10:11:12+00:00", "2024-05-01T10:11:12+05:00", "soon"]
    assert evaluate(spark, texts, "string", clock.utc_clock(F.col("v"), "string")) == [moment, moment, None]


def test_carriers(spark):
    calls = ["AAL123 ", "aal9", " DAL1", "ZZZ7", "", None]
    assert evaluate(spark, calls, "string", carriers.carrier_from_callsign(F.col("v"))) == [
        "AA", "AA", "DL", None, None, None,
    ]
    codes = ["AAL", "dal ", "ZZZ", "Q", "", None]
    assert evaluate(spark, codes, "string", carriers.carrier_or_prefix(F.col("v"))) == [
        "AA", "DL", "ZZ", "UNK", "UN", "UN",
    ]
    assert len(ICAO_TO_IATA) == 30


def python_label(minutes):
    return "high" if minutes > 30 else "medium" if minutes >= 5 else "low"


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(-100, 1000), min_size=1, max_size=200))
def test_risk_from_minutes(spark, values):
    got = evaluate(spark, values, "double", risk.label_from_minutes(F.col("v")), risk.score_from_minutes(F.col("v")))
    assert got == [(python_label(v), round(max(0.02, min(v / 60.0, 1.0)), 2)) for v in values]


def test_risk_from_probability(spark):
    got = evaluate(spark, [0.0, 0.29, 0.3, 0.59, 0.6, 1.0, None], "double",
                   risk.label_from_probability(F.col("v")), risk.minutes_from_probability(F.col("v")))
    assert got == [("low", 0.0), ("low", 17.4), ("medium", 18.0), ("medium", 35.4), ("high", 36.0), ("high", 60.0), (None, None)]


def test_null_minutes_have_no_score(spark):
    assert evaluate(spark, [None], "double", risk.score_from_minutes(F.col("v"))) == [None]


def test_bands(spark):
    got = evaluate(spark, [0.0, 49.9, 50.0, 74.9, 75.0], "double", risk.congestion_band(F.col("v")))
    assert got == ["green", "green", "orange", "orange", "red"]


def test_pick_skips_absent_null_and_empty(spark):
    frame = spark.createDataFrame([("", "5", 0.0), ("7", None, 2.0), (None, None, None)], "a string, b string, c double")
    got = frame.select(
        text.pick(frame, ["missing", "a", "b"], "double", F.lit(9)).alias("x"),
        text.pick(frame, ["c"], "double", F.lit(1), zero_is_empty=True).alias("y"),
        text.pick(frame, ["missing"], "string").alias("z"),
    ).collect()
    assert [tuple(r) for r in got] == [(5.0, 1.0, None), (7.0, 2.0, None), (9.0, 1.0, None)]


def test_unknown_carrier_mode_is_refused(spark):
    from delayengine.operators.features import state_carrier

    with pytest.raises(ValueError):
        state_carrier(spark.createDataFrame([("A",)], "callsign string"), "guess")
