"""The registered queries: every operator over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delayengine.functions.clock import iso_utc, scheduled_hour
from delayengine.functions.risk import (
    congestion_band,
    label_from_minutes,
    label_from_probability,
    minutes_from_probability,
    score_from_minutes,
)
from delayengine.jobs import ingest
from delayengine.operators import (
    clean,
    enrich,
    evaluate,
    features,
    latest,
    model,
    normalize,
    quality,
    stats,
    summary,
    views,
)
from delayengine.plans import tables
from delayengine.plans.dashboard import normalized_live
from delayengine.schema import CSV_NAMES, REQUIRED_FLIGHT_COLUMNS
from delayengine.session import new_folder, stage
from delayengine.sinks.partials import refresh_partials
from delayengine.sinks.tables import write_airports, write_months
from delayengine.sources import airports as airport_source
from delayengine.sources import flights as flight_source
from delayengine.streaming import messages, pipeline
from delayengine.streaming.folders import BatchTable
from delayengine.streaming.history import History
from delayengine.streaming.snapshots import SnapshotTable
from delayengine.streaming.state import StateTable

# The test events span a month, so the live state is kept for a day here.
DAY = 86_400
MONTH_MINUTES = 43_200
YEARS = range(1995, 2002)


# --- Batch: ingest -------------------------------------------------------------------


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Source-named CSV text -> typed, month-partitioned Parquet -> scan."""
    raw, months = new_folder(spark, "csv"), new_folder(spark, "months")
    tables.flight_texts(spark, sf).write.option("header", True).csv(raw)
    typed = flight_source.to_flights(flight_source.read_csv_text(spark, raw))
    write_months(clean.with_month_keys(typed), months)
    return flight_source.scan_months(spark, months)


def _mixed_csv(spark: SparkSession, sf: str) -> str:
    """Three folders of CSV files: all columns, the same from last to first, and without the optional ones."""
    raw, texts = new_folder(spark, "csv"), tables.flight_texts(spark, sf, tables.ROW_ID)
    names = [c for c in texts.columns if c not in tables.ROW_ID]
    required = [CSV_NAMES[c] for c in REQUIRED_FLIGHT_COLUMNS]
    for kind, columns in enumerate((names, names[::-1], required)):
        part = texts.where(F.col("l_orderkey") % 3 == kind).select(*columns)
        part.write.option("header", True).csv(f"{raw}/kind{kind}")
    return raw


def csv_mixed_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Files of differing headers -> typed, month-partitioned Parquet, rejects beside -> scan."""
    months = new_folder(spark, "months")
    ingest.run(spark, _mixed_csv(spark, sf), months, keep_rejects=True)
    return flight_source.scan_months(spark, months)


def ingest_report(spark: SparkSession, sf: str) -> DataFrame:
    """What an ingest counted while it wrote, and the rejects it kept."""
    months = new_folder(spark, "months")
    found = ingest.run(spark, _mixed_csv(spark, sf), months, keep_rejects=True)
    kept = flight_source.scan_rejects(spark, months).agg(F.count(F.lit(1)).alias("rejects_kept"))
    return kept.select(*[F.lit(n).cast("long").alias(name) for name, n in found.items()], "rejects_kept")


def csv_cast_failures(spark: SparkSession, sf: str) -> DataFrame:
    return flight_source.cast_failures(tables.flight_texts(spark, sf))


def _month_table(spark: SparkSession, sf: str) -> str:
    path = new_folder(spark, "months")
    write_months(clean.with_month_keys(tables.flights(spark, sf)), path)
    return path


def year_dirs_scan(spark: SparkSession, sf: str) -> DataFrame:
    scan = flight_source.scan_years(spark, _month_table(spark, sf), YEARS)
    return scan.groupBy("year", "month").agg(F.count(F.lit(1)).alias("flights"))


def some_year_dirs(spark: SparkSession, sf: str) -> DataFrame:
    """Only the directories of the named years are listed."""
    scan = flight_source.scan_years(spark, _month_table(spark, sf), (1996, 1999))
    return scan.groupBy("year", "month").agg(F.count(F.lit(1)).alias("flights"))


def year_month_filter(spark: SparkSession, sf: str) -> DataFrame:
    return flight_source.scan_months(spark, _month_table(spark, sf), year=1997, month=6)


def _flights(spark: SparkSession, sf: str) -> DataFrame:
    return tables.flights(spark, sf)


def flights_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    return clean.with_month_keys(_flights(spark, sf))


def _dirty_flights(spark: SparkSession, sf: str) -> DataFrame:
    return flight_source.to_flights(tables.flight_texts(spark, sf))


def rejected_dates(spark: SparkSession, sf: str) -> DataFrame:
    return clean.undated(_dirty_flights(spark, sf))


def clean_flights(spark: SparkSession, sf: str) -> DataFrame:
    return clean.flown(_flights(spark, sf))


# --- Batch: statistics ---------------------------------------------------------------


def hour_of_day(spark: SparkSession, sf: str) -> DataFrame:
    return _flights(spark, sf).select(
        *tables.ROW_ID, "CRS_DEP_TIME", scheduled_hour(F.col("CRS_DEP_TIME")).alias("hour_of_day")
    )


def _flown(spark: SparkSession, sf: str) -> DataFrame:
    return stats.with_hour(clean.flown(_flights(spark, sf)))


def by_route(spark: SparkSession, sf: str) -> DataFrame:
    return stats.by_route(_flown(spark, sf))


def by_carrier(spark: SparkSession, sf: str) -> DataFrame:
    return stats.by_carrier(_flown(spark, sf))


def by_hour(spark: SparkSession, sf: str) -> DataFrame:
    return stats.by_hour(_flown(spark, sf))


def stats_grouping_sets(spark: SparkSession, sf: str) -> DataFrame:
    return stats.all_stats(_flown(spark, sf))


def route_features(spark: SparkSession, sf: str) -> DataFrame:
    history = stage(stats.by_route(_flown(spark, sf)), "by-route")
    return stats.with_route_history(_flights(spark, sf), history).select(
        *tables.ROW_ID, "ORIGIN", "DEST", *stats.METRICS
    )


# --- Batch: quality ------------------------------------------------------------------


def _today() -> Column:
    return F.lit("2001-12-31").cast("date")


def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.flight_report(clean.with_month_keys(_flights(spark, sf)), _today())


def quality_summary(spark: SparkSession, sf: str) -> DataFrame:
    return quality.roll_up(quality_report(spark, sf))


def quality_after_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    """The report from figures kept by month, after one month was written anew with worse rows."""
    path = _month_table(spark, sf)
    store = SnapshotTable(spark, new_folder(spark, "partials"))
    refresh_partials(spark, path, store, _today())
    month = flight_source.scan_months(spark, path, 1997, 6)
    worse = month.withColumns({"DISTANCE": -F.col("DISTANCE"), "DEP_DELAY": F.col("DEP_DELAY") + F.lit(700).cast("float")})
    write_months(stage(worse, "worse"), path)
    again = refresh_partials(spark, path, store, _today())
    if again != [(1997, 6)]:
        raise AssertionError(f"months read again: {again}")
    return quality.report_of_partials(store.read(), flight_source.scan_months(spark, path).columns, _today())


def enriched_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.enriched_report(state_enriched(spark, sf))


def live_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.live_report(messages.to_messages(latest_state(spark, sf)))


def enriched_quality_raw(spark: SparkSession, sf: str) -> DataFrame:
    """The same over all messages, unusable ones too: this one fails."""
    parsed = messages.parse_states(tables.raw_messages(spark, sf).select("value"))
    return quality.enriched_report(enrich.with_airport(messages.flat_states(parsed), _reference(spark, sf)))


def live_quality_raw(spark: SparkSession, sf: str) -> DataFrame:
    return quality.live_report(tables.raw_messages(spark, sf).select("key", "value"))


def message_rejects(spark: SparkSession, sf: str) -> DataFrame:
    parsed = messages.parse_states(tables.raw_messages(spark, sf))
    return parsed.groupBy(messages.reject_reason(parsed).alias("reason")).agg(F.count(F.lit(1)).alias("messages"))


# --- Batch: features and model -------------------------------------------------------


def temporal_features(spark: SparkSession, sf: str) -> DataFrame:
    return features.with_calendar(_flights(spark, sf)).select(
        *tables.ROW_ID, "hour_of_day", "day_of_week", "month"
    )


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return features.labelled(_flights(spark, sf)).select(*tables.ROW_ID, "ARR_DELAY", "is_delayed")


def _feature_rows(spark: SparkSession, sf: str) -> DataFrame:
    return features.feature_rows(features.with_calendar(features.labelled(_flights(spark, sf))))


def training_rows(spark: SparkSession, sf: str) -> DataFrame:
    return features.weighted(_feature_rows(spark, sf))


def training_cells(spark: SparkSession, sf: str) -> DataFrame:
    return model.collapse(training_rows(spark, sf))


def class_balance(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.class_balance(_feature_rows(spark, sf))


def _rows(spark: SparkSession, sf: str) -> DataFrame:
    return features.usable(
        features.split_rows(features.labelled(_flights(spark, sf)), tables.ROW_ID)
    )


def holdout_tally(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.tally(_rows(spark, sf), "held_out")


def _tallied(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Training and test rows from a single scan of the flights."""
    return features.train_and_test(stage(holdout_tally(spark, sf), "tally"))


def _scores(spark: SparkSession, sf: str) -> model.ScoreTable:
    return model.tabulate(spark, model.fit(_tallied(spark, sf)[0]))


def _predictions(spark: SparkSession, sf: str) -> DataFrame:
    """The tallied test rows with the predictions of a model of the tallied training rows."""
    train, test = _tallied(spark, sf)
    return model.fit(train).transform(test)


def scored_flights(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.with_calendar(_flights(spark, sf)).withColumnRenamed("OP_CARRIER", "carrier")
    scored = model.score(_scores(spark, sf), rows)
    return scored.select(
        *tables.ROW_ID, "carrier", "hour_of_day", "day_of_week", "month",
        "delay_probability", "risk_label",
    )


def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.confusion(_predictions(spark, sf))


def model_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.metrics(_predictions(spark, sf))


def collapsed_model_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.metrics(_predictions(spark, sf))


def predictions_filled(spark: SparkSession, sf: str) -> DataFrame:
    """Live flights whose missing predictions come from the model, then normalised."""
    return normalized_live(
        tables.live(spark, sf), tables.newest(spark, sf), _scores(spark, sf)
    )


# The same steps with probabilities by a formula, which SQL can repeat.
RULE_CARRIERS = ("AA", "DL", "UA", "WN")


def _rule(carrier: Column) -> Column:
    mixed = F.ascii(carrier) + F.col("hour_of_day") * 7 + F.col("day_of_week") * 3 + F.col("month")
    return (mixed % 20) / F.lit(20.0)


def scored_by_rule(spark: SparkSession, sf: str) -> DataFrame:
    """Flights through a score table that knows some of their carriers."""
    rows = features.with_calendar(_flights(spark, sf)).withColumnRenamed("OP_CARRIER", "carrier")
    table = model.score_table(spark, RULE_CARRIERS, _rule(F.col("carrier")))
    return model.score(table, rows).select(*tables.ROW_ID, "delay_probability", "risk_label")


def _rule_predictions(spark: SparkSession, sf: str) -> DataFrame:
    rows = evaluate.tally(_rows(spark, sf)).withColumn("rawPrediction", _rule(F.col("carrier")))
    return rows.withColumn("prediction", (F.col("rawPrediction") >= 0.5).cast("double"))


def confusion_by_rule(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.confusion(_rule_predictions(spark, sf))


def metrics_by_rule(spark: SparkSession, sf: str) -> DataFrame:
    found = evaluate.metrics(_rule_predictions(spark, sf))
    return found.select("auc", "accuracy", "precision", "recall", "f1")


def predictions_filled_by_rule(spark: SparkSession, sf: str) -> DataFrame:
    """As ``predictions_filled``, from a score table that SQL repeats."""
    scores = model.score_table(spark, RULE_CARRIERS, _rule(F.col("carrier")))
    return normalized_live(tables.live(spark, sf), tables.newest(spark, sf), scores)


def score_agreement(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out rows, and how many get another probability from the score table than from the forest."""
    train, test = _tallied(spark, sf)
    forest = model.fit(train)
    direct = forest.transform(test).withColumn("direct", vector_to_array("probability")[1])
    both = model.tabulate(spark, forest).look_up(direct, "left")
    return both.agg(
        F.count(F.lit(1)).alias("compared"),
        F.count_if(~F.col("delay_probability").eqNullSafe(F.col("direct"))).alias("mismatches"),
    )


# --- Live: states --------------------------------------------------------------------


def country_reference(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.country_reference(_airports(spark, sf))


def country_reference_coherent(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.country_reference(_airports(spark, sf).drop("load_order"), coherent=True)


def _airports(spark: SparkSession, sf: str) -> DataFrame:
    return airport_source.to_airports(tables.airport_texts(spark, sf))


def airports_filtered(spark: SparkSession, sf: str) -> DataFrame:
    return _airports(spark, sf)


def airports_rejected(spark: SparkSession, sf: str) -> DataFrame:
    return airport_source.rejected_airports(tables.airport_texts(spark, sf))


def airports_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """A stored reference (one airport per nation) written over by the loaded file."""
    nation = tables.table(spark, sf, "nation")
    stored = nation.select(
        F.concat(F.lit("S"), (F.col("n_nationkey") * 3).cast("string")).alias("code"),
        F.concat(F.lit("Old "), "n_name").alias("name"),
        F.lit(0.0).alias("latitude"),
        F.lit(0.0).alias("longitude"),
        F.lit("TZ_old").alias("timezone"),
        F.col("n_name").alias("country"),
        F.col("n_nationkey").alias("elevation"),
    )
    return latest.upsert(stored, _airports(spark, sf), "code", ["load_order"])


def _reference(spark: SparkSession, sf: str) -> DataFrame:
    return stage(enrich.country_reference(_airports(spark, sf)), "countries")


def state_enriched(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.with_airport(tables.states(spark, sf), _reference(spark, sf))


def latest_state(spark: SparkSession, sf: str) -> DataFrame:
    return latest.latest(tables.states(spark, sf), "icao24", ["event_ts", "event_id"])


def live_expired(spark: SparkSession, sf: str) -> DataFrame:
    return latest.current(
        tables.states(spark, sf), "icao24", ["event_ts", "event_id"], DAY, tables.newest(spark, sf)
    )


def live_limit(spark: SparkSession, sf: str) -> DataFrame:
    records = normalize.api_records(_latest_live(spark, sf), tables.newest(spark, sf))
    return normalize.first_records(records, 60)


def carrier_strict(spark: SparkSession, sf: str) -> DataFrame:
    states = tables.states(spark, sf)
    return states.select("event_id", "callsign", features.state_carrier(states).alias("carrier"))


def carrier_fallback(spark: SparkSession, sf: str) -> DataFrame:
    states = tables.states(spark, sf)
    carrier = features.state_carrier(states, "fallback")
    return states.select("event_id", "callsign", carrier.alias("carrier"))


def state_features(spark: SparkSession, sf: str) -> DataFrame:
    states = tables.states(spark, sf)
    return features.state_features(states, tables.newest(spark, sf)).select(
        "event_id", "carrier", "hour_of_day", "day_of_week", "month"
    )


def state_features_text(spark: SparkSession, sf: str) -> DataFrame:
    """Times as text: some unreadable (then it is now), some empty (then the next one counts)."""
    states, event = tables.states(spark, sf), F.col("event_id")
    texts = states.withColumns({
        "time_position": F.when(event % 5 == 0, F.lit("soon")).when(event % 5 == 1, F.lit("")).when(event % 5 == 2, F.col("polled_at")),
        "timestamp": F.when(event % 3 == 0, F.lit("later")).when(event % 3 == 1, iso_utc(F.col("event_ts") - F.make_dt_interval(hours=F.lit(7)))),
    })
    return features.state_features(texts, tables.newest(spark, sf)).select(
        "event_id", "carrier", "hour_of_day", "day_of_week", "month"
    )


def states_json_parsed(spark: SparkSession, sf: str) -> DataFrame:
    raw = messages.to_messages(tables.states(spark, sf)).select("value")
    return messages.flat_states(messages.parse_states(raw)).withColumn(
        "event_ts", F.col("event_ts").cast("timestamp_ntz")
    )


def state_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Each event as a polled document: one full vector and one cut short after its callsign."""
    states = tables.states(spark, sf)
    texts = [
        F.concat(F.lit('"'), F.col(c), F.lit('"')) for c in ("icao24", "callsign", "origin_country")
    ]
    others = [
        F.coalesce(F.col(c).cast("string"), F.lit("null"))
        for c in (
            "time_position", "last_contact", "longitude", "latitude", "baro_altitude",
            "on_ground", "velocity", "true_track", "vertical_rate",
        )
    ]
    fields = [*texts, *others]
    vector = F.concat_ws(
        ",", *fields, F.lit("null"), F.col("geo_altitude").cast("string"), F.lit("null,false,0")
    )
    short = F.concat_ws(",", *fields[:2])
    document = F.concat(
        F.lit('{"time":'), F.col("time_position").cast("string"), F.lit(',"states":[['), vector,
        F.lit("],["), short, F.lit("]]}"),
    )
    raw = states.select(document.alias("value"), "event_ts")
    return messages.parse_vectors(raw, F.col("event_ts"))


def state_topic_json(spark: SparkSession, sf: str) -> DataFrame:
    return messages.to_messages(
        tables.states(spark, sf).select(
            "icao24", "callsign", "origin_country", "longitude", "latitude", "on_ground",
            "polled_at", "time_position",
        )
    )


# --- Live: normalised records and views ----------------------------------------------


def _latest_live(spark: SparkSession, sf: str) -> DataFrame:
    return tables.with_trip(latest_state(spark, sf))


def _normalized(spark: SparkSession, sf: str) -> DataFrame:
    return normalized_live(tables.live(spark, sf), tables.newest(spark, sf))


def _current(spark: SparkSession, sf: str, now: Column | None = None) -> DataFrame:
    return normalized_live(_latest_live(spark, sf), tables.newest(spark, sf) if now is None else now)


def normalized_flights(spark: SparkSession, sf: str) -> DataFrame:
    return _normalized(spark, sf)


def api_live_records(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.api_records(tables.live(spark, sf), tables.newest(spark, sf))


def api_spellings(spark: SparkSession, sf: str) -> DataFrame:
    """Service records whose fields come in several spellings, empty and zero values among them."""
    live, event = tables.live(spark, sf), F.col("event_id")
    records = live.select(
        "event_id", "icao24", F.when(event % 3 != 0, F.col("latitude")).alias("latitude"), F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"), F.when(event % 2 == 0, F.lit("")).otherwise(F.col("callsign")).alias("callsign"),
        F.col("callsign").alias("call_sign"), F.when(event % 4 == 0, F.col("origin")).alias("origin"),
        F.when(event % 4 == 1, F.lit("BBB")).otherwise(F.lit("")).alias("airport"),
        F.when(event % 4 == 2, F.lit("NNN")).alias("nearest_airport"), F.lit("EEE").alias("estDepartureAirport"),
        F.when(event % 5 == 0, F.col("dest")).alias("destination"), F.lit("AAA").alias("estArrivalAirport"),
        F.when(event % 6 == 0, F.lit(0.0)).otherwise(event % 7 * 1000.0).alias("altitude"), "baro_altitude", "geo_altitude",
        F.lit(0.0).alias("heading"), "true_track",
        F.when(event % 2 == 0, F.col("polled_at")).otherwise(F.lit("")).alias("timestamp"), F.lit("seen").alias("last_seen"),
    )
    return normalize.api_records(records, tables.newest(spark, sf))


def risk_from_delay(spark: SparkSession, sf: str) -> DataFrame:
    minutes = F.col("predicted_delay_minutes")
    return tables.live(spark, sf).select(
        "event_id",
        label_from_minutes(minutes).alias("risk_label"),
        score_from_minutes(minutes).alias("delay_risk"),
    )


def risk_from_probability(spark: SparkSession, sf: str) -> DataFrame:
    probability = (F.col("event_id") % 1000) / F.lit(1000.0)
    return tables.states(spark, sf).select(
        "event_id",
        label_from_probability(probability).alias("risk_label"),
        minutes_from_probability(probability).alias("delay_minutes"),
    )


def delays_top(spark: SparkSession, sf: str) -> DataFrame:
    return views.delays(_current(spark, sf))


def risk_table(spark: SparkSession, sf: str) -> DataFrame:
    delayed = views.delay_rows(_normalized(spark, sf))
    return views.risk_table(delayed, ["ATL", "JFK", "ORD", "ZZZ"], "high")


def map_points(spark: SparkSession, sf: str) -> DataFrame:
    return views.map_points(_normalized(spark, sf))


def density(spark: SparkSession, sf: str) -> DataFrame:
    now = tables.newest(spark, sf)
    return summary.density(_current(spark, sf, now), now)


def congestion_risk(spark: SparkSession, sf: str) -> DataFrame:
    scores = summary.congestion(_current(spark, sf))
    return scores.withColumn("band", congestion_band(F.col("score")))


def congestion_chart(spark: SparkSession, sf: str) -> DataFrame:
    return views.congestion_bars(summary.congestion(_current(spark, sf)))


def api_density(spark: SparkSession, sf: str) -> DataFrame:
    now = tables.newest(spark, sf)
    return summary.service_density(normalize.api_records(_latest_live(spark, sf), now), now)


def congestion_load(spark: SparkSession, sf: str) -> DataFrame:
    records = normalize.api_records(_latest_live(spark, sf), tables.newest(spark, sf))
    return summary.congestion(records, model="load")


def kpis(spark: SparkSession, sf: str) -> DataFrame:
    return summary.kpis(_current(spark, sf))


def activity_trend(spark: SparkSession, sf: str) -> DataFrame:
    minutes = F.coalesce("predicted_delay_minutes", F.lit(0.0))
    live = tables.live(spark, sf).dropna(subset=["latitude", "longitude"])
    last = live.agg(F.max("event_ts")).first()[0]  # one column, one value
    newest = F.lit(last and last.replace(second=0, microsecond=0)).cast("timestamp_ntz")
    # before the series is built, so that the bound reaches the scan
    live = live.filter(F.col("event_ts") >= newest - F.make_dt_interval(mins=F.lit(90)))
    series = summary.density_series(
        live.withColumn("risk_label", label_from_minutes(minutes)), "event_ts"
    )
    return summary.activity_trend(series, minutes=90, newest=newest)


def delay_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return summary.delay_histogram(_normalized(spark, sf))


# --- Streams -------------------------------------------------------------------------


def _in_arrivals(
    spark: SparkSession, sf: str, base: str, start: Callable[[DataFrame, int], object]
) -> None:
    """Deliver the events in three arrivals, some of them late, each to a query that goes on where the last one ended.

    ``start`` gets the stream of events and the arrival's number and returns the running query.
    """
    events = tables.arrivals(spark, sf)
    schema = events.drop("arrival").schema
    for arrival in range(tables.ARRIVALS):
        own = events.where(F.col("arrival") == arrival).drop("arrival")
        own.write.mode("append").parquet(f"{base}/events")
        stream = spark.readStream.schema(schema).parquet(f"{base}/events")
        start(tables.states_from_events(stream), arrival).awaitTermination()


def _raw(states: DataFrame) -> DataFrame:
    return messages.to_messages(states).select("value", F.current_timestamp().alias("arrived_at"))


def stream_latest_state(spark: SparkSession, sf: str) -> DataFrame:
    """Messages -> parse -> enrich -> history and current state, over several micro-batches and restarts."""
    base = new_folder(spark, "live")
    state = StateTable(spark, f"{base}/state", DAY)
    sink = pipeline.live_sink(
        _reference(spark, sf), state, History(spark, f"{base}/history"), BatchTable(spark, f"{base}/rejects")
    )
    _in_arrivals(spark, sf, base, lambda states, _: pipeline.run(
        _raw(states), sink, f"{base}/checkpoint", availableNow=True
    ))
    return state.read().withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


def stream_history(spark: SparkSession, sf: str) -> DataFrame:
    """One day of the compacted history: each arrival joined with the newest airports, of which the second brings new ones.

    The last arrival comes through a new checkpoint: it adds to the history, whatever its batch number.
    """
    base = new_folder(spark, "live")
    airports = SnapshotTable(spark, f"{base}/airports")
    history = History(spark, f"{base}/history")
    sink = pipeline.live_sink(
        pipeline.NewestReference(spark, airports.root), StateTable(spark, f"{base}/state", DAY), history,
        BatchTable(spark, f"{base}/rejects"),
    )

    def start(states: DataFrame, arrival: int):
        if arrival < 2:
            loaded = _airports(spark, sf)
            if arrival == 1:
                loaded = loaded.withColumns({"name": F.concat(F.lit("New "), "name"), "code": F.concat(F.lit("A"), "code")})
            write_airports(airports, loaded)
        else:
            history.compact()
        checkpoint = f"{base}/checkpoint" if arrival < 2 else f"{base}/checkpoint-2"
        return pipeline.run(_raw(states), sink, checkpoint, availableNow=True)

    _in_arrivals(spark, sf, base, start)
    history.compact()
    history.clean()
    return history.read(tables.history_day(spark, sf)).groupBy(pipeline.REFERENCE_VERSION, "origin_airport_icao_code", "origin_airport_name").agg(
        F.count(F.lit(1)).alias("states")
    )


def _counted(spark: SparkSession, sf: str, counts: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Per-minute counts of the arrivals in update mode, and the rows that the watermark dropped."""
    base = new_folder(spark, "counts")
    stored = BatchTable(spark, f"{base}/counts")
    _in_arrivals(spark, sf, base, lambda states, _: pipeline.run(
        counts(_timed(states)), pipeline.counts_sink(stored), f"{base}/checkpoint", "update", availableNow=True
    ))
    newest = stage(pipeline.newest_counts(stored.read()), "counts")
    return newest, pipeline.late_rows(counts(_timed(tables.states(spark, sf))), newest)


def _timed(states: DataFrame) -> DataFrame:
    return states.withColumn("event_ts", F.col("event_ts").cast("timestamp"))


def stream_density(spark: SparkSession, sf: str) -> DataFrame:
    """Counts per minute and country with a watermark of two minutes; the last row counts what came too late."""
    newest, late = _counted(spark, sf, lambda states: pipeline.minute_density(states, "origin_country"))
    found = pipeline.with_late(newest, late)
    return found.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def stream_trend(spark: SparkSession, sf: str) -> DataFrame:
    """The activity trend as the dashboard reads it, over the stored counts of the stream."""

    def counts(states: DataFrame) -> DataFrame:
        label = label_from_minutes(F.coalesce("predicted_delay_minutes", F.lit(0.0)))
        flights = tables.with_trip(states).dropna(subset=["latitude", "longitude"]).withColumn("risk_label", label)
        return pipeline.minute_density(flights, summary.hub_of(flights), signal=summary.delay_signal())

    found = summary.activity_trend(_counted(spark, sf, counts)[0], minutes=MONTH_MINUTES)
    return found.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def _scored_stream(spark: SparkSession, sf: str, scores: model.ScoreTable) -> DataFrame:
    base = new_folder(spark, "scored")
    output = BatchTable(spark, f"{base}/rows")
    sink = pipeline.scored_sink(scores, output)
    _in_arrivals(spark, sf, base, lambda states, _: pipeline.run(
        states, sink, f"{base}/checkpoint", availableNow=True
    ))
    return output.read().select(
        "event_id", "icao24", "carrier", "hour_of_day", "day_of_week", "month",
        "delay_probability", "risk_label",
    )


def stream_scored(spark: SparkSession, sf: str) -> DataFrame:
    return _scored_stream(spark, sf, _scores(spark, sf))


def stream_scored_by_rule(spark: SparkSession, sf: str) -> DataFrame:
    return _scored_stream(spark, sf, model.score_table(spark, RULE_CARRIERS, _rule(F.col("carrier"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        csv_roundtrip, csv_mixed_headers, ingest_report, csv_cast_failures, year_dirs_scan,
        some_year_dirs, year_month_filter,
        flights_partitioned, rejected_dates, clean_flights,
        hour_of_day, by_route, by_carrier, by_hour, stats_grouping_sets, route_features,
        quality_report, quality_summary, quality_after_rewrite, enriched_quality, live_quality,
        enriched_quality_raw, live_quality_raw, message_rejects,
        temporal_features, labelled, training_rows, training_cells, class_balance,
        holdout_tally, scored_flights, confusion_matrix, model_metrics,
        collapsed_model_metrics, predictions_filled, scored_by_rule, confusion_by_rule,
        metrics_by_rule, predictions_filled_by_rule, score_agreement,
        country_reference, country_reference_coherent, airports_filtered, airports_rejected,
        airports_upsert, state_enriched, latest_state, live_expired, live_limit,
        carrier_strict, carrier_fallback, state_features, state_features_text, states_json_parsed, state_vectors,
        state_topic_json, normalized_flights, api_live_records, api_spellings, risk_from_delay,
        risk_from_probability, delays_top, risk_table, map_points, density, congestion_risk,
        congestion_chart, api_density, congestion_load, kpis, activity_trend, delay_histogram,
        stream_latest_state, stream_history, stream_density, stream_trend, stream_scored,
        stream_scored_by_rule,
    )
}
