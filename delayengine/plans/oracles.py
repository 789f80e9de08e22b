"""DuckDB SQL for every query that SQL can express, written independently of the operators.

The views repeat the table adapters; everything else is plain SQL over them.
"""

from __future__ import annotations

from delayengine.schema import HUB_POSITIONS, ICAO_TO_IATA, STATE_VECTOR_TYPES

# --- Views ---------------------------------------------------------------------------

FLIGHTS = """
flights_v AS (
  SELECT l_orderkey, l_linenumber,
    strftime(l_shipdate, '%Y-%m-%d') AS FL_DATE,
    (['AA','DL','UA','WN','B6','AS','OO','F9'])[l_suppkey % 8 + 1] AS OP_CARRIER,
    o.n_name AS ORIGIN, d.n_name AS DEST,
    CAST(CASE WHEN l_orderkey % 25 = 24 THEN 2400
              ELSE (l_orderkey % 25) * 100 + l_partkey % 60 END AS INTEGER) AS CRS_DEP_TIME,
    CAST(dep AS FLOAT) AS DEP_DELAY,
    CAST(arr AS FLOAT) AS ARR_DELAY,
    CAST(CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS FLOAT) AS CANCELLED,
    CAST(100 + (l_partkey * 37) % 2500 AS FLOAT) AS DISTANCE,
    CAST(CASE WHEN l_linenumber % 2 = 0 AND arr > 15 THEN arr END AS FLOAT) AS CARRIER_DELAY,
    CAST(CASE WHEN l_linenumber % 2 = 1 AND arr > 15 THEN arr END AS FLOAT) AS WEATHER_DELAY
  FROM (
    SELECT *, dep + l_partkey % 21 - 10 AS arr
    FROM (SELECT *, CASE WHEN l_linenumber <> 7 THEN l_quantity - 55 + l_suppkey % 8 * 3
        + CASE WHEN l_orderkey % 25 = 24 THEN 0 ELSE l_orderkey % 25 END * 2 END AS dep FROM lineitem)
  ) l
  JOIN nation o ON o.n_nationkey = l_suppkey % 25
  JOIN nation d ON d.n_nationkey = l_partkey % 25
)"""

DIRTY = FLIGHTS + """,
dirty_v AS (
  SELECT * REPLACE (
    CASE WHEN l_orderkey % 97 = 0 THEN 'not-a-date' ELSE FL_DATE END AS FL_DATE,
    CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE CRS_DEP_TIME END AS CRS_DEP_TIME)
  FROM flights_v
)"""

FLOWN = FLIGHTS + """,
flown_v AS (
  SELECT *, CAST(CRS_DEP_TIME // 100 % 24 AS INTEGER) AS hour_of_day
  FROM flights_v WHERE CANCELLED = 0 AND DEP_DELAY IS NOT NULL
)"""

ROWS = FLIGHTS + """,
rows_v AS (
  SELECT OP_CARRIER AS carrier,
    CAST(CRS_DEP_TIME // 100 % 24 AS INTEGER) AS hour_of_day,
    CAST(dayofweek(CAST(FL_DATE AS DATE)) + 1 AS INTEGER) AS day_of_week,
    CAST(month(CAST(FL_DATE AS DATE)) AS INTEGER) AS month,
    CAST(CASE WHEN ARR_DELAY > 15 THEN 1 ELSE 0 END AS INTEGER) AS is_delayed
  FROM flights_v WHERE CANCELLED <> 1 AND ARR_DELAY IS NOT NULL
)"""

HELD_OUT = """('0x' || substr(md5(concat_ws('|', 42, FL_DATE, OP_CARRIER, ORIGIN, DEST, CRS_DEP_TIME,
    l_orderkey, l_linenumber)), 1, 8))::BIGINT % 10 >= 8 AS held_out"""
SPLIT = ROWS.replace("SELECT OP_CARRIER", f"SELECT {HELD_OUT}, OP_CARRIER")


def _rule(carrier: str) -> str:
    return f"(ascii({carrier}) + hour_of_day * 7 + day_of_week * 3 + month) % 20 / 20e0"


RULED = ROWS + f""",
ruled_v AS (SELECT is_delayed AS y, p, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS z
  FROM (SELECT is_delayed, {_rule("carrier")} AS p FROM rows_v))"""


def _iso(ts: str) -> str:
    return (
        f"CASE WHEN microsecond({ts}) % 1000000 = 0 THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S+00:00') "
        f"ELSE strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f+00:00') END"
    )


STATES = f"""
states_v AS (
  SELECT printf('%06x', user_id) AS icao24,
    (['AAL','DAL','UAL','SWA','JBU','ASA','SKW','FFT','ZZZ'])[user_id % 9 + 1]
      || (user_id % 900 + 100) AS callsign,
    'NATION_' || (user_id % 30) AS origin_country,
    CAST(CASE WHEN event_id % 50 <> 49 THEN (event_id % 3600) / 10.0 - 180 END AS FLOAT) AS longitude,
    CAST(CASE WHEN event_id % 50 <> 49 THEN (event_id % 1800) / 10.0 - 90 END AS FLOAT) AS latitude,
    CAST(event_id % 400 * 100 AS FLOAT) AS baro_altitude,
    CAST(value AS FLOAT) AS velocity,
    CAST(event_id % 360 AS FLOAT) AS true_track,
    event_type = 'signup' AS on_ground,
    {_iso("ts")} AS polled_at,
    epoch_us(ts) // 1000000 AS time_position,
    epoch_us(ts) // 1000000 + 1 AS last_contact,
    CAST(event_id % 400 * 100 + 50 AS FLOAT) AS geo_altitude,
    CAST(NULL AS FLOAT) AS vertical_rate,
    ts AS event_ts, event_id
  FROM events
), now_v AS (SELECT max(ts) AS now FROM events)"""

LATEST = STATES + """,
latest_v AS (
  SELECT * EXCLUDE rn FROM (
    SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY event_ts DESC, event_id DESC) AS rn
    FROM states_v) WHERE rn = 1
)"""


def _trip(source: str) -> str:
    hubs = ",".join(f"'{h}'" for h in HUB_POSITIONS)
    return f"""
live_v AS (
  SELECT * EXCLUDE u,
    CASE WHEN u % 13 = 12 THEN 'ZZZ' WHEN u % 4 = 0 THEN ([{hubs}])[1] WHEN u % 5 = 1 THEN ([{hubs}])[2]
      ELSE ([{hubs}])[u % 10 + 1] END AS origin,
    ([{hubs}])[(u * 3 + 4) % 10 + 1] AS dest,
    CASE WHEN event_id % 7 <> 6 THEN (event_id % 90) / 2.0 END AS predicted_delay_minutes
  FROM (SELECT *, CAST('0x' || icao24 AS BIGINT) AS u FROM {source})
)"""


def _round(value: str, digits: int) -> str:
    """Nearest decimal to the exact binary value of a double."""
    return f"CAST(printf('%.{digits}f', CAST({value} AS DOUBLE)) AS DOUBLE)"


def _label(minutes: str) -> str:
    return f"CASE WHEN {minutes} > 30 THEN 'high' WHEN {minutes} >= 5 THEN 'medium' ELSE 'low' END"


NORMALIZED = f"""
normalized_v AS (
  SELECT icao24 AS flight_id, icao24, callsign, left(callsign, 3) AS carrier, origin, dest,
    origin AS airport, origin AS nearest_airport,
    CAST(latitude AS DOUBLE) AS lat, CAST(longitude AS DOUBLE) AS lon,
    CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
    CAST(baro_altitude AS INTEGER) AS altitude,
    {_round("velocity", 1)} AS velocity,
    CAST(true_track AS DOUBLE) AS heading, on_ground,
    CAST(hour(now) * 100 + minute(now) AS INTEGER) AS crs_dep_time,
    CAST(500 AS DOUBLE) AS distance,
    CAST(month(now) AS INTEGER) AS month,
    CASE WHEN predicted_delay_minutes IS NULL THEN 0.0::DOUBLE
         ELSE {_round("predicted_delay_minutes", 1)} END AS predicted_delay_minutes,
    {_label("coalesce(predicted_delay_minutes, 0)")} AS risk_label,
    CASE WHEN predicted_delay_minutes IS NULL THEN 0.0::DOUBLE
         ELSE {_round("greatest(0.02::DOUBLE, least(predicted_delay_minutes / 60, 1.0::DOUBLE))", 2)}
         END AS delay_risk,
    {_iso("make_timestamp(time_position * 1000000)")} AS timestamp,
    'api' AS source
  FROM live_v, now_v WHERE latitude IS NOT NULL AND longitude IS NOT NULL
)"""

API = f"""
api_v AS (
  SELECT icao24 AS flight_id, icao24, callsign, left(callsign, 3) AS carrier, origin, dest,
    origin AS nearest_airport,
    CAST(latitude AS DOUBLE) AS lat, CAST(longitude AS DOUBLE) AS lon,
    CAST(CASE WHEN baro_altitude = 0 THEN geo_altitude ELSE baro_altitude END AS DOUBLE) AS altitude,
    CAST(velocity AS DOUBLE) AS velocity, CAST(true_track AS DOUBLE) AS heading, on_ground,
    CAST(1200 AS INTEGER) AS crs_dep_time, CAST(500 AS DOUBLE) AS distance,
    CAST(month(now) AS INTEGER) AS month, {_iso("now")} AS timestamp
  FROM live_v, now_v WHERE latitude IS NOT NULL AND longitude IS NOT NULL
)"""

ALL_FLIGHTS_LIVE = f"WITH {STATES},{_trip('states_v')},{NORMALIZED}"
CURRENT = f"WITH {LATEST},{_trip('latest_v')},{NORMALIZED}"
ALL_RECORDS = f"WITH {STATES},{_trip('states_v')},{API}"
CURRENT_RECORDS = f"WITH {LATEST},{_trip('latest_v')},{API}"

AIRPORT_TEXTS = """
texts_v AS (
  SELECT (['large_airport','medium_airport','small_airport'])[s_suppkey % 3 + 1] AS type,
    CASE WHEN s_suppkey % 11 = 0 THEN '' ELSE 'S' || (s_suppkey % 60) END AS iata_code,
    s_name AS name,
    CASE WHEN s_suppkey % 17 = 0 THEN 'unknown' ELSE CAST(s_suppkey % 180 - 90 AS VARCHAR) END AS latitude_deg,
    CAST(s_suppkey % 360 - 180 AS VARCHAR) AS longitude_deg,
    'TZ_' || (s_nationkey % 5) AS tz_database_timezone,
    n_name AS iso_country, s_suppkey AS load_order
  FROM supplier JOIN nation ON n_nationkey = s_nationkey
), served_v AS (
  SELECT * FROM texts_v WHERE type IN ('large_airport', 'medium_airport') AND iata_code <> ''
), airports_v AS (
  SELECT iata_code AS code, name, CAST(latitude_deg AS DOUBLE) AS latitude,
    CAST(longitude_deg AS DOUBLE) AS longitude, tz_database_timezone AS timezone,
    iso_country AS country, load_order
  FROM served_v WHERE TRY_CAST(latitude_deg AS DOUBLE) IS NOT NULL
), countries_v AS (
  SELECT country, min(code) AS code, min(name) AS name, min(timezone) AS timezone
  FROM airports_v GROUP BY country
)"""

STAT_COLUMNS = """count(*) AS flight_count, avg(CAST(DEP_DELAY AS DOUBLE)) AS mean_dep_delay,
  avg(CASE WHEN DEP_DELAY > 15 THEN 1e0 ELSE 0e0 END) AS pct_delayed_15min"""

CANONICAL = """FL_DATE, OP_CARRIER, ORIGIN, DEST, CRS_DEP_TIME, DEP_DELAY, ARR_DELAY, CANCELLED,
  DISTANCE, CARRIER_DELAY, WEATHER_DELAY"""
KEYS = """CAST(year(CAST(FL_DATE AS DATE)) AS INTEGER) AS year,
  CAST(month(CAST(FL_DATE AS DATE)) AS INTEGER) AS month"""

IATA = "(VALUES " + ", ".join(f"('{k}','{v}')" for k, v in ICAO_TO_IATA.items()) + ") AS m(icao, iata)"
PLACES = (
    "(VALUES "
    + ", ".join(f"('{k}',{a}::DOUBLE,{b}::DOUBLE)" for k, (a, b) in HUB_POSITIONS.items())
    + ") AS h(code, hub_lat, hub_lon)"
)

SIGNAL = "on_ground OR risk_label IN ('medium','high')"
HUB_SCORES = f"""
hubs_v AS (
  SELECT nearest_airport AS hub, count(*) AS aircraft_count,
    count(*) FILTER (WHERE on_ground) AS ground_count,
    CAST(sum(CAST(delay_risk AS DECIMAL(18,6))) AS DOUBLE) AS risk_sum
  FROM normalized_v GROUP BY 1
), scores_v AS (
  SELECT hub, least(100::DOUBLE, {_round(
    "aircraft_count * 1.2::DOUBLE + risk_sum / aircraft_count * 55::DOUBLE + ground_count * 2.5::DOUBLE", 1)}) AS score,
    aircraft_count, ground_count
  FROM hubs_v
)"""

ENRICHED = f"""WITH {STATES},{AIRPORT_TEXTS}
SELECT s.*, c.code AS origin_airport_icao_code, c.name AS origin_airport_name,
  c.timezone AS origin_airport_timezone
FROM states_v s LEFT JOIN countries_v c ON c.country = s.origin_country"""


def _check(name: str, expected: str, passed: str, observed: str) -> str:
    return (
        f"SELECT '{name}' AS \"check\", {passed} AS passed, {observed} AS observed, "
        f"CASE WHEN {passed} THEN 'PASS ' ELSE 'FAIL ' END || '{expected}: ' || {observed} AS message FROM a"
    )


def _span(name: str, column: str) -> str:
    return _check(
        name, f"{column} in [-60, 600]", f"(min_{name} >= -60 AND max_{name} <= 600)",
        f"('min=' || min_{name} || ', max=' || max_{name})",
    )


def _bad(name: str, expected: str) -> str:
    return _check(name, expected, f"({name} = 0)", f"('violations=' || {name})")


QUALITY = f"""WITH {FLIGHTS}, k AS (SELECT *, {KEYS} FROM flights_v), a AS (
  SELECT min(DEP_DELAY) AS min_dep_delay_range, max(DEP_DELAY) AS max_dep_delay_range,
    min(ARR_DELAY) AS min_arr_delay_range, max(ARR_DELAY) AS max_arr_delay_range,
    max(CAST(FL_DATE AS DATE)) AS newest,
    count(*) FILTER (WHERE CANCELLED NOT IN (0, 1)) AS cancelled_flag,
    count(*) FILTER (WHERE DISTANCE <= 0) AS distance_positive,
    count(*) FILTER (WHERE CRS_DEP_TIME NOT BETWEEN 0 AND 2400) AS departure_range,
    count(*) FILTER (WHERE year < 2019) AS first_year,
    count(*) FILTER (WHERE month NOT BETWEEN 1 AND 12) AS month_range
  FROM k)
""" + "\nUNION ALL ".join(
    [
        _check("required_columns", "11 flight columns present", "true", "'missing=none'"),
        _span("dep_delay_range", "DEP_DELAY"),
        _span("arr_delay_range", "ARR_DELAY"),
        _check(
            "no_future_date", "FL_DATE not in the future", "(newest <= DATE '2001-12-31')",
            "('max=' || newest)",
        ),
        _bad("cancelled_flag", "CANCELLED is 0 or 1"),
        _bad("distance_positive", "DISTANCE above 0"),
        _bad("departure_range", "CRS_DEP_TIME in [0, 2400]"),
        _bad("first_year", "year from 2019"),
        _bad("month_range", "month in [1, 12]"),
    ]
)


def _carrier(mode: str) -> str:
    icao = "upper(left(trim(callsign), 3))"
    value = "iata" if mode == "strict" else f"coalesce(iata, left({icao}, 2))"
    return (
        f"WITH {STATES} SELECT event_id, callsign, {value} AS carrier "
        f"FROM states_v LEFT JOIN {IATA} ON icao = {icao}"
    )


def _vectors() -> str:
    known = (
        "icao24", "callsign", "origin_country", "time_position", "last_contact", "longitude",
        "latitude", "baro_altitude", "on_ground", "velocity", "true_track", "vertical_rate",
        "geo_altitude",
    )
    types = {"string": "VARCHAR", "bigint": "BIGINT", "float": "FLOAT", "boolean": "BOOLEAN", "int": "INTEGER"}
    constant = {"spi": "false", "position_source": "0"}

    def fields(present: tuple[str, ...], constants: dict[str, str]) -> str:
        return ", ".join(
            f"CAST({n if n in present else constants.get(n, 'NULL')} AS {types[t]}) AS {n}"
            for n, t in STATE_VECTOR_TYPES.items()
        )

    return (
        f"WITH {STATES} SELECT {fields(known, constant)}, polled_at FROM states_v "
        f"UNION ALL SELECT {fields(('icao24', 'callsign'), {})}, polled_at FROM states_v"
    )


# Events by arrival; before each arrival the watermark stands two minutes before the newest row delivered so far.
def _arriving(rows: str) -> str:
    return f"""
arrivals_v AS (
  SELECT *, least(2, event_id * 3 // (SELECT max(event_id) + 1 FROM events)
    + CASE WHEN event_id % 53 = 0 THEN 1 ELSE 0 END) AS arrival FROM {rows}
), timely_v AS (
  SELECT a.*, coalesce(date_trunc('minute', event_ts) + INTERVAL 1 MINUTE <=
    (SELECT date_trunc('millisecond', max(b.event_ts)) - INTERVAL 2 MINUTE FROM arrivals_v b WHERE b.arrival < a.arrival), false) AS late
  FROM arrivals_v a
)"""


RULE_SLOT = "CASE WHEN carrier IN ('AA', 'DL', 'UA', 'WN') THEN carrier ELSE '???' END"
CLOCK = """CAST(hour(event_ts) AS INTEGER) AS hour_of_day, CAST(dayofweek(event_ts) + 1 AS INTEGER) AS day_of_week,
  CAST(month(event_ts) AS INTEGER) AS month"""
PROBABLE = "CASE WHEN p < 0.3 THEN 'low' WHEN p < 0.6 THEN 'medium' ELSE 'high' END"

_KEYED = NORMALIZED[NORMALIZED.index("SELECT"):NORMALIZED.rindex(")")].replace("SELECT icao24", "SELECT event_id, icao24", 1)

DAY_OLD = "event_ts > now - INTERVAL 86400 SECOND"

# --- One statement per query ---------------------------------------------------------

ORACLES: dict[str, str] = {
    "csv_roundtrip": f"""WITH {DIRTY}
        SELECT {CANONICAL}, {KEYS} FROM dirty_v WHERE FL_DATE <> 'not-a-date'""",
    "csv_mixed_headers": f"""WITH {DIRTY}
        SELECT FL_DATE, OP_CARRIER, ORIGIN, DEST, CRS_DEP_TIME, DEP_DELAY, ARR_DELAY, CANCELLED,
          CASE WHEN l_orderkey % 3 <> 2 THEN DISTANCE END AS DISTANCE,
          CASE WHEN l_orderkey % 3 <> 2 THEN CARRIER_DELAY END AS CARRIER_DELAY,
          CASE WHEN l_orderkey % 3 <> 2 THEN WEATHER_DELAY END AS WEATHER_DELAY, {KEYS}
        FROM dirty_v WHERE FL_DATE <> 'not-a-date'""",
    "ingest_report": f"""WITH {FLIGHTS}
        SELECT count(*) AS rows, count(*) FILTER (WHERE l_orderkey % 97 = 0) AS undated,
          count(*) FILTER (WHERE l_orderkey % 97 = 0) AS rejects_kept,
          count(*) FILTER (WHERE l_orderkey % 101 = 0) AS CRS_DEP_TIME, 0::BIGINT AS DEP_DELAY,
          0::BIGINT AS ARR_DELAY, 0::BIGINT AS CANCELLED, 0::BIGINT AS DISTANCE,
          0::BIGINT AS CARRIER_DELAY, 0::BIGINT AS WEATHER_DELAY FROM flights_v""",
    "csv_cast_failures": f"""WITH {FLIGHTS}
        SELECT count(*) FILTER (WHERE l_orderkey % 101 = 0) AS CRS_DEP_TIME, 0::BIGINT AS DEP_DELAY,
          0::BIGINT AS ARR_DELAY, 0::BIGINT AS CANCELLED, 0::BIGINT AS DISTANCE,
          0::BIGINT AS CARRIER_DELAY, 0::BIGINT AS WEATHER_DELAY FROM flights_v""",
    "year_dirs_scan": f"""WITH {FLIGHTS}, k AS (SELECT {KEYS} FROM flights_v)
        SELECT year, month, count(*) AS flights FROM k
        WHERE year BETWEEN 1995 AND 2001 GROUP BY ALL""",
    "some_year_dirs": f"""WITH {FLIGHTS}, k AS (SELECT {KEYS} FROM flights_v)
        SELECT year, month, count(*) AS flights FROM k WHERE year IN (1996, 1999) GROUP BY ALL""",
    "year_month_filter": f"""WITH {FLIGHTS}, k AS (SELECT *, {KEYS} FROM flights_v)
        SELECT * FROM k WHERE year = 1997 AND month = 6""",
    "flights_partitioned": f"WITH {FLIGHTS} SELECT *, {KEYS} FROM flights_v",
    "rejected_dates": f"WITH {DIRTY} SELECT {CANONICAL} FROM dirty_v WHERE FL_DATE = 'not-a-date'",
    "clean_flights": f"WITH {FLOWN} SELECT * EXCLUDE hour_of_day FROM flown_v",
    "hour_of_day": f"""WITH {FLIGHTS} SELECT l_orderkey, l_linenumber, CRS_DEP_TIME,
        CAST(CRS_DEP_TIME // 100 % 24 AS INTEGER) AS hour_of_day FROM flights_v""",
    "by_route": f"WITH {FLOWN} SELECT ORIGIN, DEST, {STAT_COLUMNS} FROM flown_v GROUP BY ORIGIN, DEST",
    "by_carrier": f"WITH {FLOWN} SELECT OP_CARRIER, {STAT_COLUMNS} FROM flown_v GROUP BY OP_CARRIER",
    "by_hour": f"WITH {FLOWN} SELECT hour_of_day, {STAT_COLUMNS} FROM flown_v GROUP BY hour_of_day",
    "stats_grouping_sets": f"""WITH {FLOWN}
        SELECT ORIGIN, DEST, NULL::VARCHAR AS OP_CARRIER, NULL::INTEGER AS hour_of_day,
          'by_route' AS stat, {STAT_COLUMNS} FROM flown_v GROUP BY ORIGIN, DEST
        UNION ALL SELECT NULL, NULL, OP_CARRIER, NULL, 'by_carrier', {STAT_COLUMNS}
          FROM flown_v GROUP BY OP_CARRIER
        UNION ALL SELECT NULL, NULL, NULL, hour_of_day, 'by_hour', {STAT_COLUMNS}
          FROM flown_v GROUP BY hour_of_day""",
    "route_features": f"""WITH {FLOWN},
        r AS (SELECT ORIGIN, DEST, {STAT_COLUMNS} FROM flown_v GROUP BY ORIGIN, DEST)
        SELECT l_orderkey, l_linenumber, f.ORIGIN, f.DEST, flight_count, mean_dep_delay, pct_delayed_15min
        FROM flights_v f LEFT JOIN r ON r.ORIGIN = f.ORIGIN AND r.DEST = f.DEST""",
    "quality_report": QUALITY,
    "quality_summary": f"""SELECT count(*) FILTER (WHERE passed) AS passed, count(*) AS total
        FROM ({QUALITY})""",
    "quality_after_rewrite": QUALITY.replace("k AS (SELECT *,", """k AS (SELECT * REPLACE (
          CASE WHEN FL_DATE LIKE '1997-06-%' THEN -DISTANCE ELSE DISTANCE END AS DISTANCE,
          CAST(CASE WHEN FL_DATE LIKE '1997-06-%' THEN DEP_DELAY + 700 ELSE DEP_DELAY END AS FLOAT) AS DEP_DELAY),""", 1),
    "enriched_quality_raw": f"""WITH a AS (SELECT count(*) FILTER (WHERE event_id % 41 = 0 OR event_id % 43 = 0) AS icao24_present FROM events)
        {_bad("icao24_present", "icao24 not NULL")}""",
    "live_quality_raw": f"""WITH a AS (SELECT count(*) AS n, count(*) FILTER (WHERE event_id % 41 = 0) AS live_json_valid,
          count(*) FILTER (WHERE event_id % 43 = 0) AS live_keys FROM events)
        {_bad("live_json_valid", "values are JSON")}
        UNION ALL {_check("live_entries", "at least one entry", "(n > 0)", "('rows=' || n)")}
        UNION ALL {_bad("live_keys", "entries have a key")}""",
    "message_rejects": """SELECT CASE WHEN event_id % 41 = 0 OR event_id % 43 = 0 THEN 'no aircraft' END AS reason,
        count(*) AS messages FROM events GROUP BY ALL""",
    "enriched_quality": f"""WITH e AS ({ENRICHED}), a AS (
        SELECT count(*) FILTER (WHERE icao24 IS NULL) AS icao24_present FROM e)
        {_bad("icao24_present", "icao24 not NULL")}""",
    "live_quality": f"""WITH {LATEST}, a AS (SELECT count(*) AS n, 0 AS live_json_valid, 0 AS live_keys FROM latest_v)
        {_bad("live_json_valid", "values are JSON")}
        UNION ALL {_bad("live_keys", "entries have a key")}
        UNION ALL {_check("live_entries", "at least one entry", "(n > 0)", "('rows=' || n)")}""",
    "temporal_features": f"""WITH {FLIGHTS} SELECT l_orderkey, l_linenumber,
        CAST(CRS_DEP_TIME // 100 % 24 AS INTEGER) AS hour_of_day,
        CAST(dayofweek(CAST(FL_DATE AS DATE)) + 1 AS INTEGER) AS day_of_week,
        CAST(month(CAST(FL_DATE AS DATE)) AS INTEGER) AS month FROM flights_v""",
    "labelled": f"""WITH {FLIGHTS} SELECT l_orderkey, l_linenumber, ARR_DELAY,
        CAST(CASE WHEN ARR_DELAY > 15 THEN 1 ELSE 0 END AS INTEGER) AS is_delayed
        FROM flights_v WHERE CANCELLED <> 1 AND ARR_DELAY IS NOT NULL""",
    "training_rows": f"""WITH {ROWS} SELECT *,
        CASE WHEN is_delayed = 1 THEN 2e0 ELSE 1e0 END AS class_weight FROM rows_v""",
    "training_cells": f"""WITH {ROWS} SELECT carrier, hour_of_day, day_of_week, month, is_delayed,
        sum(CASE WHEN is_delayed = 1 THEN 2e0 ELSE 1e0 END) AS class_weight
        FROM rows_v GROUP BY ALL""",
    "holdout_tally": f"""WITH {SPLIT} SELECT carrier, hour_of_day, day_of_week, month, is_delayed, held_out,
        count(*) AS flights FROM rows_v GROUP BY ALL""",
    "score_agreement": f"""WITH {SPLIT} SELECT count(*) AS compared, 0::BIGINT AS mismatches FROM (SELECT DISTINCT
        carrier, hour_of_day, day_of_week, month, is_delayed FROM rows_v WHERE held_out)""",
    "scored_by_rule": f"""WITH {FLIGHTS}, k AS (SELECT l_orderkey, l_linenumber,
          CASE WHEN OP_CARRIER IN ('AA', 'DL', 'UA', 'WN') THEN OP_CARRIER ELSE '???' END AS carrier,
          CRS_DEP_TIME // 100 % 24 AS hour_of_day, dayofweek(CAST(FL_DATE AS DATE)) + 1 AS day_of_week,
          month(CAST(FL_DATE AS DATE)) AS month FROM flights_v)
        SELECT l_orderkey, l_linenumber, p AS delay_probability,
          CASE WHEN p < 0.3 THEN 'low' WHEN p < 0.6 THEN 'medium' ELSE 'high' END AS risk_label
        FROM (SELECT *, {_rule("carrier")} AS p FROM k)""",
    "confusion_by_rule": f"""WITH {RULED}
        SELECT 'label_' || y || '_pred_' || z AS cell, count(*) AS flights FROM ruled_v GROUP BY ALL""",
    "metrics_by_rule": f"""WITH {RULED},
        u AS (SELECT sum(late * (below + fine / 2e0)) / (sum(late) * sum(fine)) AS auc FROM (
          SELECT late, fine, sum(fine) OVER (ORDER BY p ROWS UNBOUNDED PRECEDING) - fine AS below FROM (
            SELECT p, count(*) FILTER (WHERE y = 1) AS late, count(*) FILTER (WHERE y = 0) AS fine
            FROM ruled_v GROUP BY p))),
        c AS (SELECT k, count(*)::DOUBLE AS n, count(*) FILTER (WHERE y = k)::DOUBLE AS own,
            count(*) FILTER (WHERE z = k)::DOUBLE AS said, count(*) FILTER (WHERE y = k AND z = k)::DOUBLE AS hit
          FROM ruled_v, (VALUES (0), (1)) AS classes(k) GROUP BY k),
        r AS (SELECT k, n, hit, own / n AS share, hit / said AS prec, hit / own AS rec FROM c)
        SELECT (SELECT {_round("auc", 4)} FROM u) AS auc,
          {_round("sum(hit) / max(n)", 4)} AS accuracy,
          {_round("sum(share * prec ORDER BY k)", 4)} AS precision,
          {_round("sum(share * rec ORDER BY k)", 4)} AS recall,
          {_round("sum(share * (2e0 * prec * rec / (prec + rec)) ORDER BY k)", 4)} AS f1 FROM r""",
    "class_balance": f"""WITH {ROWS} SELECT count(*) AS total,
        {_round("count(*) FILTER (WHERE is_delayed = 1) / count(*)", 4)} AS delayed_pct,
        {_round("count(*) FILTER (WHERE is_delayed = 0) / count(*)", 4)} AS on_time_pct FROM rows_v""",
    "country_reference": f"WITH {AIRPORT_TEXTS} SELECT * FROM countries_v",
    "country_reference_coherent": f"""WITH {AIRPORT_TEXTS}
        SELECT country, code, name, timezone FROM (SELECT *, row_number() OVER
          (PARTITION BY country ORDER BY code, name, timezone) AS rn FROM airports_v) WHERE rn = 1""",
    "airports_filtered": f"WITH {AIRPORT_TEXTS} SELECT * FROM airports_v",
    "airports_rejected": f"""WITH {AIRPORT_TEXTS} SELECT * FROM served_v
        WHERE TRY_CAST(latitude_deg AS DOUBLE) IS NULL""",
    "airports_upsert": f"""WITH {AIRPORT_TEXTS}, stored AS (
        SELECT 'S' || (n_nationkey * 3) AS code, 'Old ' || n_name AS name, n_name AS country,
          n_nationkey AS elevation FROM nation
      ), new AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY load_order DESC) AS rn
          FROM airports_v) WHERE rn = 1)
      SELECT coalesce(n.code, s.code) AS code,
        CASE WHEN n.code IS NULL THEN s.name ELSE n.name END AS name,
        CASE WHEN n.code IS NULL THEN 0e0 ELSE n.latitude END AS latitude,
        CASE WHEN n.code IS NULL THEN 0e0 ELSE n.longitude END AS longitude,
        CASE WHEN n.code IS NULL THEN 'TZ_old' ELSE n.timezone END AS timezone,
        CASE WHEN n.code IS NULL THEN s.country ELSE n.country END AS country,
        s.elevation
      FROM stored s FULL JOIN new n ON n.code = s.code""",
    "state_enriched": ENRICHED,
    "latest_state": f"WITH {LATEST} SELECT * FROM latest_v",
    "live_expired": f"WITH {LATEST} SELECT latest_v.* FROM latest_v, now_v WHERE {DAY_OLD}",
    "live_limit": f"{CURRENT_RECORDS} SELECT * FROM api_v ORDER BY icao24 LIMIT 60",
    "carrier_strict": _carrier("strict"),
    "carrier_fallback": _carrier("fallback"),
    "state_features": f"""WITH {STATES} SELECT event_id, iata AS carrier,
        CAST(hour(event_ts) AS INTEGER) AS hour_of_day,
        CAST(dayofweek(event_ts) + 1 AS INTEGER) AS day_of_week,
        CAST(month(event_ts) AS INTEGER) AS month
        FROM states_v LEFT JOIN {IATA} ON icao = left(callsign, 3)""",
    "state_features_text": f"""WITH {STATES}, t AS (SELECT event_id, callsign, CASE
          WHEN event_id % 5 = 0 THEN now WHEN event_id % 5 = 2 THEN event_ts
          WHEN event_id % 3 = 1 THEN event_ts - INTERVAL 7 HOUR ELSE now END AS event_ts FROM states_v, now_v)
        SELECT event_id, iata AS carrier, {CLOCK} FROM t LEFT JOIN {IATA} ON icao = left(callsign, 3)""",
    "states_json_parsed": f"WITH {STATES} SELECT * EXCLUDE event_id FROM states_v",
    "state_vectors": _vectors(),
    "state_topic_json": f"""WITH {STATES} SELECT icao24 AS key, '{{"icao24":"' || icao24
        || '","callsign":"' || callsign || '","origin_country":"' || origin_country
        || '","longitude":' || coalesce(CAST(longitude AS VARCHAR), 'null')
        || ',"latitude":' || coalesce(CAST(latitude AS VARCHAR), 'null')
        || ',"on_ground":' || on_ground || ',"polled_at":"' || polled_at
        || '","time_position":' || time_position || '}}' AS value FROM states_v""",
    "normalized_flights": f"{ALL_FLIGHTS_LIVE} SELECT * FROM normalized_v",
    "api_live_records": f"{ALL_RECORDS} SELECT * FROM api_v",
    "api_spellings": f"""WITH {STATES},{_trip("states_v")}, r AS (SELECT *, CASE WHEN event_id % 2 = 0 THEN callsign ELSE callsign END AS cs,
          CASE event_id % 4 WHEN 0 THEN origin WHEN 1 THEN 'BBB' WHEN 2 THEN 'NNN' ELSE 'EEE' END AS o,
          CASE WHEN event_id % 6 <> 0 AND event_id % 7 <> 0 THEN event_id % 7 * 1000.0 END AS al FROM live_v)
        SELECT icao24 AS flight_id, icao24, cs AS callsign, left(cs, 3) AS carrier, o AS origin,
          CASE WHEN event_id % 5 = 0 THEN dest ELSE 'AAA' END AS dest, o AS nearest_airport,
          CAST(latitude AS DOUBLE) AS lat, CAST(longitude AS DOUBLE) AS lon,
          CAST(coalesce(al, nullif(baro_altitude, 0), nullif(geo_altitude, 0), 0) AS DOUBLE) AS altitude, 0::DOUBLE AS velocity,
          CAST(true_track AS DOUBLE) AS heading, false AS on_ground, CAST(1200 AS INTEGER) AS crs_dep_time, CAST(500 AS DOUBLE) AS distance,
          CAST(month(now) AS INTEGER) AS month, CASE WHEN event_id % 2 = 0 THEN polled_at ELSE 'seen' END AS timestamp
        FROM r, now_v WHERE latitude IS NOT NULL AND event_id % 3 <> 0""",
    "risk_from_delay": f"""WITH {STATES},{_trip('states_v')} SELECT event_id,
        {_label("predicted_delay_minutes")} AS risk_label,
        CASE WHEN predicted_delay_minutes IS NOT NULL THEN
          {_round("greatest(0.02::DOUBLE, least(predicted_delay_minutes / 60, 1.0::DOUBLE))", 2)} END AS delay_risk
        FROM live_v""",
    "risk_from_probability": f"""SELECT event_id,
        CASE WHEN p < 0.3 THEN 'low' WHEN p < 0.6 THEN 'medium' ELSE 'high' END AS risk_label,
        {_round("p * 60", 1)} AS delay_minutes
        FROM (SELECT event_id, (event_id % 1000) / 1000::DOUBLE AS p FROM events)""",
    "delays_top": f"""{CURRENT} SELECT flight_id, icao24, callsign, origin, dest,
        nearest_airport AS airport, predicted_delay_minutes AS duration_minutes,
        upper(left(risk_label, 1)) || lower(risk_label[2:]) AS risk_level, lat, lon, velocity, on_ground
        FROM normalized_v WHERE predicted_delay_minutes >= 5 ORDER BY duration_minutes DESC, icao24""",
    "risk_table": f"""{ALL_FLIGHTS_LIVE} SELECT callsign, origin || ' → ' || dest AS route,
        predicted_delay_minutes AS duration_minutes, 'High' AS risk_level,
        CASE WHEN on_ground THEN 'Ground' ELSE 'Airborne' END AS status, velocity
        FROM normalized_v WHERE predicted_delay_minutes >= 5 AND risk_label = 'high'
          AND origin IN ('ATL','JFK','ORD','ZZZ')""",
    "map_points": f"""{ALL_FLIGHTS_LIVE} SELECT lat, lon,
        CASE WHEN on_ground THEN 15e0 ELSE 8e0 + 8e0 * delay_risk END AS size, delay_risk AS color,
        callsign AS text, origin, dest, altitude, velocity, predicted_delay_minutes,
        upper(risk_label) AS risk, CASE WHEN on_ground THEN 'Ground' ELSE 'Airborne' END AS status
        FROM normalized_v""",
    "density": f"""{CURRENT}, g AS (SELECT nearest_airport AS region, count(*) AS count,
        count(*) FILTER (WHERE {SIGNAL}) AS ground_delay_count,
        arg_min(lat, icao24) AS first_lat, arg_min(lon, icao24) AS first_lon
        FROM normalized_v GROUP BY 1)
        SELECT region, coalesce(hub_lat, first_lat) AS lat, coalesce(hub_lon, first_lon) AS lon,
          count, ground_delay_count, strftime(now, '%Y-%m-%dT%H:%M:00+00:00') AS timestamp
        FROM g LEFT JOIN {PLACES} ON code = region, now_v""",
    "congestion_risk": f"""{CURRENT},{HUB_SCORES} SELECT *,
        CASE WHEN score < 50 THEN 'green' WHEN score < 75 THEN 'orange' ELSE 'red' END AS band
        FROM scores_v ORDER BY score DESC, hub""",
    "congestion_chart": f"""{CURRENT},{HUB_SCORES} SELECT hub, score,
        CASE WHEN score < 50 THEN 'green' WHEN score < 75 THEN 'orange' ELSE 'red' END AS band
        FROM scores_v ORDER BY score, hub""",
    "api_density": f"""{CURRENT_RECORDS} SELECT nearest_airport AS region, count(*) AS count,
        count(*) FILTER (WHERE on_ground) AS ground_delay_count,
        strftime(now, '%Y-%m-%dT%H:%M:00+00:00') AS timestamp
        FROM api_v, now_v GROUP BY nearest_airport, now""",
    "congestion_load": f"""{CURRENT_RECORDS}, g AS (SELECT nearest_airport AS hub,
        count(*) AS aircraft_count, count(*) FILTER (WHERE on_ground) AS ground_count
        FROM api_v GROUP BY 1)
        SELECT hub, least(100::DOUBLE,
          {_round("aircraft_count * 1.4::DOUBLE + ground_count * 4::DOUBLE", 1)}) AS score,
          aircraft_count, ground_count FROM g ORDER BY score DESC, hub""",
    "kpis": f"""{CURRENT},{HUB_SCORES} SELECT count(*) AS total_flights,
        count(*) FILTER (WHERE predicted_delay_minutes >= 5) AS delayed_flights,
        count(*) FILTER (WHERE risk_label = 'high') AS high_risk_flights,
        (SELECT count(*) FROM scores_v WHERE score >= 75) AS congestion_alerts,
        CAST(coalesce(sum(altitude) FILTER (WHERE NOT on_ground), 0)
          // greatest(count(*) FILTER (WHERE NOT on_ground), 1) AS INTEGER) AS avg_altitude_ft,
        'online' AS api_status FROM normalized_v""",
    "activity_trend": f"""{ALL_FLIGHTS_LIVE}, m AS (
        SELECT date_trunc('minute', CAST(left(timestamp, 19) AS TIMESTAMP)) AS mi, on_ground, risk_label
        FROM normalized_v)
        SELECT mi AS timestamp, CAST(count(*) AS BIGINT) AS active_aircraft,
          CAST(count(*) FILTER (WHERE {SIGNAL}) AS BIGINT) AS ground_delays
        FROM m WHERE mi >= (SELECT max(mi) FROM m) - INTERVAL 90 MINUTE GROUP BY mi""",
    "delay_histogram": f"""{ALL_FLIGHTS_LIVE}, b AS (SELECT min(predicted_delay_minutes) AS low,
        max(predicted_delay_minutes) AS high FROM normalized_v), n AS (
        SELECT low, high, CASE WHEN high = low THEN 1 ELSE least(18,
          CAST(floor((predicted_delay_minutes - low) / (high - low) * 18) AS BIGINT) + 1) END AS bin
        FROM normalized_v, b)
        SELECT CAST(bin AS BIGINT) AS bin, low + (bin - 1) * ((high - low) / 18e0) AS bin_start,
          count(*) AS flights FROM n GROUP BY bin, low, high""",
    "stream_latest_state": f"""WITH {LATEST},{AIRPORT_TEXTS}
        SELECT s.* EXCLUDE event_id, c.code AS origin_airport_icao_code,
          c.name AS origin_airport_name, c.timezone AS origin_airport_timezone
        FROM latest_v s LEFT JOIN countries_v c ON c.country = s.origin_country, now_v
        WHERE {DAY_OLD}""",
    "stream_history": f"""WITH {STATES},{AIRPORT_TEXTS},{_arriving("states_v")},
        first_v AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY load_order DESC) AS rn
          FROM airports_v) WHERE rn = 1),
        second_v AS (FROM first_v UNION ALL SELECT * REPLACE ('A' || code AS code, 'New ' || name AS name) FROM first_v),
        named_v AS (SELECT 0::BIGINT AS v, country, min(code) AS code, min(name) AS name FROM first_v GROUP BY country
          UNION ALL SELECT 1, country, min(code), min(name) FROM second_v GROUP BY country),
        stored_v AS (SELECT 0::BIGINT AS v, * FROM arrivals_v WHERE arrival = 0 UNION ALL SELECT 1, * FROM arrivals_v WHERE arrival = 1
          UNION ALL SELECT 1, * FROM arrivals_v)
        SELECT s.v AS reference_version, n.code AS origin_airport_icao_code, n.name AS origin_airport_name, count(*) AS states
        FROM stored_v s LEFT JOIN named_v n ON n.v = s.v AND n.country = s.origin_country
        WHERE event_ts::DATE = (SELECT (min(ts) + (max(ts) - min(ts)) / 3)::DATE FROM events) GROUP BY ALL""",
    "stream_density": f"""WITH {STATES},{_arriving("states_v")}
        SELECT date_trunc('minute', event_ts) AS timestamp, origin_country AS region, count(*) AS count,
          count(*) FILTER (WHERE on_ground) AS ground_delay_count, 0::BIGINT AS late
        FROM timely_v WHERE NOT late GROUP BY ALL
        UNION ALL SELECT NULL, NULL, 0, 0, count(*) FROM timely_v WHERE late""",
    "stream_trend": f"""WITH {STATES},{_trip("states_v")},
        placed_v AS (SELECT *, {_label("coalesce(predicted_delay_minutes, 0)")} AS risk_label FROM live_v WHERE latitude IS NOT NULL),
        {_arriving("placed_v")}, m AS (SELECT *, date_trunc('minute', event_ts) AS mi FROM timely_v WHERE NOT late)
        SELECT mi AS timestamp, count(*) AS active_aircraft, count(*) FILTER (WHERE {SIGNAL}) AS ground_delays
        FROM m WHERE mi >= (SELECT max(mi) FROM m) - INTERVAL 43200 MINUTE GROUP BY mi""",
    "stream_scored_by_rule": f"""WITH {STATES}, c AS (SELECT event_id, icao24, iata AS carrier, {CLOCK}
          FROM states_v JOIN {IATA} ON icao = left(callsign, 3)),
        s AS (SELECT *, {_rule(RULE_SLOT)} AS p FROM c)
        SELECT * EXCLUDE p, p AS delay_probability, {PROBABLE} AS risk_label FROM s""",
    "predictions_filled_by_rule": f"""WITH {STATES},{_trip("states_v")},{NORMALIZED}, c AS (
          SELECT icao24, event_id, coalesce(iata, left(callsign, 2)) AS carrier, {CLOCK}
          FROM states_v LEFT JOIN {IATA} ON icao = left(callsign, 3) WHERE latitude IS NOT NULL),
        s AS (SELECT event_id, carrier, {_rule(RULE_SLOT)} AS p FROM c),
        g AS (SELECT *, {_round("p * 60", 1)} AS guess FROM s)
        SELECT n.* EXCLUDE event_id REPLACE (g.carrier AS carrier, guess AS predicted_delay_minutes, {PROBABLE} AS risk_label,
          {_round("greatest(0.02::DOUBLE, least(guess / 60, 1.0::DOUBLE))", 2)} AS delay_risk)
        FROM ({_KEYED}) n JOIN g USING (event_id)""",
}
