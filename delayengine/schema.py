"""Table layouts and the fixed lookup values shared by every module."""

# --- Canonical flights: column -> Spark type, in storage order (fixed values) ---
FLIGHT_TYPES = {
    "FL_DATE": "string",
    "OP_CARRIER": "string",
    "ORIGIN": "string",
    "DEST": "string",
    "CRS_DEP_TIME": "int",
    "DEP_DELAY": "float",
    "ARR_DELAY": "float",
    "CANCELLED": "float",
    "DISTANCE": "float",
    "CARRIER_DELAY": "float",
    "WEATHER_DELAY": "float",
}

# --- Canonical column -> column name in the published CSV files (fixed values) ---
CSV_NAMES = {
    "FL_DATE": "FlightDate",
    "OP_CARRIER": "Reporting_Airline",
    "ORIGIN": "Origin",
    "DEST": "Dest",
    "CRS_DEP_TIME": "CRSDepTime",
    "DEP_DELAY": "DepDelay",
    "ARR_DELAY": "ArrDelay",
    "CANCELLED": "Cancelled",
    "DISTANCE": "Distance",
    "CARRIER_DELAY": "CarrierDelay",
    "WEATHER_DELAY": "WeatherDelay",
}

# A CSV without one of these is refused; the rest come back as typed NULLs.
REQUIRED_FLIGHT_COLUMNS = (
    "FL_DATE", "OP_CARRIER", "ORIGIN", "DEST", "CRS_DEP_TIME",
    "DEP_DELAY", "ARR_DELAY", "CANCELLED",
)

FLIGHT_DDL = ", ".join(f"{name} {kind}" for name, kind in FLIGHT_TYPES.items())

# --- Positions of the fields in one raw state vector, with their types (fixed values) ---
STATE_VECTOR_TYPES = {
    "icao24": "string",
    "callsign": "string",
    "origin_country": "string",
    "time_position": "bigint",
    "last_contact": "bigint",
    "longitude": "float",
    "latitude": "float",
    "baro_altitude": "float",
    "on_ground": "boolean",
    "velocity": "float",
    "true_track": "float",
    "vertical_rate": "float",
    "sensors": "string",
    "geo_altitude": "float",
    "squawk": "string",
    "spi": "boolean",
    "position_source": "int",
}

# The message on the raw topic: what the enrichment needs, plus four optional
# fields the scoring step uses (absent keys simply parse as NULL).
LIVE_STATE_DDL = (
    "icao24 string, callsign string, origin_country string, "
    "longitude float, latitude float, baro_altitude float, velocity float, "
    "true_track float, on_ground boolean, polled_at string, "
    "time_position bigint, last_contact bigint, geo_altitude float, vertical_rate float"
)

FEATURES = ("carrier", "hour_of_day", "day_of_week", "month")
LABEL = "is_delayed"
WEIGHT = "class_weight"

# --- Airline ICAO prefix -> IATA code (fixed values) ---
ICAO_TO_IATA = {
    "AAL": "AA", "DAL": "DL", "UAL": "UA", "SWA": "WN", "JBU": "B6", "ASA": "AS",
    "SKW": "OO", "FFT": "F9", "NKS": "NK", "HAL": "HA", "EDV": "9E", "PDT": "EV",
    "RPA": "YX", "SJI": "S5", "CPZ": "CP", "ACY": "YV", "ENY": "MQ", "GJS": "G4",
    "VXP": "VX", "WJA": "WS", "ACA": "AC", "BAW": "BA", "KLM": "KL", "DLH": "LH",
    "AFR": "AF", "TVF": "TO", "IBE": "IB", "QFA": "QF", "UAE": "EK", "SIA": "SQ",
}

# --- Hub code -> (latitude, longitude) (fixed values) ---
HUB_POSITIONS = {
    "ATL": (33.6407, -84.4277),
    "JFK": (40.6413, -73.7781),
    "LAX": (33.9416, -118.4085),
    "ORD": (41.9742, -87.9073),
    "DFW": (32.8998, -97.0403),
    "SFO": (37.6213, -122.3790),
    "SEA": (47.4502, -122.3088),
    "MIA": (25.7959, -80.2870),
    "DEN": (39.8561, -104.6737),
    "BOS": (42.3656, -71.0096),
}
