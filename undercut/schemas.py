"""Declared schemas and the fixed values of the telemetry contract.

Nothing is ever inferred: batch and streaming readers both take these types.
"""

from __future__ import annotations

from pyspark.sql import types as T

_STRING, _LONG, _INT = T.StringType(), T.LongType(), T.IntegerType()
_DOUBLE, _BOOL, _TS = T.DoubleType(), T.BooleanType(), T.TimestampType()


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, null) for name, dtype, null in fields])


# Tyre compounds, in contract order.
TIRE_COMPOUNDS = ("SOFT", "MEDIUM", "HARD", "INTER", "WET")

# The four corners, used in the order front-left .. rear-right.
CORNERS = ("fl", "fr", "rl", "rr")

# Hopping window of the metrics table.
WINDOW_SIZE_MS = 30_000
WINDOW_ADVANCE_MS = 10_000

# Topic partition counts.
TOPIC_PARTITIONS = {
    "raw-telemetry": 20,
    "enriched-telemetry": 20,
    "stream-aggregates": 10,
    "pit-predictions": 5,
    "race-outcomes": 5,
    "circuit-metadata": 3,
    "driver-profiles": 5,
    "dlq-telemetry": 3,
}

# Topic retention in milliseconds; compacted topics have none.
RETENTION_MS = {
    "raw-telemetry": 7_200_000,
    "enriched-telemetry": 21_600_000,
    "pit-predictions": 86_400_000,
    "dlq-telemetry": 604_800_000,
}

# Scoring defaults.
PIT_THRESHOLD = 0.65
MODEL_VERSION = "rf-1.0.0"

# Preview defaults.
PREVIEW_DEFAULT_LIMIT = 20
PREVIEW_MAX_LIMIT = 100

# Samples kept per metric series in the history view.
SERIES_HISTORY = 72

# Names and types of the records and tables of the contract, from here to the primary keys.
TELEMETRY = _struct(
    ("car_id", _STRING, False),
    ("driver_id", _STRING, False),
    ("session_id", _STRING, False),
    ("timestamp_ms", _LONG, False),
    ("lap", _INT, False),
    ("sector", _INT, False),
    ("speed_kph", _DOUBLE, False),
    ("rpm", _INT, False),
    ("gear", _INT, False),
    ("throttle_pct", _DOUBLE, False),
    ("brake_pct", _DOUBLE, False),
    ("drs_active", _BOOL, False),
    ("tire_compound", _STRING, False),
    ("tire_temp_fl", _DOUBLE, False),
    ("tire_temp_fr", _DOUBLE, False),
    ("tire_temp_rl", _DOUBLE, False),
    ("tire_temp_rr", _DOUBLE, False),
    ("tire_wear_fl", _DOUBLE, False),
    ("tire_wear_fr", _DOUBLE, False),
    ("tire_wear_rl", _DOUBLE, False),
    ("tire_wear_rr", _DOUBLE, False),
    ("fuel_load_kg", _DOUBLE, False),
    ("engine_temp_c", _DOUBLE, False),
    ("ers_deploy_pct", _DOUBLE, False),
    ("g_force_lat", _DOUBLE, False),
    ("g_force_lon", _DOUBLE, False),
)

ENRICHMENT = _struct(
    ("circuit_name", _STRING, True),
    ("circuit_country", _STRING, True),
    ("circuit_length_km", _DOUBLE, True),
    ("num_laps", _INT, True),
    ("drs_zones", _INT, True),
    ("pit_loss_time_s", _DOUBLE, True),
    ("driver_full_name", _STRING, True),
    ("driver_abbrev", _STRING, True),
    ("driver_team", _STRING, True),
    ("driver_nationality", _STRING, True),
    ("enrichment_ts_ms", _LONG, False),
    ("enriched", _BOOL, False),
)

ENRICHED = T.StructType(TELEMETRY.fields + ENRICHMENT.fields)

AGGREGATES = _struct(
    ("car_id", _STRING, True),
    ("window_start_ms", _LONG, True),
    ("window_end_ms", _LONG, True),
    ("avg_speed_kph", _DOUBLE, True),
    ("max_speed_kph", _DOUBLE, True),
    ("avg_tire_temp_c", _DOUBLE, True),
    ("avg_tire_wear_pct", _DOUBLE, True),
    ("event_count", _LONG, True),
)

PREDICTION = _struct(
    ("car_id", _STRING, False),
    ("timestamp_ms", _LONG, False),
    ("pit_probability", _DOUBLE, False),
    ("recommend_pit", _BOOL, False),
    ("model_version", _STRING, False),
)

DEAD_LETTER = _struct(
    ("key", _STRING, False),
    ("value", _STRING, False),
    ("headers", T.MapType(_STRING, _STRING), False),
)

CIRCUITS = _struct(
    ("circuit_id", _STRING, False),
    ("circuit_name", _STRING, False),
    ("country", _STRING, False),
    ("city", _STRING, True),
    ("length_km", T.DecimalType(6, 3), True),
    ("num_laps", _INT, True),
    ("drs_zones", _INT, True),
    ("pit_loss_time_s", T.DecimalType(5, 2), True),
    ("overtaking_diff", _STRING, True),
    ("created_at", _TS, True),
    ("updated_at", _TS, True),
)

TEAMS = _struct(
    ("team_id", _STRING, False),
    ("team_name", _STRING, False),
    ("power_unit", _STRING, True),
    ("base_country", _STRING, True),
    ("principal", _STRING, True),
)

DRIVERS = _struct(
    ("driver_id", _STRING, False),
    ("full_name", _STRING, False),
    ("abbreviated_name", _STRING, True),
    ("team_id", _STRING, True),
    ("car_number", _INT, True),
    ("nationality", _STRING, True),
    ("championships", _INT, True),
    ("race_wins", _INT, True),
)

REGULATIONS = _struct(
    ("regulation_id", _STRING, False),
    ("season", _INT, True),
    ("max_fuel_load_kg", T.DecimalType(5, 2), True),
    ("min_weight_kg", T.DecimalType(6, 2), True),
    ("drs_activation_gap_s", T.DecimalType(4, 2), True),
    ("mandatory_compounds", _INT, True),
    ("pit_lane_speed_limit_kph", _INT, True),
    ("fastest_lap_bonus_point", _BOOL, True),
)

REFERENCE_TABLES = {
    "circuits": CIRCUITS,
    "teams": TEAMS,
    "drivers": DRIVERS,
    "regulations": REGULATIONS,
}

PRIMARY_KEY = {
    "circuits": "circuit_id",
    "teams": "team_id",
    "drivers": "driver_id",
    "regulations": "regulation_id",
}


def changes_schema(table: T.StructType) -> T.StructType:
    """Change-record envelope around the rows of one table."""
    after = T.StructType([T.StructField(f.name, f.dataType, True) for f in table.fields])
    return _struct(
        ("op", _STRING, True),
        ("seq", _LONG, False),
        ("source_table", _STRING, False),
        ("key", _STRING, False),
        ("after", after, True),
    )

# The end of the year 9999: the latest event time that timestamps of all parts can hold.
MAX_TIME_MS = 253_402_300_799_999
