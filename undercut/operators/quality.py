"""Validation, quarantine, dead letters and clean numbers."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from undercut.functions.numeric import finite_deep, has_float, quantise2
from undercut.functions.text import truncate
from undercut.schemas import MAX_TIME_MS, TELEMETRY, TIRE_COMPOUNDS

# Valid range of every measured column; None is an open end.
RANGES = {
    "timestamp_ms": (0, MAX_TIME_MS),
    "lap": (1, None),
    "sector": (1, 3),
    "speed_kph": (0, 400),
    "rpm": (0, None),
    "gear": (0, 8),
    "throttle_pct": (0, 100),
    "brake_pct": (0, 100),
    "tire_temp_fl": (0, 200),
    "tire_temp_fr": (0, 200),
    "tire_temp_rl": (0, 200),
    "tire_temp_rr": (0, 200),
    "tire_wear_fl": (0, 100),
    "tire_wear_fr": (0, 100),
    "tire_wear_rl": (0, 100),
    "tire_wear_rr": (0, 100),
    "fuel_load_kg": (0, 120),
    "engine_temp_c": (0, 200),
    "ers_deploy_pct": (0, 100),
    "g_force_lat": (-10, 10),
    "g_force_lon": (-10, 10),
}

# Columns rounded to two decimals before publishing.
QUANTISED = (
    "speed_kph",
    "throttle_pct",
    "brake_pct",
    "tire_temp_fl",
    "tire_temp_fr",
    "tire_temp_rl",
    "tire_temp_rr",
    "tire_wear_fl",
    "tire_wear_fr",
    "tire_wear_rl",
    "tire_wear_rr",
    "fuel_load_kg",
    "engine_temp_c",
    "ers_deploy_pct",
    "g_force_lat",
    "g_force_lon",
)


def _rule(column: str) -> Column:
    """Condition that a valid value meets. It is null for null; NaN exceeds any bound."""
    value = F.col(column)
    if column in RANGES:
        low, high = RANGES[column]
        return value >= low if high is None else value.between(low, high)
    if column == "tire_compound":
        return value.isin(*TIRE_COMPOUNDS)
    if column == "drs_active":
        return value.isNotNull()
    return F.trim(value) != ""


def validate_events(events: DataFrame, columns: Iterable[str] = TELEMETRY.names) -> DataFrame:
    """Add ``is_valid`` and ``violations`` (names of bad columns).

    The flag is a plain conjunction, so filters and counts on it never build the
    array of names.
    """
    rules = {c: _rule(c) for c in columns}
    failed = F.array_compact(F.array(*[F.when(ok, None).otherwise(F.lit(c)) for c, ok in rules.items()]))
    flag = F.coalesce(reduce(and_, rules.values()), F.lit(False))
    return events.withColumns({"is_valid": flag, "violations": failed})


def valid(checked: DataFrame) -> DataFrame:
    return checked.where("is_valid").drop("violations", "is_valid")


def quarantined(checked: DataFrame) -> DataFrame:
    """Invalid rows with their reasons as one text."""
    return checked.where(~F.col("is_valid")).withColumn("reason", F.array_join("violations", ","))


def to_dead_letter(
    failed: DataFrame,
    reason: Column,
    topic: str,
    exception_class: str = "ValidationError",
    record: Column | None = None,
    as_of_ms: int | None = None,
) -> DataFrame:
    """Key, value and five diagnostic headers.

    ``record`` is the failed record as text; without one the value only tells that
    an asynchronous failure happened.
    """
    key = F.coalesce(F.col("car_id"), F.lit("UNKNOWN"))
    stamp = F.unix_millis(F.current_timestamp()) if as_of_ms is None else F.lit(as_of_ms)
    if record is None:
        value = F.concat(F.lit("async-failure:"), F.coalesce(reason, F.lit("null")))
    else:
        value = F.coalesce(record, F.lit("null-value"))
    # The names of the headers, and the two texts that stand in for a value above.
    headers = F.create_map(
        F.lit("X-Error-Message"), truncate(reason),
        F.lit("X-Original-Topic"), F.lit(topic),
        F.lit("X-Error-Timestamp"), stamp.cast("string"),
        F.lit("X-Exception-Class"), F.lit(exception_class),
        F.lit("X-Original-Car-Id"), key,
    )
    return failed.select(key.alias("key"), value.alias("value"), headers.alias("headers"))


def quantise_sensors(events: DataFrame, columns: Iterable[str] = QUANTISED) -> DataFrame:
    return events.withColumns({c: quantise2(F.col(c)) for c in columns})


def sanitize_numeric(df: DataFrame) -> DataFrame:
    """NaN and infinities become null, also inside arrays, maps and structs."""
    changed = {f.name: finite_deep(F.col(f.name), f.dataType) for f in df.schema.fields if has_float(f.dataType)}
    return df.withColumns(changed) if changed else df
