"""Pit-stop features, labels and decisions."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from undercut.functions.numeric import clip01, corner_sum
from undercut.schemas import MODEL_VERSION, PIT_THRESHOLD

# Feature order and the scale each reading is divided by.
FEATURES = ("wear", "temp", "fuel", "speed", "ers", "lap")
SCALES = {"wear": 4.0 * 100.0, "temp": 4.0 * 150.0, "fuel": 120.0, "speed": 380.0, "ers": 100.0, "lap": 100.0}
LAP_CAP = 100

TRAINING_PARTITIONS = 8

# The labelling rule of the training table.
WEAR_HIGH, WEAR_MID, FUEL_LOW = 0.72, 0.52, 0.28


def feature_columns() -> dict[str, Column]:
    """The six features; null where an input is missing or not a number."""
    lap = F.col("lap").cast("double")
    readings = {
        "wear": corner_sum("tire_wear"),
        "temp": corner_sum("tire_temp"),
        "fuel": F.col("fuel_load_kg").cast("double"),
        "speed": F.col("speed_kph").cast("double"),
        "ers": F.col("ers_deploy_pct").cast("double"),
        "lap": F.when(lap > LAP_CAP, float(LAP_CAP)).otherwise(lap),
    }
    return {name: clip01(readings[name] / SCALES[name]) for name in FEATURES}


def has_features() -> Column:
    """True where an event can be scored."""
    present = [c.isNotNull() for c in feature_columns().values()]
    return reduce(and_, present, F.col("timestamp_ms").isNotNull())


def pit_features(events: DataFrame) -> DataFrame:
    """Events that can be scored, with their features."""
    return events.where(has_features()).withColumns(feature_columns())


def label_rule(wear: Column, fuel: Column) -> Column:
    """1 for high wear, or for middling wear with little fuel."""
    return ((wear > WEAR_HIGH) | ((wear > WEAR_MID) & (fuel < FUEL_LOW))).cast("int")


def training_table(spark: SparkSession, rows: int = 10_000, seed: int = 42) -> DataFrame:
    """Uniform random features with rule labels; a fixed number of partitions makes the rows the same anywhere."""
    drawn = spark.range(0, rows, 1, TRAINING_PARTITIONS).select(*[F.rand(seed + i).alias(name) for i, name in enumerate(FEATURES)])
    return drawn.withColumn("label", label_rule(F.col("wear"), F.col("fuel")))


def recommend_pit(probability: Column, threshold: float = PIT_THRESHOLD) -> Column:
    return probability >= F.lit(threshold)


def prediction_rows(
    scored: DataFrame, threshold: float = PIT_THRESHOLD, version: str = MODEL_VERSION, keep: tuple[str, ...] = ()
) -> DataFrame:
    """The five prediction columns from events with ``pit_probability``, after any to keep."""
    return scored.select(
        *keep,
        "car_id",
        "timestamp_ms",
        "pit_probability",
        recommend_pit(F.col("pit_probability"), threshold).alias("recommend_pit"),
        F.lit(version).alias("model_version"),
    )
