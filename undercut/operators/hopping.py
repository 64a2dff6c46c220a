"""Event time and hopping-window metrics per car."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from undercut.functions.numeric import corner_sum
from undercut.schemas import AGGREGATES, MAX_TIME_MS, WINDOW_ADVANCE_MS, WINDOW_SIZE_MS


def events_with_time(events: DataFrame, column: str = "timestamp_ms") -> DataFrame:
    """Add ``event_time``; records with a negative, missing or impossible time are dropped.

    Validation names the same records invalid, so that they are counted as dead letters.
    """
    return events.where(F.col(column).between(0, MAX_TIME_MS)).withColumn("event_time", F.timestamp_millis(F.col(column)))


def _readings(events: DataFrame) -> DataFrame:
    return events.where("enriched").withColumns(
        {
            "_speed": F.col("speed_kph"),
            "_temp": corner_sum("tire_temp") / 4.0,
            "_wear": corner_sum("tire_wear") / 4.0,
        }
    )


def hop_metrics(
    enriched: DataFrame, size_ms: int = WINDOW_SIZE_MS, advance_ms: int = WINDOW_ADVANCE_MS
) -> DataFrame:
    """Batch form: aggregate once per advance step, then add up the steps of a window.

    Raw rows are not multiplied by size/advance as ``window()`` would do: they are
    reduced to one row per car and step before the shuffle, and only those partial
    rows are spread over the windows they belong to. A hot car therefore costs its
    map tasks no more than any other. Windows that start before the epoch are dropped.
    """
    if size_ms % advance_ms:
        raise ValueError("window size must be a multiple of the advance")
    step = F.col("timestamp_ms") - F.pmod("timestamp_ms", F.lit(advance_ms))
    steps = (
        _readings(enriched)
        .where(F.col("timestamp_ms").between(0, MAX_TIME_MS))
        .groupBy("car_id", step.alias("_step"))
        .agg(
            F.max("_speed").alias("max_speed"),
            F.count("*").alias("n"),
            *[F.sum(f"_{m}").alias(f"sum_{m}") for m in ("speed", "temp", "wear")],
            *[F.count(f"_{m}").alias(f"n_{m}") for m in ("speed", "temp", "wear")],
        )
    )
    starts = F.array(*[F.col("_step") - back for back in range(0, size_ms, advance_ms)])
    total = {m: F.sum(f"sum_{m}") / F.sum(f"n_{m}") for m in ("speed", "temp", "wear")}
    return (
        steps.withColumn("window_start_ms", F.explode(starts))
        .where(F.col("window_start_ms") >= 0)
        .groupBy("car_id", "window_start_ms")
        .agg(
            total["speed"].alias("avg_speed_kph"),
            F.max("max_speed").alias("max_speed_kph"),
            total["temp"].alias("avg_tire_temp_c"),
            total["wear"].alias("avg_tire_wear_pct"),
            F.sum("n").alias("event_count"),
        )
        .withColumn("window_end_ms", F.col("window_start_ms") + size_ms)
        .select(*AGGREGATES.names)
    )


def hop_metrics_stream(
    enriched: DataFrame,
    size_ms: int = WINDOW_SIZE_MS,
    advance_ms: int = WINDOW_ADVANCE_MS,
    lateness: str = "24 hours",
) -> DataFrame:
    """Streaming form, for update mode: one stateful ``window()`` aggregation."""
    span = F.window("event_time", f"{size_ms} milliseconds", f"{advance_ms} milliseconds")
    return (
        _readings(events_with_time(enriched))
        .withWatermark("event_time", lateness)
        .groupBy("car_id", span)
        .agg(
            F.avg("_speed").alias("avg_speed_kph"),
            F.max("_speed").alias("max_speed_kph"),
            F.avg("_temp").alias("avg_tire_temp_c"),
            F.avg("_wear").alias("avg_tire_wear_pct"),
            F.count("*").alias("event_count"),
        )
        .withColumn("window_start_ms", F.unix_millis("window.start"))
        .withColumn("window_end_ms", F.unix_millis("window.end"))
        .where(F.col("window_start_ms") >= 0)
        .select(*AGGREGATES.names)
    )
