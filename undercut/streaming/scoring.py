"""Streaming pit scoring with counters."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from undercut.operators.features import prediction_rows
from undercut.operators.metrics import scoring_counter_columns
from undercut.operators.model import score
from undercut.schemas import MODEL_VERSION, PIT_THRESHOLD, PREDICTION
from undercut.sources.manifest import Manifest
from undercut.sources.sinks import read_batches, write_batch
from undercut.streaming.settings import DEFAULT_TRIGGER


def start_scoring(
    events: DataFrame,
    model: PipelineModel,
    path: str,
    checkpoint: str,
    name: str = "pit_scoring",
    threshold: float = PIT_THRESHOLD,
    version: str = MODEL_VERSION,
    trigger: dict | None = None,
    clock: Callable[[], float] = time.time,
) -> StreamingQuery:
    """Score a stream of events into prediction rows.

    Events that cannot be scored are counted as errors and skipped. What a batch consumed,
    emitted and failed on is counted as it is written and stands in its entry of the sink's
    list: counts and rows are committed in one step, and outlast the driver.
    """
    if "decoded" not in events.columns:
        events = events.withColumn("decoded", F.lit(True))

    def run(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        counted = batch.observe(seen, *[c.alias(n) for n, c in scoring_counter_columns().items()])
        scored = prediction_rows(score(counted.where("decoded"), model), threshold, version)
        write_batch(
            scored, path, batch_id, bounds=("timestamp_ms",), info=lambda: {"counts": seen.get, "at_ms": int(clock() * 1000)}
        )

    return (
        events.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or DEFAULT_TRIGGER))
        .foreachBatch(run)
        .start()
    )


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """The predictions of committed batches."""
    return read_batches(spark, path, PREDICTION).select(*PREDICTION.names)


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """What committed batches counted: (series, batch_id, ts, count, value), ``value`` as running totals.

    In the shape that rates and latest values of series are taken from.
    """
    rows, totals = [], {}
    for part in Manifest(spark, path).parts():
        for name, n in part.info.get("counts", {}).items():
            totals[name] = totals.get(name, 0) + n
            rows.append((name, part.batch, part.info["at_ms"], n, float(totals[name])))
    found = spark.createDataFrame(rows, "series string, batch_id long, at_ms long, count long, value double")
    return found.select("series", "batch_id", F.timestamp_millis("at_ms").cast("timestamp_ntz").alias("ts"), "count", "value")
