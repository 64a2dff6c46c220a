"""Streaming window metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from undercut.operators.hopping import hop_metrics_stream
from undercut.schemas import AGGREGATES, WINDOW_ADVANCE_MS, WINDOW_SIZE_MS
from undercut.sources.manifest import Manifest, Part
from undercut.sources.sinks import WINDOW_BOUNDS, read_parts, write_aggregates, write_part
from undercut.streaming.settings import DEFAULT_TRIGGER, state_settings


def start_aggregation(
    enriched: DataFrame,
    path: str,
    checkpoint: str,
    name: str = "aggregate_metrics",
    size_ms: int = WINDOW_SIZE_MS,
    advance_ms: int = WINDOW_ADVANCE_MS,
    lateness: str = "24 hours",
    trigger: dict | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Hopping metrics over a stream, each change of a window emitted as a JSON row.

    Runs as its own query over the enriched table. ``lateness`` bounds the state:
    windows older than the newest event by more are dropped from it.
    """
    metrics = hop_metrics_stream(enriched, size_ms, advance_ms, lateness)
    with state_settings(enriched.sparkSession, state_partitions):
        return (
            metrics.writeStream.queryName(name)
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or DEFAULT_TRIGGER))
            .foreachBatch(lambda batch, batch_id: write_aggregates(batch, path, batch_id))
            .start()
        )


def _newest(rows: DataFrame) -> DataFrame:
    """Of each window the emission of the latest batch."""
    keys = ["car_id", "window_start_ms"]
    rest = [c for c in AGGREGATES.names if c not in keys]
    found = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("row"))
    return found.select(*keys, "row.*").select(*AGGREGATES.names)


def _is_closed(part: Part) -> bool:
    return part.info.get("closed", False)


def read_aggregates(spark: SparkSession, path: str) -> DataFrame:
    """Current value of every window: the one of its latest batch.

    Windows that were folded as closed have one row and are read as they are; only the
    open ones and the batches since are compared.
    """
    parts = Manifest(spark, path).parts()
    closed = read_parts(spark, path, filter(_is_closed, parts), AGGREGATES, "json").drop("batch_id")
    rest = read_parts(spark, path, [part for part in parts if not _is_closed(part)], AGGREGATES, "json")
    return closed.unionByName(_newest(rest))


def fold_aggregates(spark: SparkSession, path: str, lateness_ms: int) -> int | None:
    """Keep one row of each window instead of all its emissions; the bound below which windows are closed.

    A window that ended ``lateness_ms`` before the newest one seen gets no further emission,
    as the stream's state has dropped it: it is written once, and later foldings leave it
    alone. The newest emissions of open windows are written anew. Readers take all of
    this up at once, with the new generation of the sink's list; batches that the stream
    commits meanwhile are not touched. None, and no change, where nothing is new or another
    folding was faster.
    """
    manifest = Manifest(spark, path)
    parts = manifest.parts()
    fresh = [part for part in parts if not _is_closed(part)]
    seen = [file["high"].get("window_start_ms") for part in parts for file in part.files]
    seen = [start for start in seen if start is not None]
    if not any(part.folder.startswith("batch_id=") for part in fresh) or not seen:
        return None
    bound, last = max(seen) - lateness_ms, max(part.batch for part in parts)
    rows = _newest(read_parts(spark, path, fresh, AGGREGATES, "json"))
    is_over = F.col("window_end_ms") <= bound
    made = [
        write_part(rows.where(is_over), path, last, "json", {"closed": True}, WINDOW_BOUNDS),
        write_part(rows.where(~is_over), path, last, "json", {}, WINDOW_BOUNDS),
    ]

    def change(live: list[Part]) -> list[Part] | None:
        # Batches committed since the rows were read stay; other upkeep since then wins.
        if any(part not in live for part in fresh):
            return None
        return [*(part for part in live if part not in fresh), *made]

    return bound if manifest.replaced(change) else None
