"""Streaming split into valid events and dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from undercut.operators.quality import quarantined, to_dead_letter, valid, validate_events
from undercut.sources.sinks import write_batch
from undercut.streaming.settings import DEFAULT_TRIGGER


def start_quarantine(
    events: DataFrame,
    valid_path: str,
    dead_path: str,
    checkpoint: str,
    topic: str = "raw-telemetry",
    name: str = "quarantine",
    as_of_ms: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write good events to ``valid_path`` and the others as dead letters."""
    record = F.to_json(F.struct(*events.columns))

    def run(batch: DataFrame, batch_id: int) -> None:
        checked = validate_events(batch).persist()
        try:
            write_batch(valid(checked), valid_path, batch_id)
            bad = quarantined(checked)
            letters = to_dead_letter(bad, F.col("reason"), topic, record=record, as_of_ms=as_of_ms)
            write_batch(letters, dead_path, batch_id)
        finally:
            checked.unpersist()

    return (
        events.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or DEFAULT_TRIGGER))
        .foreachBatch(run)
        .start()
    )
