"""Streaming enrichment with dimensions as of each micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from undercut.operators.enrich import enrich
from undercut.operators.quality import quarantined, to_dead_letter, valid, validate_events
from undercut.schemas import ENRICHED
from undercut.sources.manifest import Manifest
from undercut.sources.sinks import read_batches, with_event_date, write_batch
from undercut.streaming.settings import DEFAULT_TRIGGER

Dimensions = Callable[..., tuple[DataFrame, DataFrame]]

ENRICHED_LAYOUT = T.StructType(
    [*ENRICHED.fields, T.StructField("batch_id", T.LongType()), T.StructField("event_date", T.DateType())]
)


def start_enrichment(
    events: DataFrame,
    dimensions: Dimensions,
    path: str,
    checkpoint: str,
    name: str = "enrichment",
    as_of_ms: int | None = None,
    require: str = "any",
    trigger: dict | None = None,
    dead_path: str | None = None,
    topic: str = "raw-telemetry",
    versions: Callable[[SparkSession], dict] | None = None,
) -> StreamingQuery:
    """Enrich a stream of events into ``path``.

    With ``dead_path`` the events that validation rejects go there as dead letters, with
    their reasons, and only the others are enriched: no record ends the stream.

    ``dimensions`` is called once per micro-batch and reads circuits and drivers anew:
    a batch joins their latest values, and rows written earlier are not revised. A
    plain stream-static join would keep the file listing of its start for ever. With
    ``versions`` it is also given what that returned when the batch was first tried
    (snapshots and last changes, as numbers): a repeat joins the values of the first try,
    whatever has changed since, and the batch's entry in the sink's list names them.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, sink = batch.sparkSession, Manifest(batch.sparkSession, path)
        if sink.is_committed(batch_id) and dead_path is None:
            return
        chosen = () if versions is None else (sink.decided(batch_id, lambda: versions(spark)),)
        circuits, drivers = dimensions(spark, *chosen)
        info = {"dimensions": chosen[0]} if chosen else {}

        def write(kept: DataFrame) -> None:
            enriched = with_event_date(enrich(kept, circuits, drivers, as_of_ms, require))
            write_batch(enriched, path, batch_id, by=("event_date",), bounds=("timestamp_ms",), info=info)

        if dead_path is None:
            write(batch)
            return
        checked = validate_events(batch).persist()
        try:
            record = F.to_json(F.struct(*batch.columns))
            letters = to_dead_letter(quarantined(checked), F.col("reason"), topic, record=record, as_of_ms=as_of_ms)
            write_batch(letters, dead_path, batch_id)
            write(valid(checked))
        finally:
            checked.unpersist()

    return (
        events.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or DEFAULT_TRIGGER))
        .foreachBatch(run)
        .start()
    )


def read_enriched(
    spark: SparkSession, path: str, streaming: bool = False, extra: tuple[T.StructField, ...] = ()
) -> DataFrame:
    """The enriched table, from its first batch on.

    A batch read resolves the sink's list. A stream sees a batch's folder when it is moved
    into place as a whole, after it was committed.
    """
    schema = T.StructType([*extra, *ENRICHED_LAYOUT.fields])
    if streaming:
        return spark.readStream.schema(schema).parquet(path)
    fields = [field for field in schema.fields if field.name != "batch_id"]
    return read_batches(spark, path, T.StructType(fields)).select(*schema.names)
