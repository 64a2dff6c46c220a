"""Event readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from undercut.schemas import TELEMETRY


def read_events(
    spark: SparkSession,
    path: str,
    schema: T.StructType = TELEMETRY,
    fmt: str = "parquet",
    streaming: bool = False,
    files_per_batch: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Typed events from a folder of parquet or JSON files.

    A stream starts at the earliest file of the folder and ``files_per_batch`` is its
    rate limit. ``glob`` picks files by name.
    """
    reader = (spark.readStream if streaming else spark.read).schema(schema).format(fmt)
    if fmt == "json":
        reader = reader.option("mode", "PERMISSIVE")
    if streaming and files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)
