"""Tail reads of a written log that open its newest files only."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from undercut.operators.recent import OFFSET, PARTITION, TAIL_SLACK, tail_per_partition
from undercut.sources.manifest import Manifest, Part
from undercut.sources.sinks import read_parts, write_batch

POSITION = (PARTITION, OFFSET)


def append_records(records: DataFrame, path: str, batch_id: int) -> None:
    """One batch of records with their positions, in folders by partition, with the offsets of each file noted."""
    write_batch(records, path, batch_id, by=(PARTITION,), bounds=POSITION)


def _newest(parts: list[Part], limit: int, partitions: int | None) -> tuple[list[Part], int]:
    """Parts cut down to files that the tails reach into, and the number of partitions."""
    last: dict[int | None, int] = {}
    for part in parts:
        for file in part.files:
            number, high = file["high"].get(PARTITION), file["high"].get(OFFSET)
            if high is not None:
                last[number] = max(high, last.get(number, high))
    found = max(len(last), partitions or 1)
    share = math.ceil(limit / found) + TAIL_SLACK

    def reaches(file: dict) -> bool:
        high = file["high"].get(OFFSET)
        return high is not None and high > last[file["high"].get(PARTITION)] - share

    cut = (Part(p.folder, p.batch, tuple(f for f in p.files if reaches(f)), p.info, whole=False) for p in parts)
    return [part for part in cut if part.files], found


def read_tail(
    spark: SparkSession, path: str, schema: T.StructType, limit: int, partitions: int | None = None
) -> DataFrame:
    """``tail_per_partition`` of a log that ``append_records`` wrote.

    The offsets noted by file say where each partition ends, so that only files which the
    last ``ceil(limit / partitions) + 5`` offsets reach into are opened, however long the log is.
    """
    files, found = _newest(Manifest(spark, path).parts(), limit, partitions)
    rows = read_parts(spark, path, files, schema).select(*schema.names)
    return tail_per_partition(rows, limit, found)
