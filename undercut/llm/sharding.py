"""Contiguous shards of nearly equal bytes, cut on global prefix sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from undercut.shared import materialise


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the partition they are in and the rows and bytes before them there."""
    part, rows, total = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        size = batch.column("size").to_numpy()
        ends = total + np.cumsum(size)
        extra = [
            pa.array(np.full(batch.num_rows, part, np.int32)),
            pa.array(np.arange(rows, rows + batch.num_rows, dtype=np.int64)),
            pa.array(ends - size),
        ]
        yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "part", "part_row", "part_byte"])
        rows += batch.num_rows
        total = int(ends[-1]) if len(ends) else total


def shard_by_bytes(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Every row's shard from 0 to ``shards - 1`` and its place (``slot``) in there.

    A row weighs the UTF-8 bytes of its text plus one. Rows are laid out in the order of
    doc_id (null first), checksum and size; the total is cut at equal targets and a row
    belongs to the shard its middle falls in, so a shard misses its target by one row at
    most. Only ids, sizes and checksums move. The running sums are taken within range
    partitions and lifted by the totals of the partitions before, of which there is one
    row per partition.

    A null text counts as empty. Repeated rows all get a place; equal ones in any order,
    spread over partitions by a tie-break on the row's position in the input. An empty
    table gives no rows. Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("tie"),
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("size"), F.col("tie")]
    ordered = sized.repartitionByRange(*order).sortWithinPartitions(*order)
    types = dict(sized.dtypes)
    columns = "".join(f"{name} {types[name]}, " for name in sized.columns)
    placed = materialise(
        ordered.mapInArrow(_running, f"{columns}part int, part_row long, part_byte long").drop("tie"), "shards"
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("byte_offset"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("row_offset"),
        F.sum("bytes").over(Window.partitionBy()).alias("total"),
    )
    # A row for each partition, so at most as many as the shuffle has partitions.
    laid = placed.join(F.broadcast(offsets), "part")
    middle = 2 * (F.col("byte_offset") + F.col("part_byte")) + F.col("size")
    cut = F.floor(middle * F.lit(shards) / (2 * F.col("total"))).cast("int")
    laid = laid.select(
        "doc_id",
        "size",
        "text_crc32",
        F.least(cut, F.lit(shards - 1)).alias("shard"),
        (F.col("row_offset") + F.col("part_row")).alias("row"),
    )
    first = laid.groupBy("shard").agg(F.min("row").alias("first_row"))  # a row for each shard
    return laid.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first_row")).alias("slot")
    )
