"""Placement of records by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from undercut.functions.ids import key_partition
from undercut.operators.recent import PARTITION


def place(df: DataFrame, key: str, partitions: int, seed: int | None = None) -> DataFrame:
    """Attach the partition number of the key."""
    return df.withColumn(PARTITION, key_partition(F.col(key), partitions, seed))


def write_placed(df: DataFrame, path: str, key: str, partitions: int, mode: str = "append") -> None:
    """Write one folder per partition number.

    The rebalance hint lets adaptive execution split a hot partition over several
    tasks and files of its folder, and merge small ones.
    """
    place(df, key, partitions).hint("rebalance", PARTITION).write.mode(mode).partitionBy(PARTITION).parquet(path)
