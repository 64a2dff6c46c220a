"""Settings of streaming jobs."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# A folder per micro-batch: a file sink wants batches of some size.
DEFAULT_TRIGGER = {"processingTime": "10 seconds"}
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def session_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings in force while a streaming query is started, which copies them."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def state_settings(spark: SparkSession, partitions: int | None = None):
    """State kept in RocksDB, in a number of partitions fixed for the checkpoint's life."""
    chosen = {"spark.sql.streaming.stateStore.providerClass": STATE_STORE}
    if partitions is not None:
        chosen["spark.sql.shuffle.partitions"] = str(partitions)
    return session_settings(spark, chosen)
