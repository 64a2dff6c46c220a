"""Change logs and the dimensions kept up to date from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from undercut.operators.cdc import compact_changes, latest_by_key, route_topic, unwrap_changes
from undercut.schemas import changes_schema
from undercut.sources.manifest import Manifest
from undercut.sources.sinks import read_parts, write_batch


def read_changes(
    spark: SparkSession, path: str, table: T.StructType, fmt: str = "parquet", streaming: bool = False
) -> DataFrame:
    """Snapshot rows (``op = r``) and later changes of one table."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(changes_schema(table)).format(fmt).load(path)


def read_dimension(spark: SparkSession, path: str, table: T.StructType, key: str, fmt: str = "parquet") -> DataFrame:
    """Latest row per key of a change log.

    Every call lists the folder again, so a caller that wants fresh values calls it
    once per batch.
    """
    return latest_by_key(unwrap_changes(read_changes(spark, path, table, fmt), key), key)


def write_routed(changes: DataFrame, path: str, batch_id: int) -> None:
    """One batch of change records, laid out by the topic each is routed to."""
    write_batch(changes.withColumn("topic", route_topic(F.col("source_table"))), path, batch_id, by=("topic",))


def dimension_version(spark: SparkSession, path: str, snapshots: str) -> dict:
    """The newest snapshot of a routed log and the last batch of changes: what a dimension is read as of."""
    return {"snapshot": Manifest(spark, snapshots).last(), "through": Manifest(spark, path).last()}


def _changes_as_of(spark: SparkSession, path: str, snapshots: str, table: T.StructType, topic: str, version: dict) -> DataFrame:
    """A snapshot and the changes of the batches after it, up to a version's last."""
    taken, through = version["snapshot"], version["through"]
    schema = changes_schema(table)
    routed = T.StructType([*schema.fields, T.StructField("topic", T.StringType())])
    newer = [] if through is None else Manifest(spark, path).after(-1 if taken is None else taken)
    newer = [part for part in newer if part.batch <= through]
    found = read_parts(spark, path, newer, routed).where(F.col("topic") == topic).drop("topic", "batch_id")
    if taken is None:
        return found
    base = [part for part in Manifest(spark, snapshots).after(taken - 1) if part.batch == taken]
    return read_parts(spark, snapshots, base, schema).drop("batch_id").unionByName(found)


def take_snapshot(spark: SparkSession, path: str, snapshots: str, table: T.StructType, topic: str) -> None:
    """Compact a topic's routed log: the newest change of each key, as of its last committed batch.

    It reads the snapshot before and the batches since, not the whole history.
    """
    version = dimension_version(spark, path, snapshots)
    if version["through"] is not None:
        rows = compact_changes(_changes_as_of(spark, path, snapshots, table, topic, version))
        write_batch(rows, snapshots, version["through"])


def read_routed_dimension(
    spark: SparkSession, path: str, snapshots: str, table: T.StructType, topic: str, key: str, version: dict | None = None
) -> DataFrame:
    """Latest row per key of a topic, from its newest snapshot and the changes since, or as of a version.

    Meant to be called once per micro-batch: files of the dimension and of the newest changes
    are read, and of the log's list its state and the batches behind the snapshot.
    """
    version = dimension_version(spark, path, snapshots) if version is None else version
    return latest_by_key(unwrap_changes(_changes_as_of(spark, path, snapshots, table, topic, version), key), key)
