"""A table kept up to date with a change log, rewriting only the buckets that changes touch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from undercut.operators.cdc import after_snapshot, compact_changes
from undercut.sources.manifest import Manifest, Part
from undercut.sources.sinks import read_parts, write_part

BUCKETS = 16


def _bucket_of(file: dict) -> int:
    return int(file["path"].partition("bucket=")[2].partition("/")[0])


def merge_changes(
    spark: SparkSession, path: str, changes: DataFrame, table: T.StructType, key: str, buckets: int = BUCKETS
) -> list[int]:
    """Apply the changes behind the table's position; the buckets that were rewritten.

    The first call loads the snapshot rows and the changes after them. The position, the
    greatest sequence number applied, is part of the generation that names the new files:
    both take effect in one step, so that a repeat applies nothing twice, and a log that
    is read from its start again leaves no gap. Buckets without a change keep their files.
    """
    manifest = Manifest(spark, path)
    parts = manifest.parts()
    position = max((part.info["position"] for part in parts), default=None)
    fresh = after_snapshot(changes) if position is None else changes.where(F.col("seq") > position)
    newest = compact_changes(fresh.where(F.col("key").isNotNull()))
    newest = newest.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))
    found = newest.groupBy("bucket").agg(F.max("seq").alias("last")).collect()  # a row for each bucket
    if not found:
        return []
    touched = {row["bucket"] for row in found}
    schema = T.StructType([*table.fields, T.StructField("bucket", T.IntegerType())])
    old = [
        Part(p.folder, p.batch, tuple(f for f in p.files if _bucket_of(f) in touched), p.info, whole=False) for p in parts
    ]
    rows = read_parts(spark, path, [part for part in old if part.files], schema).drop("batch_id")
    kept = rows.join(newest.select(F.col("key").alias("_key")), rows[key].cast("string") == F.col("_key"), "left_anti")
    live = newest.where("op is not null and op <> 'd'").select(*(F.col("after")[name].alias(name) for name in table.names), "bucket")
    number = max((part.batch for part in parts), default=-1) + 1
    info = {"position": max(row["last"] for row in found)}
    made = write_part(kept.select(*schema.names).unionByName(live), path, number, "parquet", info, by=("bucket",))

    def change(now: list[Part]) -> list[Part] | None:
        if now != parts:
            return None
        left = [Part(p.folder, p.batch, tuple(f for f in p.files if _bucket_of(f) not in touched), p.info, whole=False) for p in now]
        # A part without files is kept where it holds the position.
        return [*(part for part in left if part.files), made]

    if not manifest.replaced(change):
        raise RuntimeError(f"another merge into {path} was faster")
    return sorted(touched)


def read_merged(spark: SparkSession, path: str, table: T.StructType) -> DataFrame:
    """The table as of its newest generation."""
    schema = T.StructType([*table.fields, T.StructField("bucket", T.IntegerType())])
    return read_parts(spark, path, [p for p in Manifest(spark, path).parts() if p.files], schema).select(*table.names)
