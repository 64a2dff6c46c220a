"""Change records: unwrap, route, latest value per key, retention."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from undercut.functions.text import epoch_day

# Source-table pattern and the topic it is routed to.
ROUTES = {
    r"[^.]+\.public\.circuits": "circuit-metadata",
    r"[^.]+\.public\.drivers": "driver-profiles",
}


def snapshot_changes(table: DataFrame, key: str, source_table: str, seq: int = 0) -> DataFrame:
    """A table's rows as read-operations, the first part of a change log."""
    return table.select(
        F.lit("r").alias("op"),
        F.lit(seq).cast("long").alias("seq"),
        F.lit(source_table).alias("source_table"),
        F.col(key).cast("string").alias("key"),
        F.struct(*table.columns).alias("after"),
    )


def unwrap_changes(changes: DataFrame, key: str) -> DataFrame:
    """Flatten the after-image, keyed by ``key``.

    A delete keeps its key and reads ``__deleted = true``. A tombstone (no
    operation) passes with null in every value column, ``__deleted`` included.
    """
    after = changes.schema["after"].dataType
    key_type = after[key].dataType.simpleString()
    values = [F.col("after")[name].alias(name) for name in after.names if name != key]
    return changes.select(
        F.coalesce(F.col("after")[key], F.col("key").cast(key_type)).alias(key),
        *values,
        "seq",
        "source_table",
        (F.col("op") == "d").alias("__deleted"),
    )


def latest_by_key(rows: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """Newest row per key, keys whose newest row is a delete or tombstone removed.

    ``max_by`` is combined before the shuffle, so a hot key costs one row per task.
    """
    rest = [c for c in rows.columns if c not in (key, seq, "source_table", "__deleted")]
    image = F.struct(*rest, "__deleted")
    newest = rows.groupBy(key).agg(F.max_by(image, F.col(seq)).alias("row"))
    return newest.where(~F.col("row.__deleted")).select(key, *[F.col("row")[c].alias(c) for c in rest])


def compact_changes(changes: DataFrame) -> DataFrame:
    """Newest change record per key, deletes and tombstones among them.

    The result is a change log with the same latest values. A job that reads a
    dimension often reads this and the changes since, not the whole history.
    """
    rest = [c for c in changes.columns if c not in ("key", "seq")]
    newest = changes.groupBy("key").agg(
        F.max("seq").alias("seq"), F.max_by(F.struct(*rest), F.col("seq")).alias("row")
    )
    return newest.select(*[c if c in ("key", "seq") else F.col("row")[c].alias(c) for c in changes.columns])


def after_snapshot(changes: DataFrame) -> DataFrame:
    """Snapshot rows and the changes behind their position in the log.

    A snapshot row's ``seq`` is the position the table was read at; a change up to there is
    in the snapshot already. Without snapshot rows all changes count.
    """
    position = changes.where(F.col("op") == "r").agg(F.max("seq")).scalar()
    return changes.where(F.col("op").eqNullSafe("r") | (F.col("seq") > F.coalesce(position, F.lit(-(2**63)))))


def route_topic(source_table: Column, routes: Mapping[str, str] = ROUTES) -> Column:
    """Name of the output of a record: the first pattern matching the whole name."""
    target = source_table
    for pattern, replacement in reversed(list(routes.items())):
        whole = f"^(?:{pattern})$"
        target = F.when(
            F.regexp_like(source_table, F.lit(whole)), F.regexp_replace(source_table, whole, replacement)
        ).otherwise(target)
    return target


def within_retention(
    df: DataFrame, retention_ms: int, as_of_ms: Column | int, column: str = "timestamp_ms"
) -> DataFrame:
    """Rows not older than the retention.

    ``column`` holds epoch milliseconds, or a timestamp without zone, which is compared
    as it is, so that the bound reaches the scan; ``as_of_ms`` is then of that type too.
    A table laid out by ``event_date`` (UTC) also gets a date filter, which prunes its
    partitions.
    """
    as_of = F.lit(as_of_ms) if isinstance(as_of_ms, int) else as_of_ms
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return df.where(F.col(column) >= as_of - F.make_dt_interval(secs=F.lit(retention_ms / 1000).cast("decimal(18,6)")))
    kept = df.where(F.col(column) >= as_of - retention_ms)
    if "event_date" in df.columns:
        kept = kept.where(F.col("event_date") >= epoch_day(as_of - retention_ms))
    return kept
