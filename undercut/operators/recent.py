"""Tail reads and the views shown from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from undercut.functions.text import MISSING, iso_millis, percent1, yes_no
from undercut.operators.quality import sanitize_numeric
from undercut.schemas import PREVIEW_DEFAULT_LIMIT, PREVIEW_MAX_LIMIT

PARTITION, OFFSET = "_kafka_partition", "_kafka_offset"

# Records read beyond an even share of the limit, per partition.
TAIL_SLACK = 5

_SENTINEL = "end-of-record"


def with_position(df: DataFrame, partition: Column, offset: Column) -> DataFrame:
    """Attach partition and offset, as a topic source does by itself."""
    return df.withColumns({PARTITION: partition.cast("int"), OFFSET: offset.cast("long")})


def tail_per_partition(df: DataFrame, limit: int, partitions: int | None = None, salts: int = 64) -> DataFrame:
    """Rows at the last ``ceil(limit / partitions) + 5`` offsets of each partition.

    The number of partitions is that of the data, or ``partitions`` if the topic has
    more. No partition is left out; records without one count as one of their own.

    One pass: the planner keeps each task's newest ``limit + 5`` rows of a partition,
    which no tail exceeds, those of a hot partition are cut again in ``salts`` groups of
    tasks, and the exact bound is applied to what is left.
    """
    most = limit + TAIL_SLACK
    newest = F.desc(OFFSET)
    part, whole = W.partitionBy(PARTITION, "_salt").orderBy(newest), W.partitionBy(PARTITION).orderBy(newest)
    kept = (
        df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .withColumn("_age", F.row_number().over(part))
        .where(F.col("_age") <= most)
        .withColumn("_age", F.row_number().over(whole))
        .where(F.col("_age") <= most)
        .withColumn("_last", F.max(OFFSET).over(W.partitionBy(PARTITION)))
    )
    found = F.count(F.when(F.col("_age") == 1, 1)).over(W.partitionBy())
    share = F.ceil(F.lit(limit) / F.greatest(found, F.lit(partitions or 1))) + TAIL_SLACK
    return kept.withColumn("_share", share).where(F.col(OFFSET) > F.col("_last") - F.col("_share")).select(*df.columns)


def clamp_limit(limit: int | None) -> int:
    if limit is not None and limit < 1:
        raise ValueError("limit must be at least 1")
    return min(PREVIEW_DEFAULT_LIMIT if limit is None else limit, PREVIEW_MAX_LIMIT)


def recent(
    df: DataFrame, time_column: str, partitions: int | None = None, limit: int | None = None, value: str | None = None
) -> DataFrame:
    """The newest rows of the tails, tombstones (null ``value``) skipped."""
    rows = clamp_limit(limit)
    tail = tail_per_partition(df, rows, partitions)
    if value is not None:
        tail = tail.where(F.col(value).isNotNull())
    return tail.orderBy(F.desc(time_column), PARTITION, OFFSET).limit(rows)


def decode_json_rows(df: DataFrame, value: str, schema: T.StructType) -> DataFrame:
    """Decode JSON values into columns.

    Tombstones (null) and texts that are not JSON are skipped, an empty text is an
    empty object, and JSON other than an object goes to ``_raw``. Of a repeated key the
    last value counts; NaN and infinities are taken as numbers and become null. Lenient
    parsers stop after the first value, so the text is checked between a bracket and a
    sentinel: only one whole JSON value leaves the sentinel in second place.
    """
    text = F.btrim(F.col(value), F.lit(" \t\r\n"))
    wrapped = F.concat(F.lit("["), text, F.lit(f',"{_SENTINEL}"]'))
    strict = {"allowSingleQuotes": "false"}
    items = F.from_json(wrapped, "array<string>", strict)
    empty = F.col(value) == ""
    whole = (F.size(items) == 2) & (F.get(items, F.lit(1)) == _SENTINEL)
    decoded = df.where(F.col(value).isNotNull() & (empty | F.coalesce(whole, F.lit(False))))
    object_ = F.startswith(text, F.lit("{"))
    bare = text.isin("NaN", "Infinity", "-Infinity")
    decoded = decoded.withColumn("_decoded", F.from_json(F.when(object_, text), schema, strict)).withColumn(
        "_raw", F.when(~object_ & ~empty & ~bare, text)
    )
    kept = [c for c in df.columns if c != value]
    return sanitize_numeric(
        decoded.select(*kept, *[F.col("_decoded")[f.name].alias(f.name) for f in schema.fields], "_raw")
    )


def pit_wall_view(predictions: DataFrame) -> DataFrame:
    """Predictions as shown: ISO time, percent with one decimal, yes/no."""
    shown = {
        "car_id": F.coalesce(F.col("car_id"), F.lit(MISSING)),
        "timestamp": F.coalesce(iso_millis(F.col("timestamp_ms")), F.lit(MISSING)),
        "probability": percent1(F.col("pit_probability")),
        "recommend_pit": yes_no(F.col("recommend_pit")),
        "model_version": F.coalesce(F.col("model_version"), F.lit(MISSING)),
    }
    replaced = ("timestamp_ms", "pit_probability")
    rest = [c for c in predictions.columns if c not in shown and c not in replaced]
    return predictions.select(*rest, *[column.alias(name) for name, column in shown.items()])
