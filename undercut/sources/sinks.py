"""Writers, safe to repeat per micro-batch."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from undercut.functions.text import epoch_day
from undercut.operators.quality import sanitize_numeric
from undercut.sources.manifest import Manifest, Part


#: What is noted of each file of window metrics, for folding and retention.
WINDOW_BOUNDS = ("window_start_ms", "window_end_ms")


def write_batch(
    df: DataFrame,
    path: str,
    batch_id: int,
    fmt: str = "parquet",
    by: tuple[str, ...] = (),
    bounds: tuple[str, ...] = (),
    info: dict | Callable[[], dict] | None = None,
) -> bool:
    """Write one micro-batch, exactly once; whether this call committed it.

    See ``undercut.sources.manifest``: an attempt counts if its entry in the sink's list is
    the first of its batch, and a repeat of a committed batch writes nothing. Least and
    greatest values of the numeric columns in ``bounds`` are noted by file. ``info`` goes into
    the entry; a function is called when the files have been written.
    """
    return Manifest(df.sparkSession, path).write(df, batch_id, fmt, by, bounds, info)


def finished_batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the live micro-batches of a sink."""
    return sorted({part.batch for part in Manifest(spark, path).parts()})


def read_parts(spark: SparkSession, path: str, parts: Iterable[Part], schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The rows of live parts with their ``batch_id``; what upkeep has made has that of its last batch."""
    numbered = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    parts = list(parts)
    places = [p for part in parts if part.folder.startswith("batch_id=") for p in part.paths(path)]
    made = [part for part in parts if not part.folder.startswith("batch_id=")]
    found = spark.read.schema(numbered).format(fmt).option("basePath", path).load(places) if places else None
    for part in made:
        # A folder of its own, so that the folders above it are not taken for columns.
        rows = spark.read.schema(schema).format(fmt).option("basePath", f"{path}/{part.folder}").load(part.paths(path))
        rows = rows.withColumn("batch_id", F.lit(part.batch).cast("long"))
        found = rows if found is None else found.unionByName(rows)
    return spark.createDataFrame([], numbered) if found is None else found


def read_batches(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", after: int | None = None
) -> DataFrame:
    """The committed micro-batches with ``batch_id``; only those after a number, if given."""
    manifest = Manifest(spark, path)
    return read_parts(spark, path, manifest.parts() if after is None else manifest.after(after), schema, fmt)


def write_part(
    df: DataFrame, path: str, batch: int, fmt: str, info: dict, bounds: tuple[str, ...] = (), by: tuple[str, ...] = ()
) -> Part:
    """Rows that upkeep makes of batches up to a number; live once a generation names them."""
    folder = f"_folded/{batch}-{uuid.uuid4().hex}"
    manifest = Manifest(df.sparkSession, path)
    df.write.partitionBy(*by).format(fmt).save(f"{path}/{folder}")
    return Part(folder, batch, tuple(manifest.listed(f"{path}/{folder}", fmt, df, bounds)), info)


def expire(spark: SparkSession, path: str, before: int, column: str = "timestamp_ms") -> list[str]:
    """Take files that lie wholly before a time out of a sink, and name them.

    The bounds of each file decide (``write_batch`` with ``bounds``), so a retention of hours
    needs no layout by date; a file with rows on both sides stays until all are older. Readers
    see the change when they next resolve the sink's list, and ``Manifest.clean`` deletes
    the files when readers from before have had time to finish. A batch stays committed, so
    that a retry does not write it again.
    """
    manifest, gone = Manifest(spark, path), []

    def kept(parts: list[Part]) -> list[Part]:
        gone.clear()
        live = []
        for part in parts:
            old = [f for f in part.files if (high := f.get("high", {}).get(column)) is not None and high < before]
            gone.extend(f"{part.folder}/{file['path']}" for file in old)
            left = tuple(f for f in part.files if f not in old)
            if left or not old:
                live.append(part if not old else Part(part.folder, part.batch, left, part.info, whole=False))
        return live

    if any(f.get("high", {}).get(column, before) < before for part in manifest.parts() for f in part.files):
        while not manifest.replaced(kept):
            pass
    return sorted(gone)


def with_event_date(df: DataFrame, column: str = "timestamp_ms") -> DataFrame:
    """Add the layout column that retention filters prune by: the UTC date."""
    return df.withColumn("event_date", epoch_day(F.col(column)))


def as_json_rows(df: DataFrame, key: str = "car_id") -> DataFrame:
    """Key and JSON value; NaN and infinities are written as null."""
    clean = sanitize_numeric(df)
    return clean.select(F.col(key).alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def write_aggregates(df: DataFrame, path: str, batch_id: int) -> None:
    """One micro-batch of window metrics as JSON rows."""
    write_batch(sanitize_numeric(df), path, batch_id, "json", bounds=WINDOW_BOUNDS)
