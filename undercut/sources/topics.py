"""Topic reader and writer for clusters whose sessions carry the Kafka package."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from undercut.operators.quality import to_dead_letter
from undercut.operators.recent import OFFSET, PARTITION

_CORRUPT = "_undecodable_value"


def topic_options(servers: str, topic: str, start: str = "earliest", per_batch: int | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}
    if per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(per_batch)
    return options


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    schema: T.StructType,
    streaming: bool = True,
    start: str = "earliest",
    per_batch: int | None = None,
) -> DataFrame:
    """JSON values of a topic as columns, with partition and offset."""
    reader = spark.readStream if streaming else spark.read
    try:
        records = reader.format("kafka").options(**topic_options(servers, topic, start, per_batch)).load()
    except AnalysisException as error:
        raise RuntimeError("the session has no kafka data source; add the spark-sql-kafka package") from error
    value = F.from_json(F.col("value").cast("string"), schema)
    return records.select(
        value.alias("row"), F.col("partition").alias(PARTITION), F.col("offset").alias(OFFSET)
    ).select("row.*", PARTITION, OFFSET)


def header_array(headers: Column) -> Column:
    """A map of names and texts as a topic's headers: an array of name and bytes."""
    return F.transform(
        F.map_entries(headers), lambda h: F.struct(h["key"].alias("key"), F.encode(h["value"], "UTF-8").alias("value"))
    )


def as_topic_records(df: DataFrame, key: str, headers: str | None = None, deleted: Column | None = None) -> DataFrame:
    """Key and JSON value columns, as a topic sink takes them.

    ``headers`` names a map column that becomes the headers of its record and is left out of the value.
    Where ``deleted`` is true the value is null: a tombstone, which takes the key's record out of a
    compacted topic.
    """
    value = F.to_json(F.struct(*(c for c in df.columns if c != headers)))
    if deleted is not None:
        value = F.when(F.coalesce(deleted, F.lit(False)), F.lit(None)).otherwise(value)
    columns = [F.col(key).cast("string").alias("key"), value.alias("value")]
    return df.select(*columns, *([] if headers is None else [header_array(F.col(headers)).alias("headers")]))


def dead_letter_records(letters: DataFrame) -> DataFrame:
    """Dead letters (key, value and a map of headers) as records of a topic."""
    return letters.select("key", "value", header_array(F.col("headers")).alias("headers"))


def decoded(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Records with their value as ``row`` and ``undecodable``: whether it is no JSON of that schema.

    A tombstone has a null row and is not undecodable.
    """
    marked = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(F.col("value").cast("string"), marked, {"columnNameOfCorruptRecord": _CORRUPT})
    found = records.withColumn("row", parsed)
    bad = F.col("value").isNotNull() & (F.col("row").isNull() | F.col(f"row.{_CORRUPT}").isNotNull())
    found = found.withColumn("undecodable", bad)
    row = F.when(F.col("value").isNotNull() & ~F.col("undecodable"), F.col("row").dropFields(_CORRUPT))
    return found.withColumn("row", row)


def undecodable_letters(records: DataFrame, topic: str, as_of_ms: int | None = None) -> DataFrame:
    """Dead letters of the ``decoded`` records that could not be read, with their value as it was."""
    failed = records.where("undecodable").select(F.col("key").cast("string").alias("car_id"), F.col("value").cast("string").alias("record"))
    return to_dead_letter(failed, F.lit("value is no record of the schema"), topic, "DecodingError", F.col("record"), as_of_ms)
