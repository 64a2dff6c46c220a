"""Metric series, metric texts and pipeline counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from undercut.operators.features import has_features
from undercut.schemas import SERIES_HISTORY

# Fixed value: the number a sample's text begins with.
LEADING_NUMBER = r"^([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"


def epoch_us(column: str) -> Column:
    """Epoch microseconds of a timestamp without zone, read as UTC whatever the session's zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {column})")


def counter_rate(samples: DataFrame, range_s: int = 60, slice_ranges: int = 16) -> DataFrame:
    """Per-second rate of counters over the trailing range, at every sample.

    A drop in value is a restart and counts as the new value. The rate is the
    increase between the first sample at or after ``t - range`` and the sample at
    ``t`` over the time between them, null where that is one and the same sample.
    Timestamps are unique within a series.

    A series is cut into slices of ``slice_ranges`` ranges, and the samples of the
    last range of a slice are repeated at the head of the next. Every trailing range
    lies inside one slice, so the result is exact while no task gets a whole series.
    The first sample of the range is found by sorting a probe at ``t - range`` among
    the samples: one running window, where a sliding frame would visit every sample
    of the range again for every row.
    """
    reach, slice_us = range_s * 1_000_000, range_s * slice_ranges * 1_000_000
    at = epoch_us("ts")
    home = F.col("_us") - F.pmod("_us", F.lit(slice_us))
    following = F.col("_home") + slice_us
    slices = F.when(F.col("_us") >= following - reach, F.array("_home", following)).otherwise(F.array("_home"))

    forward = W.partitionBy("series", "_slice").orderBy("_us")
    before = F.lag("value").over(forward)
    step = F.when(before.isNull(), 0.0).when(F.col("value") < before, F.col("value")).otherwise(F.col("value") - before)
    totals = (
        samples.select("series", "ts", F.col("value").cast("double").alias("value"), at.alias("_us"))
        .withColumn("_home", home)
        .withColumn("_slice", F.explode(slices))
        .withColumn("_step", step)
        .withColumn("_total", F.sum("_step").over(forward.rowsBetween(W.unboundedPreceding, 0)))
    )

    is_home = F.col("_slice") == F.col("_home")
    sample, probe = F.lit(False), F.lit(True)
    backward = W.partitionBy("series", "_slice").orderBy(F.desc("_at"), "_probe")
    seen = backward.rowsBetween(W.unboundedPreceding, 0)

    def first_in_range(column: str) -> Column:
        return F.last(F.when(~F.col("_probe"), F.col(column)), ignorenulls=True).over(seen)

    elapsed, increase = F.col("_us") - F.col("_us0"), F.col("_total") - F.col("_total0")
    return (
        totals.withColumn("_probe", F.explode(F.when(is_home, F.array(sample, probe)).otherwise(F.array(sample))))
        .withColumn("_at", F.when(F.col("_probe"), F.col("_us") - reach).otherwise(F.col("_us")))
        .withColumns({"_us0": first_in_range("_us"), "_total0": first_in_range("_total")})
        .where("_probe")
        .select("series", "ts", F.when(elapsed > 0, increase / (elapsed / 1e6)).alias("rate"))
    )


def metric_latest(samples: DataFrame) -> DataFrame:
    return samples.groupBy("series").agg(F.max_by("value", "ts").alias("value"), F.max("ts").alias("ts"))


def recent_series(samples: DataFrame, keep: int = SERIES_HISTORY, salts: int = 64) -> DataFrame:
    """Last ``keep`` samples per series, numbered from the newest.

    The planner limits each group before a shuffle, so a series sends ``keep`` rows per
    task. Those of a hot series are first cut again in ``salts`` groups of tasks, and
    the last step sees at most ``keep * salts`` rows of any series.
    """
    newest = [F.desc("ts"), F.desc("value")]
    part = W.partitionBy("series", "_salt").orderBy(*newest)
    whole = W.partitionBy("series").orderBy(*newest)
    return (
        samples.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .withColumn("_age", F.row_number().over(part))
        .where(F.col("_age") <= keep)
        .drop("_salt", "_age")
        .withColumn("age", F.row_number().over(whole))
        .where(F.col("age") <= keep)
    )


def parse_metric_lines(lines: DataFrame, prefix: str = "") -> DataFrame:
    """Samples of metric texts: one row per text (``source``) and metric name.

    ``lines`` has ``source``, ``pos`` (any orderable) and ``line``. The name ends
    at the label brace, the value is the leading number after the last blank, and
    the last line of a name wins.
    """
    blanks = F.lit(" \t\r\f\x0b")

    def sample(line: Column) -> Column:
        last = F.substring_index(line, " ", -1)
        named = F.btrim(F.left(line, F.length(line) - F.length(last) - 1), blanks)
        name = F.substring_index(named, "{", 1)
        number = F.nullif(F.regexp_extract(last, LEADING_NUMBER, 1), F.lit(""))
        has_name = F.startswith(line, F.lit(prefix)) & F.contains(line, F.lit(" "))
        return F.when(
            has_name & ~F.startswith(line, F.lit("#")),
            F.struct(name.alias("name"), number.try_cast("double").alias("value")),
        )

    # transform binds the trimmed line once; explode drops lines that hold no sample.
    samples = F.array_compact(F.transform(F.array(F.btrim("line", blanks)), sample))
    return (
        lines.where(F.contains("line", F.lit(prefix)))
        .withColumn("sample", F.explode(samples))
        .where(F.startswith("sample.name", F.lit(prefix)) & (F.abs("sample.value") < float("inf")))
        .groupBy("source", F.col("sample.name").alias("name"))
        .agg(F.max_by("sample.value", "pos").alias("value"))
    )


def text_lines(texts: DataFrame, source: str, text: str) -> DataFrame:
    """Lines of text cells, in the shape ``parse_metric_lines`` takes."""
    return texts.select(F.col(source).alias("source"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))


def scoring_counter_columns() -> dict[str, Column]:
    """Counter expressions, for ``agg`` in batch and ``observe`` in a stream.

    A row with a null ``decoded`` flag or false could not be read at all; it is an
    error but was not consumed.
    """
    read = F.coalesce(F.col("decoded"), F.lit(False))
    scored = read & has_features()
    return {
        "consumed": F.count_if(read),
        "emitted": F.count_if(scored),
        "errors": F.count_if(~scored),
    }


def scoring_counters(events: DataFrame) -> DataFrame:
    if "decoded" not in events.columns:
        events = events.withColumn("decoded", F.lit(True))
    return events.agg(*[c.alias(name) for name, c in scoring_counter_columns().items()])


def publish_summary(checked: DataFrame) -> DataFrame:
    """Active cars, events published and events dead-lettered, from validated events."""
    return checked.agg(
        F.count_distinct("car_id").alias("active_cars"),
        F.count_if("is_valid").alias("published"),
        F.count_if(~F.col("is_valid")).alias("dead_lettered"),
    )


def topic_stats(df: DataFrame, partition: str, offset: str) -> DataFrame:
    """Low and end offset and number of records of each partition."""
    return df.groupBy(partition).agg(
        F.min(offset).alias("low"), (F.max(offset) + 1).alias("high"), F.count("*").alias("n")
    )


def topic_has_records(stats: DataFrame) -> DataFrame:
    return stats.agg((F.coalesce(F.sum("high"), F.lit(0)) > 0).alias("has_records"))
