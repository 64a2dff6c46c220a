"""Metric text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_scrapes(spark: SparkSession, path: str, parts: bool = False) -> DataFrame:
    """Lines of metric text files with their order inside the file.

    Large files stay splittable: a line is ordered by the start of its file block and
    then by the running row id, which grows along a block.

    With ``parts``, a folder is one text that many tasks wrote at once in a global order,
    and its part files follow each other by the numbers in their names.
    """
    source, name = F.col("_metadata.file_path"), F.col("_metadata.file_name")
    order = [F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("row")]
    if parts:
        # part-00012-<id of the write>-c000.txt: the task's number, then that of the file in the task.
        task = F.substring_index(F.substring(name, len("part-") + 1, 20), "-", 1)
        file = F.substring_index(F.substring_index(name, "-c", -1), ".", 1)
        order = [task.try_cast("long").alias("task"), file.try_cast("long").alias("file"), *order]
        source = F.left(source, F.length(source) - F.length(name) - 1)
    return spark.read.text(path).select(source.alias("source"), F.struct(*order).alias("pos"), F.col("value").alias("line"))
