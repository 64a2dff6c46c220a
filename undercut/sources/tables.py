"""Reference tables from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from undercut.schemas import REFERENCE_TABLES


def load_reference(spark: SparkSession, folder: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The four reference tables, one sub-folder each, read with declared types."""
    return {
        name: spark.read.schema(schema).format(fmt).load(f"{folder}/{name}")
        for name, schema in REFERENCE_TABLES.items()
    }
