"""Folders that the driver and all executors see, and tables written there."""

from __future__ import annotations

import atexit
import functools
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _process_folder() -> str:
    """One temporary folder for this process, removed when it ends."""
    folder = tempfile.mkdtemp(prefix="undercut-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the session's ``spark.checkpoint.dir``.

    Only a session whose executors are threads of this process (``local`` or
    ``local[n]``) may go without that setting and gets a folder that goes with it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _process_folder()
    return f"{base}/{purpose}-{uuid.uuid4().hex}"


_NOTED: ContextVar[list[str] | None] = ContextVar("noted", default=None)


@contextmanager
def noted_tables() -> Iterator[list[str]]:
    """The paths of all tables that are materialised inside, for whoever deletes them later."""
    paths: list[str] = []
    token = _NOTED.set(paths)
    try:
        yield paths
    finally:
        _NOTED.reset(token)


def delete_tables(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


#: While it is set, Spark deletes the shuffle files of a run as soon as that has ended.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Writes inside leave no shuffle files; else these stay until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANED, None)
    spark.conf.set(CLEANED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANED)
        else:
            spark.conf.set(CLEANED, before)


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``df``, written once as a table in the shared folder and read back.

    It cuts the lineage: a lost executor costs no earlier stage again, and what depends
    on partition numbers or sampled ranges is fixed from here on. The table belongs to
    whoever owns ``spark.checkpoint.dir``.
    """
    path = shared_folder(df.sparkSession, purpose)
    with shuffles_deleted(df.sparkSession):
        df.write.parquet(path)
    if (noted := _NOTED.get()) is not None:
        noted.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Slots:
    """Tables of a job that goes on in rounds, by name: one takes the place of the last, which is then deleted.

    Whatever still reads the last one must have been written by then.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def put(self, name: str, df: DataFrame) -> DataFrame:
        before = self.paths.get(name)
        with noted_tables() as made:
            found = materialise(df, name)
        (self.paths[name],) = made
        if (noted := _NOTED.get()) is not None:
            noted.extend(made)
        if before is not None:
            delete_tables(self.spark, [before])
        return found

    def drop(self, *names: str) -> None:
        delete_tables(self.spark, [self.paths.pop(name) for name in names if name in self.paths])
