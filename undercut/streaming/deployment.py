"""Named streaming queries: deploy once, stop, deploy again."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery


def active_queries(spark: SparkSession) -> dict[str, StreamingQuery]:
    return {query.name: query for query in spark.streams.active if query.name}


def deploy(spark: SparkSession, starters: Mapping[str, Callable[[str], StreamingQuery]]) -> dict[str, StreamingQuery]:
    """Start queries in name order; one that is already running is left alone.

    A starter is given the query name and starts the query under it.
    """
    running = active_queries(spark)
    return {name: running.get(name) or starters[name](name) for name in sorted(starters)}


def stop(spark: SparkSession, names: Iterable[str] | None = None) -> list[str]:
    """Stop the named queries, or all; the names of those that were running."""
    running = active_queries(spark)
    wanted = sorted(running if names is None else set(names) & set(running))
    for name in wanted:
        running[name].stop()
    return wanted


def redeploy(spark: SparkSession, starters: Mapping[str, Callable[[str], StreamingQuery]]) -> dict[str, StreamingQuery]:
    """Stop what runs under these names and start it anew from its checkpoint."""
    stop(spark, starters)
    return deploy(spark, starters)
