"""Session settings that suit these jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Scan splits and broadcast bound keep Spark's defaults; adaptive execution sizes
# shuffle partitions at run time from an upper number set by the cluster. The JVM
# leaves methods over 8000 bytecodes uncompiled, so a stage whose generated method
# is longer (26 validation rules, say) is run operator by operator instead.
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")
SETTINGS = {
    METHOD_LIMIT[0]: METHOD_LIMIT[1],
    # Recording the Python line of every column expression takes longer than planning.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(master: str | None = None, app: str = "undercut", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
