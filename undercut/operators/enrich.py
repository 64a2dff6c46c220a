"""Left lookups of events in the circuit and driver dimensions.

No join carries a broadcast hint. The planner broadcasts a dimension when its
estimated or (adaptively) measured size is under
``spark.sql.autoBroadcastJoinThreshold``; a larger one is joined by sort-merge,
where adaptive execution splits a hot circuit or the null key, because the event
side of a left join may be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from undercut.functions.ids import circuit_id

# Enrichment column, dimension column, type.
CIRCUIT_FIELDS = (
    ("circuit_name", "circuit_name", "string"),
    ("circuit_country", "country", "string"),
    ("circuit_length_km", "length_km", "double"),
    ("num_laps", "num_laps", "int"),
    ("drs_zones", "drs_zones", "int"),
    ("pit_loss_time_s", "pit_loss_time_s", "double"),
)
DRIVER_FIELDS = (
    ("driver_full_name", "full_name", "string"),
    ("driver_abbrev", "abbreviated_name", "string"),
    ("driver_team", "team_id", "string"),
    ("driver_nationality", "nationality", "string"),
)


def _lookup(events: DataFrame, key: Column, dimension: DataFrame, dim_key: str, fields) -> DataFrame:
    """Left join on a unique dimension key; adds ``_hit``."""
    dim = dimension.select(
        F.col(dim_key).alias("_dim_key"),
        *[F.col(source).cast(dtype).alias(name) for name, source, dtype in fields],
    )
    joined = events.withColumn("_key", key).join(dim, F.col("_key") == F.col("_dim_key"), "left")
    return joined.withColumn("_hit", F.col("_dim_key").isNotNull()).drop("_key", "_dim_key")


def enrich_circuit(events: DataFrame, circuits: DataFrame) -> DataFrame:
    """Circuit columns by the id inside ``session_id``; ``enriched`` tells a hit."""
    joined = _lookup(events, circuit_id(F.col("session_id")), circuits, "circuit_id", CIRCUIT_FIELDS)
    return joined.withColumnRenamed("_hit", "enriched")


def enrich_driver(events: DataFrame, drivers: DataFrame, require: str = "any") -> DataFrame:
    """Driver columns by ``driver_id``.

    ``enriched`` combines the driver hit with the flag of an earlier lookup:
    ``any`` (the running system's behaviour) or ``all`` (its schema text).
    """
    joined = _lookup(events, F.col("driver_id"), drivers, "driver_id", DRIVER_FIELDS)
    flag = F.col("_hit")
    if "enriched" in events.columns:
        flag = {"any": F.col("enriched") | flag, "all": F.col("enriched") & flag}[require]
    return joined.withColumn("enriched", flag).drop("_hit")


def enrich(
    events: DataFrame,
    circuits: DataFrame,
    drivers: DataFrame,
    as_of_ms: int | None = None,
    require: str = "any",
) -> DataFrame:
    """Both lookups plus the enrichment stamp; every event is kept."""
    stamp = F.unix_millis(F.current_timestamp()) if as_of_ms is None else F.lit(as_of_ms).cast("long")
    joined = enrich_driver(enrich_circuit(events, circuits), drivers, require)
    return joined.withColumn("enrichment_ts_ms", stamp)
