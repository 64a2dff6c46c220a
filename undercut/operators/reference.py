"""Reference tables: declared types, insert-if-absent and constraint reports."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from undercut.schemas import REFERENCE_TABLES

# Columns that get a default when an insert leaves them out.
DEFAULTS = {
    "circuits": {"created_at": F.current_timestamp, "updated_at": F.current_timestamp},
    "drivers": {"championships": lambda: F.lit(0), "race_wins": lambda: F.lit(0)},
}


def defaults_of(table: str) -> dict[str, Column]:
    return {name: make() for name, make in DEFAULTS.get(table, {}).items()}


def conform(rows: DataFrame, schema: T.StructType, defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """Cast to the declared types.

    A column the rows do not have takes its default, else null. A null that is
    given stays null, as in an SQL insert that names the column.
    """
    given = dict(defaults or {})
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else given.get(f.name, F.lit(None)))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def reference_table(rows: DataFrame, table: str) -> DataFrame:
    return conform(rows, REFERENCE_TABLES[table], defaults_of(table))


def insert_if_absent(
    target: DataFrame,
    incoming: DataFrame,
    key: str,
    defaults: Mapping[str, Column] | None = None,
    order: str | None = None,
) -> DataFrame:
    """``target`` plus the incoming rows whose key it lacks.

    Of several incoming rows with one key the first by ``order`` is inserted. Rows without
    a key cannot be inserted; ``without_key`` returns them.
    """
    rows = incoming.where(F.col(key).isNotNull())
    if order is None:
        rows = rows.dropDuplicates([key])
    else:
        rest = [c for c in rows.columns if c != key]
        rows = rows.groupBy(key).agg(F.min_by(F.struct(*rest), F.col(order)).alias("row")).select(key, "row.*")
    absent = conform(rows, target.schema, defaults).join(target.select(key), key, "left_anti")
    return target.unionByName(absent.select(*target.columns))


def without_key(incoming: DataFrame, key: str) -> DataFrame:
    """Incoming rows that an insert by key has to reject."""
    return incoming.where(F.col(key).isNull())


def fk_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose foreign key is set but names no parent."""
    keys = parent.select(F.col(pk).alias(fk))
    return child.where(F.col(fk).isNotNull()).join(keys, fk, "left_anti")


def check_constraints(
    rows: DataFrame,
    not_null: tuple[str, ...] = (),
    unique: tuple[str, ...] = (),
    foreign: Mapping[str, tuple[DataFrame, str]] | None = None,
) -> DataFrame:
    """One row per rule with its number of violations.

    Not-null rules share one pass. Rows are counted once per key column, whose unique and
    foreign-key rules share those counts, and the shuffle carries one row per key and
    task however hot a key is. ``unique`` counts the rows beyond the first of each key,
    ``foreign`` the orphans.
    """
    foreign = dict(foreign or {})
    parts = []
    if not_null:
        counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(f"not_null:{c}") for c in not_null])
        parts.append(counts.unpivot([], list(counts.columns), "rule", "violations"))
    for column in dict.fromkeys((*unique, *foreign)):
        counted = rows.groupBy(column).agg(F.count("*").alias("n")).where(F.col(column).isNotNull())
        checks = {}
        if column in foreign:
            parent, pk = foreign[column]
            known = parent.select(F.col(pk).alias(column)).distinct().withColumn("_known", F.lit(True))
            counted = counted.join(known, column, "left")
            checks[f"foreign:{column}"] = F.when(F.col("_known").isNull(), F.col("n"))
        if column in unique:
            checks[f"unique:{column}"] = F.col("n") - 1
        sums = counted.agg(*[F.coalesce(F.sum(v), F.lit(0)).cast("long").alias(rule) for rule, v in checks.items()])
        parts.append(sums.unpivot([], list(sums.columns), "rule", "violations"))
    return reduce(DataFrame.unionByName, parts)
