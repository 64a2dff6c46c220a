from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from undercut.operators.reference import (
    check_constraints, defaults_of, fk_orphans, insert_if_absent, reference_table, without_key,
)
from undercut.schemas import CIRCUITS, REFERENCE_TABLES
from undercut.sources.tables import load_reference


def test_declared_types_and_defaults(spark):
    rows = spark.createDataFrame([("C1", "Ring", "Land", 5.7931)], "circuit_id string, circuit_name string, country string, length_km double")
    table = reference_table(rows, "circuits")
    assert [(f.name, f.dataType) for f in table.schema.fields] == [(f.name, f.dataType) for f in CIRCUITS.fields]
    row = table.first()
    assert row.length_km == Decimal("5.793") and row.created_at is not None and row.num_laps is None
    named_null = spark.createDataFrame([("D1", "N", None)], "driver_id string, full_name string, race_wins int")
    driver = reference_table(named_null, "drivers").first()
    assert driver.championships == 0 and driver.race_wins is None


def test_insert_if_absent(spark):
    target = spark.createDataFrame([("a", 1, 5)], "k string, v int, wins int")
    incoming = spark.createDataFrame([("a", 9, 0), ("b", 3, 1), ("b", 2, 0), ("c", None, 2), (None, 4, 3)], "k string, v int, o int")
    out = insert_if_absent(target, incoming, "k", {"wins": F.lit(0)}, order="o")
    assert {tuple(r) for r in out.collect()} == {("a", 1, 5), ("b", 2, 0), ("c", None, 0)}
    again = insert_if_absent(out, incoming, "k", {"wins": F.lit(0)}, order="o")
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in out.collect()}
    assert [tuple(r) for r in without_key(incoming, "k").collect()] == [(None, 4, 3)]
    loose = insert_if_absent(target, incoming, "k")
    assert loose.count() == 3 and set(defaults_of("teams")) == set()


def test_constraints(spark):
    teams = spark.createDataFrame([("T1",), ("T2",)], "team_id string")
    drivers = spark.createDataFrame(
        [("D1", "T1", "x"), ("D1", "T9", None), ("D1", None, "y"), ("D2", "T9", None), (None, "T2", "z")],
        "driver_id string, team_id string, full_name string",
    )
    report = check_constraints(
        drivers, ("driver_id", "full_name"), ("driver_id",), {"team_id": (teams, "team_id")}
    )
    assert {(r.rule, r.violations) for r in report.collect()} == {
        ("not_null:driver_id", 1), ("not_null:full_name", 2), ("unique:driver_id", 2), ("foreign:team_id", 2),
    }
    assert sorted(r.driver_id for r in fk_orphans(drivers, "team_id", teams, "team_id").collect()) == ["D1", "D2"]
    clean = check_constraints(teams, unique=("team_id",), foreign={"team_id": (teams, "team_id")})
    assert {r.violations for r in clean.collect()} == {0}


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_load_reference(spark, folder, fmt):
    for name, schema in REFERENCE_TABLES.items():
        empty = spark.createDataFrame([], schema)
        empty.write.format(fmt).save(f"{folder}/{name}")
    tables = load_reference(spark, folder, fmt)
    assert {n: t.columns for n, t in tables.items()} == {n: s.names for n, s in REFERENCE_TABLES.items()}
