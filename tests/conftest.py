import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from undercut.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[4]",
        app="undercut-tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="undercut-tests-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """A path that does not exist yet."""
    return str(tmp_path / "data")


def event(**changes):
    """One valid telemetry event."""
    base = dict(
        car_id="CAR_01", driver_id="DRV_01", session_id="RACE_2024_C01_R1", timestamp_ms=1_000, lap=5, sector=2,
        speed_kph=200.0, rpm=9000, gear=6, throttle_pct=80.0, brake_pct=0.0, drs_active=False, tire_compound="SOFT",
        tire_temp_fl=90.0, tire_temp_fr=91.0, tire_temp_rl=92.0, tire_temp_rr=93.0,
        tire_wear_fl=10.0, tire_wear_fr=20.0, tire_wear_rl=30.0, tire_wear_rr=40.0,
        fuel_load_kg=60.0, engine_temp_c=95.0, ers_deploy_pct=50.0, g_force_lat=1.0, g_force_lon=-1.0,
    )
    return {**base, **changes}


def nullable(schema):
    from pyspark.sql import types as T

    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def events_df(spark, *rows):
    from undercut.schemas import TELEMETRY

    return spark.createDataFrame([tuple(r[c] for c in TELEMETRY.names) for r in rows], nullable(TELEMETRY))


def circuits_df(spark, *keys):
    from decimal import Decimal

    from undercut.operators.reference import reference_table

    rows = [(k, f"Ring {k}", "Land", Decimal("5.793"), 53, 2, Decimal("21.50")) for k in keys]
    names = "circuit_id string, circuit_name string, country string, length_km decimal(6,3), num_laps int, "
    names += "drs_zones int, pit_loss_time_s decimal(5,2)"
    return reference_table(spark.createDataFrame(rows, names), "circuits")


def drivers_df(spark, *keys):
    from undercut.operators.reference import reference_table

    rows = [(k, f"Name {k}", "ABC", "TEAM_1", "LND") for k in keys]
    names = "driver_id string, full_name string, abbreviated_name string, team_id string, nationality string"
    return reference_table(spark.createDataFrame(rows, names), "drivers")
