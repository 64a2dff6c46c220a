import math
import random
from decimal import ROUND_FLOOR, Decimal

import pytest
from conftest import event, events_df
from pyspark.sql import functions as F

from undercut.functions.numeric import quantise2
from undercut.functions.text import fixed1, percent1, truncate
from undercut.operators.quality import (
    quantise_sensors, quarantined, sanitize_numeric, to_dead_letter, valid, validate_events,
)

BAD = event(
    car_id="POISON_0", driver_id="DRV_INVALID", session_id="INVALID_SESSION", timestamp_ms=-1, lap=-999, sector=99,
    speed_kph=9999.99, rpm=-1, gear=0, throttle_pct=200.0, brake_pct=-50.0,
    tire_temp_fl=500.0, tire_temp_fr=500.0, tire_temp_rl=500.0, tire_temp_rr=500.0,
    tire_wear_fl=999.0, tire_wear_fr=999.0, tire_wear_rl=999.0, tire_wear_rr=999.0,
    fuel_load_kg=-10.0, engine_temp_c=999.0, ers_deploy_pct=200.0, g_force_lat=50.0, g_force_lon=50.0,
)


def test_bad_record_is_quarantined_with_reasons(spark):
    checked = validate_events(events_df(spark, BAD, event()))
    assert valid(checked).count() == 1
    row = quarantined(checked).first()
    assert len(row.violations) == 20 and row.reason.startswith("timestamp_ms,lap,sector,speed_kph,rpm,throttle_pct")
    assert "gear" not in row.violations and "drs_active" not in row.violations


@pytest.mark.parametrize(
    "change, reason",
    [
        ({"speed_kph": math.nan}, "speed_kph"),
        ({"lap": None}, "lap"),
        ({"drs_active": None}, "drs_active"),
        ({"tire_compound": "SLICK"}, "tire_compound"),
        ({"tire_compound": None}, "tire_compound"),
        ({"car_id": "  "}, "car_id"),
        ({"session_id": None}, "session_id"),
        ({"g_force_lon": math.inf}, "g_force_lon"),
        ({"sector": 0, "gear": 9}, "sector,gear"),
        ({}, None),
    ],
)
def test_rules(spark, change, reason):
    checked = validate_events(events_df(spark, event(**change)))
    bad = quarantined(checked).collect()
    assert [r.reason for r in bad] == ([] if reason is None else [reason])
    assert valid(checked).count() == (reason is None)


def test_dead_letter_headers(spark):
    rows = events_df(spark, event(), event(car_id=None))
    letters = to_dead_letter(rows, F.repeat(F.lit("x"), F.lit(600)), "raw", record=F.lit(None), as_of_ms=5).collect()
    assert [r.key for r in letters] == ["CAR_01", "UNKNOWN"]
    assert letters[0].value == "null-value"
    assert letters[0].headers == {
        "X-Error-Message": "x" * 500 + "...",
        "X-Original-Topic": "raw",
        "X-Error-Timestamp": "5",
        "X-Exception-Class": "ValidationError",
        "X-Original-Car-Id": "CAR_01",
    }
    lone = to_dead_letter(rows, F.lit(None).cast("string"), "raw").first()
    assert lone.value == "async-failure:null" and lone.headers["X-Error-Message"] == "null"


def test_truncate_keeps_500(spark):
    df = spark.createDataFrame([("a" * 500,), ("a" * 501,), (None,)], "s string")
    got = [r[0] for r in df.select(truncate(F.col("s"))).collect()]
    assert got == ["a" * 500, "a" * 500 + "...", "null"]


def test_quantise(spark):
    rng = random.Random(1)
    values = [-2.675, 2.675, 0.005, -0.005, 1.005, 0.0049999999999999994, 123456.785, 0.0, None]
    values += [rng.uniform(-500, 500) for _ in range(500)]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(quantise2(F.col("v"))).collect()]
    for value, result in zip(values, got):
        if value is None:
            assert result is None
            continue
        exact = (Decimal(value * 100.0) + Decimal("0.5")).to_integral_value(ROUND_FLOOR)
        assert result == float(exact) / 100.0
    odd = spark.createDataFrame([(math.nan,), (math.inf,), (-math.inf,)], "v double")
    edge = [r[0] for r in odd.select(quantise2(F.col("v"))).collect()]
    assert edge == [0.0, (2**63 - 1) / 100.0, -(2**63) / 100.0]
    row = quantise_sensors(events_df(spark, event(speed_kph=1.239, rpm=7))).first()
    assert row.speed_kph == 1.24 and row.rpm == 7


def test_one_decimal_rounds_the_binary_value(spark):
    rng = random.Random(2)
    values = [12.25, 12.35, 12.75, 0.05, 0.25, 99.95, 57.25, 57.24999999999999, 0.0, 100.0, 1.45, 8.345, -12.25, -0.04]
    values += [rng.randint(0, 4000) / 40 for _ in range(500)] + [rng.uniform(0, 100) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(fixed1(F.col("v"))).collect()]
    for value, text in zip(values, got):
        tenths = (Decimal(abs(value)) * 10 + Decimal("0.5")).to_integral_value(ROUND_FLOOR)
        assert text == ("-" if value < 0 else "") + f"{tenths / 10:.1f}", value
    shown = spark.createDataFrame([(0.5725,), (math.nan,), (None,)], "v double").select(percent1(F.col("v"))).collect()
    assert [r[0] for r in shown] == ["57.3%", "—", "—"]


def test_sanitize_nested(spark):
    df = spark.sql(
        """SELECT 1 AS id, double('NaN') AS a, float('Infinity') AS b, 1.5D AS c, array(1D, double('-Infinity')) AS d,
        map('x', double('NaN'), 'y', 2D) AS e, named_struct('p', double('NaN'), 'q', array(named_struct('r', 3D))) AS f,
        CAST(NULL AS STRUCT<p: DOUBLE>) AS g, 'NaN' AS h"""
    )
    row = sanitize_numeric(df).first()
    assert (row.a, row.b, row.c, row.d, row.e) == (None, None, 1.5, [1.0, None], {"x": None, "y": 2.0})
    assert row.f.p is None and row.f.q[0].r == 3.0 and row.g is None and row.h == "NaN"
    assert sanitize_numeric(df.select("id", "h")).columns == ["id", "h"]
