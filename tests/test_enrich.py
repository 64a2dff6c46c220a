import random

import pytest
from conftest import circuits_df, drivers_df, event, events_df
from pyspark.sql import functions as F

from undercut.functions.ids import circuit_id
from undercut.operators.enrich import enrich, enrich_driver
from undercut.schemas import ENRICHED


def test_both_lookups_hit(spark):
    row = enrich(events_df(spark, event()), circuits_df(spark, "C01"), drivers_df(spark, "DRV_01"), as_of_ms=7).first()
    assert row.enriched and row.enrichment_ts_ms == 7
    assert (row.circuit_name, row.circuit_country, row.circuit_length_km) == ("Ring C01", "Land", 5.793)
    assert (row.num_laps, row.drs_zones, row.pit_loss_time_s) == (53, 2, 21.5)
    assert (row.driver_full_name, row.driver_abbrev, row.driver_team) == ("Name DRV_01", "ABC", "TEAM_1")


@pytest.mark.parametrize(
    "circuit, driver, any_flag, all_flag",
    [("C01", "DRV_01", True, True), ("X", "DRV_01", True, False), ("C01", "X", True, False), ("X", "X", False, False)],
)
@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_flag_and_no_event_lost(spark, circuit, driver, any_flag, all_flag, threshold):
    """With the dimensions broadcast and, beyond the threshold, sort-merge joined."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        events = events_df(spark, event(), event(session_id="SHORT"), event(session_id=None, driver_id=None))
        tables = circuits_df(spark, circuit), drivers_df(spark, driver)
        rows = {r.session_id: r for r in enrich(events, *tables).collect()}
        assert len(rows) == 3
        assert rows["RACE_2024_C01_R1"].enriched == any_flag
        assert rows["SHORT"].enriched == (driver == "DRV_01") and rows["SHORT"].circuit_name is None
        assert rows[None].enriched is False
        strict = enrich(events, *tables, require="all").where("session_id = 'RACE_2024_C01_R1'").first()
        assert strict.enriched == all_flag
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_column_set(spark):
    df = enrich(events_df(spark, event()), circuits_df(spark, "C01"), drivers_df(spark, "DRV_01"))
    assert sorted(df.columns) == sorted(ENRICHED.names)
    assert enrich_driver(events_df(spark, event()), drivers_df(spark, "Z")).first().enriched is False


def third_token(session):
    if session is None:
        return None
    parts = session.rstrip("_").split("_")
    return parts[2] if len(parts) > 2 else None


def test_circuit_id_cases(spark):
    rng = random.Random(5)
    cases = ["RACE_2024_MONZA_R1", "A_B_C", None, "", "   ", "SHORT", "A_B_", "A_B__C", "___", "_A_B", "A_B_C___"]
    cases += ["".join(rng.choice("ab_ ") for _ in range(rng.randint(0, 9))) for _ in range(500)]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = df.select("s", circuit_id(F.col("s")).alias("c")).collect()
    assert [(r.s, r.c) for r in got] == [(c, third_token(c)) for c in cases]
