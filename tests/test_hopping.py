import random
from collections import defaultdict

import pytest
from conftest import event, events_df
from pyspark.sql import functions as F

from undercut.operators.hopping import events_with_time, hop_metrics


def by_hand(rows, size, advance):
    groups = defaultdict(list)
    for r in rows:
        if r["enriched"] and r["timestamp_ms"] >= 0:
            start = r["timestamp_ms"] // advance * advance
            while start > r["timestamp_ms"] - size:
                if start >= 0:
                    groups[r["car_id"], start].append(r)
                start -= advance
    out = {}
    for (car, start), found in groups.items():
        speeds = [r["speed_kph"] for r in found if r["speed_kph"] is not None]
        temps = [sum(r[f"tire_temp_{c}"] for c in ("fl", "fr", "rl", "rr")) / 4 for r in found]
        wears = [sum(r[f"tire_wear_{c}"] for c in ("fl", "fr", "rl", "rr")) / 4 for r in found]
        mean = [sum(v) / len(v) if v else None for v in (speeds, temps, wears)]
        out[car, start] = (start + size, mean[0], max(speeds, default=None), mean[1], mean[2], len(found))
    return out


@pytest.mark.parametrize("size, advance", [(30_000, 10_000), (10_000, 10_000), (60_000, 5_000)])
def test_against_brute_force(spark, size, advance):
    rng = random.Random(3)
    rows = []
    for _ in range(1500):
        car = "CAR_01" if rng.random() < 0.5 else f"CAR_{rng.randint(2, 6):02d}"
        rows.append(
            event(
                car_id=car,
                timestamp_ms=rng.choice([-1, 0, 9_999, 10_000, 30_000, rng.randint(0, 120_000)]),
                speed_kph=rng.choice([None, float(rng.randint(80, 340))]),
                tire_temp_fl=float(rng.randint(60, 130)),
                tire_wear_rr=float(rng.randint(0, 100)),
            )
            | {"enriched": rng.random() < 0.8}
        )
    df = events_df(spark, *rows)
    numbered = spark.createDataFrame(
        [(*tuple(r[c] for c in df.columns), r["enriched"]) for r in rows], df.schema.add("enriched", "boolean")
    )
    got = {
        (r.car_id, r.window_start_ms): (
            r.window_end_ms, r.avg_speed_kph, r.max_speed_kph, r.avg_tire_temp_c, r.avg_tire_wear_pct, r.event_count,
        )
        for r in hop_metrics(numbered, size, advance).collect()
    }
    expect = by_hand(rows, size, advance)
    assert got.keys() == expect.keys()
    for key, value in expect.items():
        assert got[key] == pytest.approx(value), key


def test_uneven_window_is_refused(spark):
    with pytest.raises(ValueError):
        hop_metrics(events_df(spark, event()).withColumn("enriched", F.lit(True)), 25_000, 10_000)


def test_event_time(spark):
    rows = events_df(spark, event(timestamp_ms=1_704_067_200_050), event(timestamp_ms=-1), event(timestamp_ms=None))
    got = events_with_time(rows).select(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSS").alias("t")).collect()
    assert [r.t for r in got] == ["2024-01-01 00:00:00.050"]


def test_raw_rows_are_not_multiplied_before_the_shuffle(spark):
    df = hop_metrics(events_df(spark, event()).withColumn("enriched", F.lit(True)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    assert plan.index("Generate explode") < plan.index("partial_max(_speed")  # printed root first
