import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from undercut.functions.text import fixed1, iso_millis
from undercut.operators.cdc import within_retention
from undercut.operators.recent import (
    OFFSET, PARTITION, clamp_limit, decode_json_rows, pit_wall_view, recent, tail_per_partition,
)
from undercut.sources.sinks import with_event_date

SCHEMA = f"{PARTITION} int, {OFFSET} long, t long, value string"


def test_tail_by_offset(spark):
    rows = [(0, o, o, "v") for o in range(100)] + [(1, o, o, "v") for o in (3, 4, 50, 93, 99)] + [(2, 0, 0, "v")]
    got = tail_per_partition(spark.createDataFrame(rows, SCHEMA), 4, 3)
    found = sorted((r[0], r[1]) for r in got.collect())
    assert found == [(0, o) for o in range(93, 100)] + [(1, 93), (1, 99), (2, 0)]


def test_tail_takes_all_partitions_of_the_data(spark):
    rows = [(p, o, o, "v") for p in range(6) for o in range(50)] + [(None, o, o, "v") for o in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = sorted((r[0] if r[0] is not None else 9, r[1]) for r in tail_per_partition(df, 14).collect())
    assert found == [(p, o) for p in (0, 1, 2, 3, 4, 5, 9) for o in range(43, 50)]
    assert tail_per_partition(df, 14, partitions=2).count() == 49  # the data know more
    assert tail_per_partition(df, 14, partitions=14).count() == 42


def test_tail_reads_its_input_once(spark, folder):
    spark.createDataFrame([(0, 1, 1, "v")], SCHEMA).write.parquet(folder)
    plan = tail_per_partition(spark.read.schema(SCHEMA).parquet(folder), 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_recent_skips_tombstones_after_the_seek(spark):
    rows = [(0, o, o, None if o % 2 else "v") for o in range(100)]
    got = recent(spark.createDataFrame(rows, SCHEMA), "t", 1, limit=3, value="value").collect()
    assert [r.t for r in got] == [98, 96, 94]
    assert recent(spark.createDataFrame([], SCHEMA), "t", 1).count() == 0


def test_one_row(spark):
    row = recent(spark.createDataFrame([(0, 42, 7, "v")], SCHEMA), "t", 1).first()
    assert (row[PARTITION], row[OFFSET], row.value) == (0, 42, "v")


def test_limits(spark):
    assert [clamp_limit(n) for n in (None, 1, 100, 101, 10_000)] == [20, 1, 100, 100, 100]
    with pytest.raises(ValueError):
        clamp_limit(0)
    rows = spark.createDataFrame([(p, o, o, "v") for p in range(5) for o in range(300)], SCHEMA)
    assert recent(rows, "t", 5, limit=500).count() == 100


def loads(text):
    try:
        return True, json.loads(text, parse_constant=lambda _: None)
    except ValueError:
        return False, None


def test_decode_json(spark):
    rng = random.Random(6)
    texts = [
        '{"k": 1}', ' {"k": 2} ', "[1,2]", "7", '"s"', "null", "true", '{"k": 3},4', '{"k": 3} x', "1],[2", "1}", '{"k":',
        "nope", "{'k': 1}", '{"k": "no number"}', '{"z": 1}', "{}", "[]", '[{"k": 9}]', '{"k": 1, "k": 2}', '{"k": NaN}', '{"k": Infinity, "z": 1}', "NaN", "-Infinity", '1,"end-of-record"', "\t[3]\n",
    ]
    texts += ["".join(rng.choice('{}[],:"k1 ') for _ in range(rng.randint(1, 8))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(-1, None), (-2, "")], "i int, value string")
    got = {r.i: r for r in decode_json_rows(df, "value", T.StructType([T.StructField("k", T.LongType())])).collect()}
    assert -1 not in got and (got[-2].k, got[-2]["_raw"]) == (None, None)
    for i, text in enumerate(texts):
        ok, data = loads(text)
        assert (i in got) == ok, text
        if ok and isinstance(data, dict):
            number = data.get("k")
            assert got[i].k == (number if type(number) is int else None) and got[i]["_raw"] is None
        elif ok:
            assert (got[i]["_raw"] and json.loads(got[i]["_raw"])) == data


def test_pit_wall(spark):
    rows = [("CAR_01", 1_704_067_200_050, 0.6525, True, "rf"), (None, None, None, None, None), ("C", 0, 0.0, False, "m")]
    df = spark.createDataFrame(rows, "car_id string, timestamp_ms long, pit_probability double, recommend_pit boolean, model_version string")
    assert [tuple(r) for r in pit_wall_view(df).collect()] == [
        ("CAR_01", "2024-01-01T00:00:00.050Z", "65.3%", "yes", "rf"),
        ("—", "—", "—", "—", "—"),
        ("C", "1970-01-01T00:00:00.000Z", "0.0%", "no", "m"),
    ]


@pytest.fixture
def new_york(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield
    spark.conf.set("spark.sql.session.timeZone", before)


def test_text_and_layout_do_not_follow_the_session_zone(spark, new_york):
    times = [0, -1, 1_704_067_200_050, 253_402_300_800_000, -62_198_755_200_000, 8_640_000_000_000_001, 2**63 - 1, None]
    df = with_event_date(spark.createDataFrame([(t,) for t in times], "timestamp_ms long"))
    rows = df.select(iso_millis(F.col("timestamp_ms")), F.col("event_date").cast("string")).collect()
    assert [r[0] for r in rows] == [
        "1970-01-01T00:00:00.000Z", "1969-12-31T23:59:59.999Z", "2024-01-01T00:00:00.050Z", "+010000-01-01T00:00:00.000Z",
        "-000001-01-01T00:00:00.000Z", "8640000000000001", "9223372036854775807", None,
    ]
    assert [r[1] for r in rows][:3] == ["1970-01-01", "1969-12-31", "2024-01-01"] and [r[1] for r in rows][5:] == [None] * 3


def test_retention_across_zones(spark, folder, new_york):
    now = 1_704_067_200_000 + 3_600_000  # one o'clock on new year's day, UTC
    rows = [(now - 7_200_000,), (now - 90_000_000,), (now,)]
    with_event_date(spark.createDataFrame(rows, "timestamp_ms long")).write.partitionBy("event_date").parquet(folder)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    kept = within_retention(spark.read.parquet(folder), 86_400_000, now)
    assert sorted(r.timestamp_ms for r in kept.collect()) == [now - 7_200_000, now]


def test_percent_of_large_numbers(spark):
    values = [1e300, -1e17, 9007199254740993.0, 0.25, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(fixed1(F.col("v"))).collect()] == ["1.0E300", "-100000000000000000.0", "9007199254740992.0", "0.3", None]
