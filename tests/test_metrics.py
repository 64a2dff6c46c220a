import datetime as dt
import math
import os
import random
import re

import pytest
from conftest import event, events_df
from pyspark.sql import functions as F

from undercut.operators import metrics
from undercut.operators.quality import validate_events
from undercut.plans import inputs
from undercut.sources.scrapes import read_scrapes


def rate_by_hand(samples, reach):
    """samples: sorted (seconds, value) of one series."""
    steps = [0.0]
    for (_, a), (_, b) in zip(samples, samples[1:]):
        steps.append(b if b < a else b - a)
    out = []
    for i, (t, _) in enumerate(samples):
        first = next(j for j, (u, _) in enumerate(samples) if u >= t - reach)
        out.append(None if first == i else sum(steps[first + 1 : i + 1]) / (t - samples[first][0]))
    return out


@pytest.mark.parametrize("slice_ranges", [1, 3, 32])
def test_counter_rate(spark, slice_ranges):
    rng = random.Random(9)
    start = dt.datetime(2024, 1, 1)
    rows, expect = [], {}
    for name in ("a", "b"):
        times = sorted(rng.sample(range(0, 3000), 300)) + ([60 * 960, 60 * 961] if name == "a" else [])
        value, samples = 0.0, []
        for t in times:
            value = 0.0 if rng.random() < 0.05 else value + rng.randint(0, 9)
            samples.append((t, value))
        rows += [(name, start + dt.timedelta(seconds=t), v) for t, v in samples]
        for (t, _), r in zip(samples, rate_by_hand(samples, 60)):
            expect[name, start + dt.timedelta(seconds=t)] = r
    df = spark.createDataFrame(rows, "series string, ts timestamp_ntz, value double")
    got = {(r.series, r.ts): r.rate for r in metrics.counter_rate(df, 60, slice_ranges).collect()}
    assert got.keys() == expect.keys()
    for key, value in expect.items():
        assert got[key] == (None if value is None else pytest.approx(value)), key


def test_latest_and_recent(spark):
    start = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [("hot", start + dt.timedelta(seconds=i), float(i)) for i in range(500)] + [("cold", start, 1.0)],
        "series string, ts timestamp_ntz, value double",
    ).repartition(5)
    assert {(r.series, r.value) for r in metrics.metric_latest(df).collect()} == {("hot", 499.0), ("cold", 1.0)}
    recent = metrics.recent_series(df)
    values = sorted(r.value for r in recent.where("series = 'hot'").collect())
    assert values == [float(i) for i in range(428, 500)] and recent.count() == 73
    assert metrics.recent_series(df, keep=3, salts=2).count() == 4
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4  # before and after each shuffle


TEXT = """# HELP up_total things 5
# TYPE up_total counter
up_total{path="/a b",x="1"} 3
 up_total 4.5 \r
up_errors +Inf
up_errors NaN
up_big 1.5e3
up_junk 12abc
up_word abc
up_stamp 5 1700000000
up_lone
 5
down_total 1

up_total{a="}"} -2
up_dot .5
"""


def parse_by_hand(text, prefix):
    out = {}
    for line in text.split("\n"):
        line = line.strip()
        cut = line.rfind(" ")
        if not line or line.startswith("#") or cut <= 0:
            continue
        name = line[:cut].strip().split("{")[0]
        number = re.match(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", line[cut + 1 :].strip())
        if name.startswith(prefix) and number and math.isfinite(float(number.group())):
            out[name] = float(number.group())
    return out


@pytest.mark.parametrize("prefix", ["up", "", "nothing"])
def test_metric_text(spark, folder, prefix):
    texts = [TEXT, "", "up_total 9\nup_total nope", "\n".join(f"up_x {i}" for i in range(5000))]
    cells = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    got = metrics.parse_metric_lines(metrics.text_lines(cells, "id", "text"), prefix).collect()
    for i, text in enumerate(texts):
        assert {r.name: r.value for r in got if r.source == i} == parse_by_hand(text, prefix)

    os.makedirs(folder)
    for i, text in enumerate(texts):
        with open(os.path.join(folder, f"scrape{i}.txt"), "w", newline="") as out:
            out.write(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # the last file spans several splits
    try:
        got = metrics.parse_metric_lines(read_scrapes(spark, folder), prefix).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for i, text in enumerate(texts):
        found = {r.name: r.value for r in got if r.source.endswith(f"scrape{i}.txt")}
        assert found == parse_by_hand(text, prefix)


def test_scrape_in_parts(spark, folder):
    """Parts follow each other by their numbers, also beyond the five digits of a name and the three of a file."""
    names = ["part-00000-a-c9f-c000", "part-00000-a-c9f-c999", "part-00000-a-c9f-c1000", "part-00009-a-c9f-c000", "part-99999-a-c9f-c000", "part-100000-a-c9f-c000"]
    for text, last in (("one", 6), ("two", 5)):
        os.makedirs(os.path.join(folder, text))
        for i, name in enumerate(names[:last]):
            with open(os.path.join(folder, text, f"{name}.txt"), "w") as out:
                out.write(f"up_all {i}\nup_{i} 1\nup_{i} 2\n")
    got = metrics.parse_metric_lines(read_scrapes(spark, os.path.join(folder, "*"), parts=True), "up").collect()
    for text, last in (("one", 6), ("two", 5)):
        found = {r.name: r.value for r in got if r.source.endswith(f"/{text}")}
        assert found == {"up_all": last - 1.0, **{f"up_{i}": 2.0 for i in range(last)}}


def test_scrapes_written_by_many_tasks(spark, folder, monkeypatch):
    """No task gets all texts: the one file of them took memory that grew with the events."""
    from undercut.plans import queries

    monkeypatch.setattr(queries, "shared_folder", lambda session, purpose: os.path.join(folder, purpose))
    at = "2024-01-01 00:00:00"
    rows = [(i, dt.datetime.fromisoformat(at), i % 7, "view", i / 4, "{}") for i in random.Random(3).sample(range(4000), 4000)]
    events = spark.createDataFrame(rows, inputs.TABLES["events"])
    events.repartition(3).write.parquet(os.path.join(folder, "in", "events.parquet"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = queries.QUERIES["scrapes_from_files"](spark, os.path.join(folder, "in")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(map(tuple, got)) == [("ml_consumer_errors_total", 150.0), ("ml_consumer_messages_consumed_total", 3999 / 4)]
    sizes = [os.path.getsize(os.path.join(folder, "scrapes", f)) for f in os.listdir(os.path.join(folder, "scrapes")) if f.startswith("part-")]
    assert len(sizes) == 4 and 2 * max(sizes) < sum(sizes)


def test_counters_and_summary(spark):
    rows = events_df(spark, event(), event(lap=None), event(car_id="CAR_02", sector=99), event(fuel_load_kg=math.nan))
    assert tuple(metrics.scoring_counters(rows).first()) == (4, 2, 2)
    undecoded = rows.withColumn("decoded", F.col("sector") != 99)
    assert tuple(metrics.scoring_counters(undecoded).first()) == (3, 1, 3)
    assert tuple(metrics.publish_summary(validate_events(rows)).first()) == (2, 1, 3)


def test_topic_stats(spark):
    df = spark.createDataFrame([(0, 5), (0, 9), (1, 0)], "p int, o long")
    stats = metrics.topic_stats(df, "p", "o")
    assert {tuple(r) for r in stats.collect()} == {(0, 5, 10, 2), (1, 0, 1, 1)}
    assert metrics.topic_has_records(stats).first()[0] is True
    assert metrics.topic_has_records(metrics.topic_stats(df.limit(0), "p", "o")).first()[0] is False
