import json
import os

import pytest
from conftest import circuits_df, drivers_df, event, events_df, nullable
from pyspark.sql import functions as F

from undercut.operators import features, model
from undercut.operators.enrich import enrich
from undercut.operators.hopping import hop_metrics
from undercut.operators.metrics import counter_rate, metric_latest
from undercut.schemas import AGGREGATES, DEAD_LETTER, DRIVERS, ENRICHED, TELEMETRY, changes_schema
from undercut.sources.changes import read_dimension
from undercut.sources.events import read_events
from undercut.sources.sinks import as_json_rows, read_batches, with_event_date, write_batch
from undercut.streaming import deployment
from undercut.streaming.aggregation import read_aggregates, start_aggregation
from undercut.streaming.enrichment import read_enriched, start_enrichment
from undercut.streaming.quarantine import start_quarantine
from undercut.streaming.scoring import read_counters, read_predictions, start_scoring
from undercut.shared import shared_folder

NOW = {"availableNow": True}


def put(spark, path, *rows):
    """Add one file of events to a folder."""
    events_df(spark, *rows).coalesce(1).write.mode("append").parquet(path)


def laps(seconds, **changes):
    return [event(timestamp_ms=1_000_000_000_000 + s * 1000, speed_kph=100.0 + s % 50, **changes) for s in seconds]


@pytest.fixture
def enrichment(spark, folder):
    """Starter of an enrichment whose driver dimension is a growing change log."""
    log = f"{folder}/drivers"

    def change(seq, name):
        row = ("u", seq, "db.public.drivers", "DRV_01", ("DRV_01", name, "ABC", "T", 1, "N", 0, 0))
        spark.createDataFrame([row], changes_schema(DRIVERS)).coalesce(1).write.mode("append").parquet(log)

    def start(name="enrichment", trigger=NOW):
        events = read_events(spark, f"{folder}/raw", streaming=True, files_per_batch=1)
        return start_enrichment(
            events,
            lambda s: (circuits_df(s, "C01"), read_dimension(s, log, DRIVERS, "driver_id")),
            f"{folder}/enriched",
            f"{folder}/cp-enrich",
            name=name,
            as_of_ms=1,
            trigger=trigger,
        )

    return start, change


def test_dimension_is_read_anew_and_past_is_kept(spark, folder, enrichment):
    start, change = enrichment
    change(1, "first")
    put(spark, f"{folder}/raw", *laps([1]))
    start().awaitTermination()
    change(2, "second")
    put(spark, f"{folder}/raw", *laps([2]))
    start().awaitTermination()
    rows = read_enriched(spark, f"{folder}/enriched").orderBy("timestamp_ms").collect()
    assert [r.driver_full_name for r in rows] == ["first", "second"]
    assert [r.batch_id for r in rows] == [0, 1] and all(r.enriched for r in rows)


def test_running_query_sees_new_dimension_rows(spark, folder, enrichment):
    start, change = enrichment
    change(1, "first")
    put(spark, f"{folder}/raw", *laps([1]))
    running = start(trigger={"processingTime": "0 seconds"})
    try:
        running.processAllAvailable()
        change(2, "second")
        put(spark, f"{folder}/raw", *laps([2]))
        running.processAllAvailable()
    finally:
        running.stop()
    rows = read_enriched(spark, f"{folder}/enriched").orderBy("timestamp_ms").collect()
    assert [r.driver_full_name for r in rows] == ["first", "second"]


def test_aggregates_equal_batch_over_many_micro_batches(spark, folder, enrichment):
    start, change = enrichment
    change(1, "first")
    put(spark, f"{folder}/raw", *laps(range(0, 40)), *laps(range(0, 40, 3), car_id="CAR_02"))
    put(spark, f"{folder}/raw", *laps(range(40, 70)))
    put(spark, f"{folder}/raw", *laps([5, 6, 7]), event(timestamp_ms=5_000), event(timestamp_ms=-1))  # late, bad
    start().awaitTermination()

    def aggregate():
        start_aggregation(
            read_enriched(spark, f"{folder}/enriched", streaming=True),
            f"{folder}/aggregates",
            f"{folder}/cp-agg",
            trigger=NOW,
            state_partitions=3,
        ).awaitTermination()

    aggregate()
    put(spark, f"{folder}/raw", *laps(range(65, 90)))
    start().awaitTermination()
    aggregate()
    batch = hop_metrics(read_enriched(spark, f"{folder}/enriched"))
    got = read_aggregates(spark, f"{folder}/aggregates")
    assert got.columns == AGGREGATES.names

    def rounded(df):
        return sorted((r.car_id, r.window_start_ms, round(r.avg_speed_kph, 9), r.max_speed_kph, r.event_count) for r in df.collect())

    fresh = "window_start_ms > 1000000"  # the event of 1970 arrives a day too late for a started query
    assert rounded(got.where(fresh)) == rounded(batch.where(fresh))
    emitted = read_batches(spark, f"{folder}/aggregates", AGGREGATES, "json")
    assert emitted.count() > got.count()  # a changed window is emitted again
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def aggregated(spark, folder):
    start_aggregation(
        read_enriched(spark, f"{folder}/enriched", streaming=True),
        f"{folder}/aggregates", f"{folder}/cp-agg", trigger=NOW, state_partitions=2,
    ).awaitTermination()
    return sorted((r.car_id, r.window_start_ms, r.event_count) for r in read_aggregates(spark, f"{folder}/aggregates").collect())


def test_retried_batch_is_counted_once(spark, folder):
    """A batch is committed, breaks off before it is in place, is read on, and runs again."""
    rows = enrich(events_df(spark, *laps(range(20))), circuits_df(spark, "C01"), drivers_df(spark, "DRV_01"), 1)
    batch = with_event_date(rows).repartition(4)
    path = f"{folder}/enriched"
    os.makedirs(path)
    assert aggregated(spark, folder) == []
    write_batch(batch, path, 0, by=("event_date",))
    attempt = f"{path}/_attempts/" + json.load(open(f"{path}/_log/batch-0.json"))["attempt"]
    os.rename(f"{path}/batch_id=0", attempt)
    assert aggregated(spark, folder) == []  # not in place
    write_batch(batch.orderBy(F.desc("timestamp_ms")), path, 0, by=("event_date",))  # other rows per file
    counts = aggregated(spark, folder)
    assert counts == sorted((r.car_id, r.window_start_ms, r.event_count) for r in hop_metrics(rows).collect())
    assert read_batches(spark, path, ENRICHED).count() == 20


def test_impossible_records_do_not_stop_the_enrichment(spark, folder):
    put(spark, f"{folder}/raw", *laps([1]), event(timestamp_ms=2**63 - 1), event(timestamp_ms=-(2**63)), event(lap=None))
    start_enrichment(
        read_events(spark, f"{folder}/raw", streaming=True),
        lambda s: (circuits_df(s, "C01"), drivers_df(s, "DRV_01")),
        f"{folder}/enriched", f"{folder}/cp", as_of_ms=1, trigger=NOW, dead_path=f"{folder}/dead",
    ).awaitTermination()
    assert read_enriched(spark, f"{folder}/enriched").count() == 1
    letters = read_batches(spark, f"{folder}/dead", DEAD_LETTER).collect()
    assert sorted(r.headers["X-Error-Message"] for r in letters) == ["lap", "timestamp_ms", "timestamp_ms"]
    # Without that branch they are carried along, and left out of the windows.
    start_enrichment(
        read_events(spark, f"{folder}/raw", streaming=True),
        lambda s: (circuits_df(s, "C01"), drivers_df(s, "DRV_01")),
        f"{folder}/all", f"{folder}/cp-all", as_of_ms=1, trigger=NOW,
    ).awaitTermination()
    carried = read_enriched(spark, f"{folder}/all")
    assert carried.count() == 4 and hop_metrics(carried).count() > 0


def test_quarantine_stream(spark, folder):
    put(spark, f"{folder}/raw", event(), event(sector=99), event(car_id="CAR_02"))
    put(spark, f"{folder}/raw", event(lap=None))
    start_quarantine(
        read_events(spark, f"{folder}/raw", streaming=True, files_per_batch=1),
        f"{folder}/valid", f"{folder}/dead", f"{folder}/cp", as_of_ms=1, trigger=NOW,
    ).awaitTermination()
    assert read_batches(spark, f"{folder}/valid", TELEMETRY).count() == 2
    letters = read_batches(spark, f"{folder}/dead", DEAD_LETTER).collect()
    assert sorted(r.headers["X-Error-Message"] for r in letters) == ["lap", "sector"]
    assert all('"car_id":"CAR_01"' in r.value for r in letters)


def test_scoring_counts_and_skips_bad_rows(spark, folder):
    forest = model.train(features.training_table(spark, 500))
    put(spark, f"{folder}/raw", event(), event(lap=None), event(car_id="CAR_02"))
    put(spark, f"{folder}/raw", event(speed_kph=None), event(car_id="CAR_03"))

    times = iter([10, 20, 40])

    def run():
        events = read_events(spark, f"{folder}/raw", streaming=True, files_per_batch=1)
        start_scoring(events, forest, f"{folder}/out", f"{folder}/cp", trigger=NOW, clock=lambda: next(times)).awaitTermination()

    run()
    put(spark, f"{folder}/raw", event(car_id="CAR_04"))
    run()  # another driver goes on counting
    latest = {r.series: r.value for r in metric_latest(read_counters(spark, f"{folder}/out")).collect()}
    assert latest == {"consumed": 6, "emitted": 4, "errors": 2}
    counts = read_counters(spark, f"{folder}/out").groupBy("batch_id").pivot("series").sum("count").collect()
    assert len(counts) == 3 and all(r.consumed == r.emitted + r.errors for r in counts)
    first = read_counters(spark, f"{folder}/out").where("series = 'consumed' and batch_id = 0").first().value
    rates = counter_rate(read_counters(spark, f"{folder}/out"), 60).where("series = 'consumed'").orderBy("ts").collect()
    assert rates[-1].rate == pytest.approx((6 - first) / 30)
    assert sorted(r.car_id for r in read_predictions(spark, f"{folder}/out").collect()) == [f"CAR_0{i}" for i in (1, 2, 3, 4)]


def test_deployment(spark, folder):
    put(spark, f"{folder}/raw", event())
    order = []

    def starter(name):
        order.append(name)
        events = read_events(spark, f"{folder}/raw", streaming=True)
        return (
            events.writeStream.queryName(name).format("noop").option("checkpointLocation", f"{folder}/cp-{name}").start()
        )

    starters = {"02_metrics": starter, "01_source": starter}
    try:
        first = deployment.deploy(spark, starters)
        again = deployment.deploy(spark, starters)
        assert order == ["01_source", "02_metrics"]
        assert {n: q.runId for n, q in first.items()} == {n: q.runId for n, q in again.items()}
        for query in first.values():
            query.processAllAvailable()
        renewed = deployment.redeploy(spark, {"01_source": starter})
        assert order[2:] == ["01_source"] and renewed["01_source"].runId != first["01_source"].runId
        assert renewed["01_source"].id == first["01_source"].id
        renewed["01_source"].processAllAvailable()
    finally:
        stopped = deployment.stop(spark)
    assert stopped == ["01_source", "02_metrics"]
    assert deployment.active_queries(spark) == {}


def test_json_rows_and_json_events(spark, folder):
    row = ("CAR_01", 0, 30_000, float("nan"), 1.0, 2.0, float("inf"), 3)
    value = as_json_rows(spark.createDataFrame([row], AGGREGATES)).first().value
    assert "NaN" not in value and "Infinity" not in value and '"event_count":3' in value
    events_df(spark, event()).write.json(folder)
    with open(f"{folder}/bad.json", "w") as out:
        out.write("{not json\n")
    rows = read_events(spark, folder, nullable(TELEMETRY), fmt="json").collect()
    assert sorted(str(r.car_id) for r in rows) == ["CAR_01", "None"]


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark, "x").startswith(f"{base}/x-")


def test_enriched_layout(spark, folder):
    rows = enrich(events_df(spark, event()), circuits_df(spark, "C01"), drivers_df(spark, "DRV_01"), 1)
    write_batch(rows.withColumn("event_date", F.lit("2024-01-01").cast("date")), folder, 0, by=("event_date",))
    back = read_enriched(spark, folder)
    assert back.select(*ENRICHED.names).count() == 1 and back.first().batch_id == 0
