import datetime as dt

from pyspark.sql import functions as F

from undercut.operators.cdc import compact_changes, latest_by_key, route_topic, snapshot_changes, unwrap_changes, within_retention
from undercut.schemas import DRIVERS, changes_schema
from undercut.sources.changes import (
    read_changes, read_dimension, read_routed_dimension, take_snapshot, write_routed,
)


def driver(key, name):
    return (key, name, "ABC", None, 1, None, 0, 0)


LOG = [
    ("r", 0, "db.public.drivers", "D1", driver("D1", "old")),
    ("r", 0, "db.public.drivers", "D2", driver("D2", "two")),
    ("u", 5, "db.public.drivers", "D1", driver("D1", "new")),
    ("d", 6, "db.public.drivers", "D2", None),
    ("c", 7, "db.public.drivers", "D3", driver("D3", "three")),
    ("d", 8, "db.public.drivers", "D3", None),
    (None, 9, "db.public.drivers", "D3", None),
    ("c", 10, "db.public.drivers", "D4", driver("D4", "four")),
    ("d", 11, "db.public.drivers", "D4", None),
    ("c", 12, "db.public.drivers", "D4", driver("D4", "again")),
]


def log(spark):
    return spark.createDataFrame(LOG, changes_schema(DRIVERS))


def test_unwrap(spark):
    rows = unwrap_changes(log(spark), "driver_id").orderBy("seq").collect()
    assert sorted(r.driver_id for r in rows) == sorted(r[3] for r in LOG)
    by_seq = {r.seq: r for r in rows if r.seq}
    assert by_seq[5].full_name == "new" and by_seq[5]["__deleted"] is False
    assert by_seq[6].driver_id == "D2" and by_seq[6].full_name is None and by_seq[6]["__deleted"] is True
    assert by_seq[9].driver_id == "D3" and by_seq[9]["__deleted"] is None


def test_latest(spark):
    latest = latest_by_key(unwrap_changes(log(spark), "driver_id"), "driver_id")
    assert latest.columns == DRIVERS.names
    assert {(r.driver_id, r.full_name) for r in latest.collect()} == {("D1", "new"), ("D4", "again")}


def test_compaction_keeps_the_latest_values(spark):
    compact = compact_changes(log(spark))
    assert compact.columns == log(spark).columns
    assert {(r.key, r.seq, r.op) for r in compact.collect()} == {("D1", 5, "u"), ("D2", 6, "d"), ("D3", 9, None), ("D4", 12, "c")}
    latest = [latest_by_key(unwrap_changes(c, "driver_id"), "driver_id") for c in (log(spark), compact)]
    assert sorted(latest[0].collect()) == sorted(latest[1].collect())


def test_dimension_from_files_sees_new_rows(spark, folder):
    log(spark).where("seq < 5").write.parquet(folder)
    assert read_changes(spark, folder, DRIVERS).count() == 2
    before = {r.full_name for r in read_dimension(spark, folder, DRIVERS, "driver_id").collect()}
    log(spark).where("seq >= 5").write.mode("append").parquet(folder)
    after = {r.full_name for r in read_dimension(spark, folder, DRIVERS, "driver_id").collect()}
    assert (before, after) == ({"old", "two"}, {"new", "again"})


def test_snapshot(spark):
    table = spark.createDataFrame([driver("D1", "one")], DRIVERS)
    row = snapshot_changes(table, "driver_id", "db.public.drivers").first()
    assert (row.op, row.seq, row.key, row.after.full_name) == ("r", 0, "D1", "one")


def test_routes_match_the_whole_name(spark):
    names = ["racing.public.circuits", "x.public.drivers", "x.public.drivers_old", "a.b.public.circuits", "other"]
    df = spark.createDataFrame([(n,) for n in names], "t string").select(route_topic(F.col("t")))
    assert [r[0] for r in df.collect()] == [
        "circuit-metadata", "driver-profiles", "x.public.drivers_old", "a.b.public.circuits", "other",
    ]


def test_retention_prunes_dates(spark, folder):
    day = 86_400_000
    df = spark.range(10).select((F.col("id") * day + 5).alias("timestamp_ms"))
    dated = df.withColumn("event_date", F.to_date(F.timestamp_millis("timestamp_ms")))
    dated.write.partitionBy("event_date").parquet(folder)
    kept = within_retention(spark.read.parquet(folder), 2 * day, 9 * day)
    assert sorted(r.timestamp_ms for r in kept.collect()) == [7 * day + 5, 8 * day + 5, 9 * day + 5]
    assert dt.date(1970, 1, 8) in {r.event_date for r in kept.collect()}
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_second_read_takes_the_snapshot_and_newer_batches_only(spark, folder):
    schema = changes_schema(DRIVERS)

    def change(seq, key, name, op="u"):
        after = None if op == "d" else (key, name, "ABC", "T", 1, "N", 0, 0)
        return (op, seq, "db.public.drivers", key, after)

    def put(batch, *rows):
        write_routed(spark.createDataFrame(rows, schema), f"{folder}/log", batch)

    put(0, change(1, "D1", "old"), change(2, "D2", "two"), ("u", 3, "db.public.orders", "D1", None))
    take_snapshot(spark, f"{folder}/log", f"{folder}/snap", DRIVERS, "driver-profiles")
    put(1, change(4, "D1", "new"), change(5, "D2", None, "d"), change(6, "D3", "three"))
    arguments = (spark, f"{folder}/log", f"{folder}/snap", DRIVERS, "driver-profiles", "driver_id")
    found = read_routed_dimension(*arguments)
    assert {(r.driver_id, r.full_name) for r in found.collect()} == {("D1", "new"), ("D3", "three")}
    read = {f.split("/log/")[-1].split("/")[0] for f in found.inputFiles() if "/log/" in f}
    assert read == {"batch_id=1"} and any("/snap/" in f for f in found.inputFiles())
    take_snapshot(spark, f"{folder}/log", f"{folder}/snap", DRIVERS, "driver-profiles")
    again = read_routed_dimension(*arguments)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, found.collect()))
    assert not any("/log/" in f for f in again.inputFiles())
