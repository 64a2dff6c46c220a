import math

import pytest
from conftest import event, events_df
from pyspark.sql import functions as F

from undercut.operators import features, model

# Sum of the first feature over 200 training rows, on any number of cores.
TRAINING_WEAR = 103.85493871632805


def test_features(spark):
    row = features.pit_features(events_df(spark, event(lap=250, speed_kph=math.inf, fuel_load_kg=-5.0))).first()
    got = [row[name] for name in features.FEATURES]
    assert got == pytest.approx([100 / 400, 366 / 600, 0.0, 1.0, 0.5, 1.0])
    assert features.pit_features(events_df(spark, event())).first().lap == 0.05


@pytest.mark.parametrize(
    "change", [{"lap": None}, {"tire_wear_rl": None}, {"speed_kph": math.nan}, {"timestamp_ms": None}]
)
def test_unscorable(spark, change):
    assert features.pit_features(events_df(spark, event(**change), event())).count() == 1


def test_labels(spark):
    rows = [(0.73, 0.9), (0.72, 0.1), (0.72, 0.28), (0.53, 0.27), (0.52, 0.1)]
    df = spark.createDataFrame(rows, "w double, f double")
    got = [r[0] for r in df.select(features.label_rule(F.col("w"), F.col("f"))).collect()]
    assert got == [1, 1, 0, 1, 0]
    table = features.training_table(spark, 1000)
    assert table.columns == [*features.FEATURES, "label"] and table.count() == 1000
    assert table.select("label").distinct().count() == 2


def test_forest_learns_the_rule(spark, folder):
    model.save(model.train(features.training_table(spark)), folder + "/model")
    forest = model.load(folder + "/model")
    assert forest.stages[1].getNumTrees == 64
    wear = F.col("id") % 101
    base = events_df(spark, event()).crossJoin(spark.range(3000))
    events = base.withColumns(
        {f"tire_wear_{c}": wear.cast("double") for c in ("fl", "fr", "rl", "rr")}
        | {"fuel_load_kg": ((F.col("id") * 7) % 121).cast("double")}
    )
    scored = model.score(events, forest)
    assert scored.columns == [*events.columns, "pit_probability"]
    rule = features.label_rule(F.col("wear"), F.col("fuel"))
    joined = features.pit_features(scored).select(
        (features.recommend_pit(F.col("pit_probability")).cast("int") == rule).alias("same"), "pit_probability"
    )
    share, low, high = joined.agg(F.avg(F.col("same").cast("int")), F.min("pit_probability"), F.max("pit_probability")).first()
    assert share > 0.97 and 0.0 <= low and high <= 1.0


def test_prediction_row(spark):
    df = events_df(spark, event()).withColumn("pit_probability", F.lit(0.65))
    assert tuple(features.prediction_rows(df).first()) == ("CAR_01", 1000, 0.65, True, "rf-1.0.0")
    assert features.prediction_rows(df, threshold=0.7, version="x").first().recommend_pit is False


def test_training_rows_do_not_depend_on_the_cluster(spark):
    rows = features.training_table(spark, 200).collect()
    assert features.training_table(spark, 200).rdd.getNumPartitions() == features.TRAINING_PARTITIONS
    assert abs(sum(r.wear for r in rows) - TRAINING_WEAR) < 1e-9
