import random

from pyspark.sql import functions as F

from undercut.functions.ids import key_partition, string_hash
from undercut.operators.placement import write_placed
from undercut.operators.recent import PARTITION


def hash31(text):
    h = 0
    units = text.encode("utf-16-be")
    for i in range(0, len(units), 2):
        h = (h * 31 + int.from_bytes(units[i : i + 2], "big")) & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


def test_hash(spark):
    rng = random.Random(4)
    keys = ["CAR_01", "", "polygenelubricants", "naïve-Ωß", "🏁", "a🏁b🏎c", "x" * 300]
    keys += ["".join(rng.choice("abcXYZ019_é漢😀") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    got = spark.createDataFrame([(k,) for k in keys], "k string").select(string_hash(F.col("k"))).collect()
    assert [r[0] for r in got] == [hash31(k) for k in keys]
    assert hash31("CAR_01") == 1980717676 and hash31("polygenelubricants") == -(2**31)


def test_stable_and_in_bounds(spark):
    cars = spark.range(1, 21).select(F.concat(F.lit("CAR_"), F.lpad(F.col("id").cast("string"), 2, "0")).alias("k"))
    part = key_partition(F.col("k"), 20)
    first, second = (sorted(cars.select("k", part.alias("p")).collect()) for _ in range(2))
    assert first == second and all(0 <= r.p < 20 for r in first)
    lowest = spark.createDataFrame([("polygenelubricants",)], "k string").select(part).first()[0]
    assert lowest == 2**31 % 20
    nulls = spark.range(50).select(key_partition(F.lit(None).cast("string"), 20).alias("p")).collect()
    assert all(0 <= r.p < 20 for r in nulls)


def test_write_placed_keeps_a_car_together(spark, folder):
    df = spark.range(1000).select(F.concat(F.lit("CAR_"), (F.col("id") % 7).cast("string")).alias("car_id"), "id")
    write_placed(df, folder, "car_id", 5)
    back = spark.read.parquet(folder)
    assert back.count() == 1000
    assert back.groupBy("car_id").agg(F.count_distinct(PARTITION).alias("n")).where("n > 1").count() == 0
