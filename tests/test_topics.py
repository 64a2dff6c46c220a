import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from undercut.schemas import PREDICTION
from undercut.sources import topics
from undercut.sources.topics import as_topic_records, read_topic, topic_options


def test_options_start_at_the_earliest_record():
    assert topic_options("h:1", "t") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest",
    }
    assert topic_options("h:1", "t", "latest", 10)["maxOffsetsPerTrigger"] == "10"


def test_missing_package_is_named(spark):
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        read_topic(spark, "h:1", "t", PREDICTION, streaming=False)


def test_records(spark):
    df = spark.createDataFrame([("CAR_01", 5, 0.5, False, "m")], PREDICTION)
    row = as_topic_records(df, "car_id").first()
    assert row.key == "CAR_01" and row.value.startswith('{"car_id":"CAR_01","timestamp_ms":5')


def test_records_carry_headers_and_tombstones(spark):
    rows = [("a", 1, {"X-One": "eins", "X-Two": "zw\u00f6lf"}, False), ("b", 2, None, True), ("c", None, {}, None)]
    df = spark.createDataFrame(rows, "car_id string, lap int, notes map<string,string>, gone boolean")
    records = topics.as_topic_records(df.select("car_id", "lap", "notes", "gone"), "car_id", "notes", F.col("gone"))
    assert dict(records.dtypes)["headers"] == "array<struct<key:string,value:binary>>"
    found = {r.key: r for r in records.collect()}
    assert [(h.key, bytes(h.value).decode()) for h in found["a"].headers] == [("X-One", "eins"), ("X-Two", "zw\u00f6lf")]
    assert json.loads(found["a"].value) == {"car_id": "a", "lap": 1, "gone": False}
    assert found["b"].value is None and found["b"].headers is None
    assert found["c"].value is not None and found["c"].headers == []


def test_undecodable_values_become_dead_letters(spark):
    schema = T.StructType([T.StructField("car_id", T.StringType()), T.StructField("lap", T.IntegerType())])
    values = [("a", b'{"car_id": "a", "lap": 3}'), ("b", b"{broken"), ("c", b'{"car_id": "c", "lap": "many"}'), ("d", None), (None, b"")]
    records = topics.decoded(spark.createDataFrame(values, "key string, value binary"), schema)
    found = {r.key: r for r in records.collect()}
    assert found["a"].row.asDict() == {"car_id": "a", "lap": 3} and not found["a"].undecodable
    assert found["d"].row is None and not found["d"].undecodable
    assert all(found[k].row is None and found[k].undecodable for k in ("b", "c", None))
    letters = topics.dead_letter_records(topics.undecodable_letters(records, "raw", as_of_ms=7)).collect()
    assert sorted(r.value for r in letters) == ["", '{"car_id": "c", "lap": "many"}', "{broken"]
    names = {h.key: bytes(h.value).decode() for h in next(r for r in letters if r.key == "b").headers}
    assert names["X-Original-Topic"] == "raw" and names["X-Exception-Class"] == "DecodingError" and names["X-Original-Car-Id"] == "b"
    assert {r.key for r in letters} == {"b", "c", "UNKNOWN"}
