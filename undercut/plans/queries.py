"""The registered queries: each runs one operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from undercut.functions import ids, numeric
from undercut.operators import cdc, enrich, features, forest, hopping, metrics, model, quality, recent, reference
from undercut.operators.placement import write_placed
from undercut.plans import inputs
from undercut.plans.inputs import project, project_stream, table
from undercut.schemas import AGGREGATES, DEAD_LETTER, PREDICTION, RETENTION_MS, TELEMETRY, TOPIC_PARTITIONS
from undercut.sources.changes import dimension_version, read_changes, read_routed_dimension, take_snapshot, write_routed
from undercut.sources.events import read_events
from undercut.sources.merged import merge_changes, read_merged
from undercut.sources.scrapes import read_scrapes
from undercut.sources.sinks import as_json_rows, expire, read_batches, with_event_date, write_batch
from undercut.sources.tables import load_reference
from undercut.sources.tails import append_records, read_tail
from undercut.streaming.aggregation import fold_aggregates, read_aggregates, start_aggregation
from undercut.streaming.enrichment import read_enriched, start_enrichment
from undercut.streaming.quarantine import start_quarantine
from undercut.streaming.scoring import read_counters, read_predictions, start_scoring
from undercut.shared import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RAW_TOPIC = "raw-telemetry"
NOW = {"availableNow": True}
EVENT_ID = T.StructField("event_id", T.LongType())
RATE_RANGE_S = 3600


def query(function: Query) -> Query:
    """Register a query under its function name. None depends on or alters the session's settings."""
    QUERIES[function.__name__] = function
    return function


# Inputs


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(spark, sf_dir, inputs.TELEMETRY_SQL)


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(spark, sf_dir, inputs.DIRTY_SQL)


def reference_rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    texts = {
        "circuits": inputs.CIRCUITS_SQL,
        "teams": inputs.TEAMS_SQL,
        "drivers": inputs.DRIVERS_SQL,
        "regulations": inputs.REGULATIONS_SQL,
    }
    return reference.reference_table(project(spark, sf_dir, texts[name]), name)


def dimensions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return reference_rows(spark, sf_dir, "circuits"), reference_rows(spark, sf_dir, "drivers")


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich(telemetry(spark, sf_dir), *dimensions(spark, sf_dir), as_of_ms=inputs.AS_OF_MS)


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = project(spark, sf_dir, inputs.CHANGES_SQL)
    image = F.struct("o_custkey", "o_orderstatus", "o_totalprice")
    gone = F.col("op").isNull() | (F.col("op") == "d")
    return rows.select("op", "seq", "source_table", "key", F.when(~gone, image).alias("after"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(spark, sf_dir, inputs.SAMPLES_SQL)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction rows with the mean wear as probability."""
    share = (numeric.corner_sum("tire_wear") / 4.0) / 100.0
    scored = telemetry(spark, sf_dir).withColumn("pit_probability", share)
    return features.prediction_rows(scored, keep=("event_id",))


def positioned(df: DataFrame, partitions: int) -> DataFrame:
    """Rows as records of a topic: ids dealt out over the partitions."""
    return recent.with_position(df, F.col("event_id") % partitions, F.expr(f"event_id div {partitions}"))


# Scans, event time, identifiers


@query
def events_from_json(spark, sf_dir):
    """Events written as JSON and read back with their declared types."""
    folder = shared_folder(spark, "json-events")
    telemetry(spark, sf_dir).select(*TELEMETRY.names).write.json(folder)
    return read_events(spark, folder, fmt="json")


@query
def sensors_quantised(spark, sf_dir):
    """All sixteen readings, after a scale that leaves more decimals."""
    scaled = {c: F.col(c) * 1.37 - 20.0 for c in quality.QUANTISED}
    return quality.quantise_sensors(telemetry(spark, sf_dir).withColumns(scaled)).select("event_id", *quality.QUANTISED)


@query
def placed_by_car(spark, sf_dir):
    """Events written by the partition of their car and counted per folder."""
    folder = shared_folder(spark, "placed")
    write_placed(telemetry(spark, sf_dir), folder, "car_id", TOPIC_PARTITIONS[RAW_TOPIC])
    placed = spark.read.schema("event_id long, car_id string, _kafka_partition int").parquet(folder)
    return placed.groupBy("_kafka_partition", "car_id").agg(F.count("*").alias("n"))


@query
def reference_from_files(spark, sf_dir):
    """Drivers with their teams, from the four tables written as files and loaded with declared types."""
    folder, names = shared_folder(spark, "reference"), ("circuits", "teams", "drivers", "regulations")
    for name in names:
        reference_rows(spark, sf_dir, name).write.parquet(f"{folder}/{name}")
    loaded = load_reference(spark, folder)
    drivers = loaded["drivers"].select("driver_id", "full_name", "team_id", "championships")
    return drivers.join(loaded["teams"].select("team_id", "team_name"), "team_id", "left")


@query
def scrapes_from_files(spark, sf_dir):
    """Metric texts as files of lines: of each name the last value in the order of events.

    Events are sorted before they become texts, and each range of them is a file of its own.
    """
    folder = shared_folder(spark, "scrapes")
    texts = spark.sql(inputs.METRIC_TEXT_SQL, events=inputs.table(spark, sf_dir, "events").orderBy("event_id"))
    texts.select(F.col("text").alias("value")).write.text(folder)
    return metrics.parse_metric_lines(read_scrapes(spark, folder, parts=True), "ml_consumer").select("name", "value")


@query
def scan_telemetry(spark, sf_dir):
    return telemetry(spark, sf_dir).select(*TELEMETRY.names)


@query
def event_time_source(spark, sf_dir):
    return hopping.events_with_time(dirty(spark, sf_dir)).select("event_id", "timestamp_ms", "event_time")


@query
def extract_circuit_id(spark, sf_dir):
    sessions = project(spark, sf_dir, inputs.SESSIONS_SQL)
    return sessions.withColumn("circuit_id", ids.circuit_id(F.col("session_id")))


@query
def key_partition(spark, sf_dir):
    return telemetry(spark, sf_dir).select(
        "event_id",
        ids.key_partition(F.col("car_id"), TOPIC_PARTITIONS[RAW_TOPIC]).alias("car_partition"),
        ids.key_partition(F.col("session_id"), 7).alias("session_partition"),
    )


# Enrichment and windows


@query
def enrich_circuit(spark, sf_dir):
    circuits, _ = dimensions(spark, sf_dir)
    return enrich.enrich_circuit(telemetry(spark, sf_dir), circuits)


@query
def enrich_driver(spark, sf_dir):
    _, drivers = dimensions(spark, sf_dir)
    return enrich.enrich_driver(telemetry(spark, sf_dir), drivers)


@query
def enrich_full(spark, sf_dir):
    return enriched(spark, sf_dir)


@query
def hop_metrics(spark, sf_dir):
    return hopping.hop_metrics(enriched(spark, sf_dir))


@query
def aggregates_json(spark, sf_dir):
    rows = as_json_rows(hopping.hop_metrics(enriched(spark, sf_dir)))
    return rows.select("key", F.from_json("value", AGGREGATES).alias("row")).select("key", "row.*")


# Quality


@query
def quantise_sensors(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    reading = F.col("value") * 1.37 - 20.0
    return events.select("event_id", numeric.quantise2(reading).alias("q"))


@query
def validate_events(spark, sf_dir):
    return quality.validate_events(dirty(spark, sf_dir)).select("event_id", "is_valid")


@query
def quarantine_reasons(spark, sf_dir):
    return quality.quarantined(quality.validate_events(dirty(spark, sf_dir))).select("event_id", "reason")


def letter_columns(letters: DataFrame) -> DataFrame:
    """Dead letters with each header in a column of its own."""
    headers = {
        "error_message": "X-Error-Message",
        "original_topic": "X-Original-Topic",
        "error_timestamp": "X-Error-Timestamp",
        "exception_class": "X-Exception-Class",
        "original_car_id": "X-Original-Car-Id",
    }
    return letters.select("key", "value", *[F.col("headers")[h].alias(name) for name, h in headers.items()])


@query
def dead_letter(spark, sf_dir):
    bad = quality.quarantined(quality.validate_events(dirty(spark, sf_dir)))
    record = F.to_json(F.struct(*TELEMETRY.names))
    letters = quality.to_dead_letter(bad, F.col("reason"), RAW_TOPIC, record=record, as_of_ms=inputs.AS_OF_MS)
    return letter_columns(letters)


@query
def dead_letter_async(spark, sf_dir):
    """Letters of publish failures, where only the key and a (long) cause are known."""
    failed = telemetry(spark, sf_dir).withColumn(
        "cause", F.when(F.col("drs_active"), F.repeat("session_id", F.col("lap")))
    )
    return letter_columns(
        quality.to_dead_letter(
            failed, F.col("cause"), RAW_TOPIC, exception_class="PublishError", as_of_ms=inputs.AS_OF_MS
        )
    )


@query
def sanitize_numeric(spark, sf_dir):
    rows = project(spark, sf_dir, inputs.NON_FINITE_SQL)
    nested = rows.select(
        "event_id",
        "reading",
        F.array("value", "reading").alias("items"),
        F.create_map(F.lit("a"), "reading", F.lit("b"), "value").alias("named"),
        F.struct(F.col("reading").alias("x"), F.array(F.struct("reading")).alias("inner")).alias("deep"),
    )
    clean = quality.sanitize_numeric(nested)
    return clean.select(
        "event_id",
        "reading",
        F.col("items")[0].alias("item_0"),
        F.col("items")[1].alias("item_1"),
        F.col("named")["a"].alias("named_a"),
        F.col("named")["b"].alias("named_b"),
        F.col("deep.x").alias("deep_x"),
        F.col("deep.inner")[0]["reading"].alias("deep_inner"),
    )


# Features and scores


@query
def pit_flag(spark, sf_dir):
    return predictions(spark, sf_dir).select("event_id", "pit_probability", "recommend_pit")


@query
def prediction_rows(spark, sf_dir):
    return predictions(spark, sf_dir).select(*PREDICTION.names)


@query
def pit_features(spark, sf_dir):
    events = project(spark, sf_dir, inputs.GAPPY_SQL)
    return features.pit_features(events).select("event_id", *features.FEATURES)


@query
def pit_label_rule(spark, sf_dir):
    rows = features.pit_features(telemetry(spark, sf_dir))
    return rows.select("event_id", features.label_rule(F.col("wear"), F.col("fuel")).alias("label"))


MODELS: dict[str, tuple[str, PipelineModel]] = {}


def _model(spark: SparkSession) -> tuple[str, PipelineModel]:
    """The application's model: trained once, kept in the shared folder, loaded once."""
    app = spark.sparkContext.applicationId
    if app not in MODELS:
        path = shared_folder(spark, "pit-model")
        model.save(model.train(features.training_table(spark)), path)
        MODELS[app] = path, model.load(path)
    return MODELS[app]


def trained_model(spark: SparkSession) -> PipelineModel:
    return _model(spark)[1]


def trained_nodes(spark: SparkSession) -> DataFrame:
    """The same model as rows."""
    return forest.forest_nodes(spark, _model(spark)[0])


@query
def pit_scores(spark, sf_dir):
    scored = model.score(telemetry(spark, sf_dir), trained_model(spark))
    return features.prediction_rows(scored, keep=("event_id",))


@query
def scoring_counters(spark, sf_dir):
    return metrics.scoring_counters(project(spark, sf_dir, inputs.GAPPY_SQL))


@query
def publish_summary(spark, sf_dir):
    return metrics.publish_summary(quality.validate_events(dirty(spark, sf_dir)))


# Tails and views


@query
def tail_per_partition(spark, sf_dir):
    """More partitions than the topic was declared with; the data say how many."""
    events = positioned(table(spark, sf_dir, "events").select("event_id"), TOPIC_PARTITIONS["pit-predictions"] + 2)
    return recent.tail_per_partition(events, 20)


@query
def tail_of_log(spark, sf_dir):
    """The same tails from a log of four batches, whose list says which files they reach into."""
    events = positioned(table(spark, sf_dir, "events").select("event_id"), TOPIC_PARTITIONS["pit-predictions"] + 2)
    folder, last = shared_folder(spark, "log"), events.agg(F.max("event_id")).first()[0] or 0
    for n in range(4):
        slot = F.least(F.expr(f"event_id * 4 div {last + 1}"), F.lit(3)) == n
        append_records(events.where(slot), folder, n)
    return read_tail(spark, folder, events.schema, 20).select(*events.columns)


@query
def recent_predictions(spark, sf_dir):
    partitions = TOPIC_PARTITIONS["pit-predictions"]
    rows = positioned(predictions(spark, sf_dir), partitions)
    return recent.recent(rows, "timestamp_ms", partitions)


@query
def recent_aggregates(spark, sf_dir):
    """Newest windows; they are dealt out over the partitions, 20 cars to a window."""
    partitions = TOPIC_PARTITIONS["stream-aggregates"]
    window, car = F.floor(F.col("window_start_ms") / 10_000), F.substring("car_id", 5, 2).cast("long")
    rows = recent.with_position(
        hopping.hop_metrics(enriched(spark, sf_dir)),
        window % partitions,
        F.floor(window / partitions) * 20 + car - 1,
    )
    return recent.recent(rows, "window_start_ms", partitions, limit=40)


@query
def decode_json_rows(spark, sf_dir):
    values = project(spark, sf_dir, inputs.JSON_VALUES_SQL)
    return recent.decode_json_rows(values, "value", T.StructType([T.StructField("k", T.LongType())]))


@query
def pit_wall_view(spark, sf_dir):
    return recent.pit_wall_view(predictions(spark, sf_dir))


@query
def topic_stats(spark, sf_dir):
    partitions = TOPIC_PARTITIONS[RAW_TOPIC]
    events = positioned(table(spark, sf_dir, "events").select("event_id"), partitions)
    return metrics.topic_stats(events, recent.PARTITION, recent.OFFSET)


@query
def topic_has_records(spark, sf_dir):
    partitions = TOPIC_PARTITIONS[RAW_TOPIC]
    events = positioned(table(spark, sf_dir, "events").select("event_id"), partitions)
    return metrics.topic_has_records(metrics.topic_stats(events, recent.PARTITION, recent.OFFSET))


# Reference tables and change data


@query
def reference_tables(spark, sf_dir):
    """Titles and drivers per team, over tables conformed to their declared schemas."""
    drivers = reference_rows(spark, sf_dir, "drivers")
    per_team = drivers.groupBy("team_id").agg(
        F.count("*").alias("drivers"),
        F.sum("championships").alias("titles"),
        F.sum("race_wins").alias("wins"),
    )
    return reference_rows(spark, sf_dir, "teams").join(per_team, "team_id", "left")


@query
def reference_circuits(spark, sf_dir):
    rows = reference_rows(spark, sf_dir, "circuits")
    cast = {c: F.col(c).cast("double") for c in ("length_km", "pit_loss_time_s")}
    return rows.withColumns(cast).drop("created_at", "updated_at")


@query
def reference_regulations(spark, sf_dir):
    rows = reference_rows(spark, sf_dir, "regulations")
    decimals = ("max_fuel_load_kg", "min_weight_kg", "drs_activation_gap_s")
    return rows.withColumns({c: F.col(c).cast("double") for c in decimals})


@query
def insert_if_absent(spark, sf_dir):
    """The suppliers as drivers, plus the first event of every user who is none of them."""
    drivers = table(spark, sf_dir, "supplier")
    target = drivers.select("s_suppkey", "s_name", "s_acctbal", F.lit(1).alias("s_visits"))
    incoming = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("s_suppkey"),
        F.col("event_type").alias("s_name"),
        F.when(F.col("event_type") != "signup", F.col("value")).alias("s_acctbal"),
        "event_id",
    )
    return reference.insert_if_absent(target, incoming, "s_suppkey", defaults={"s_visits": F.lit(0)}, order="event_id")


@query
def fk_orphans(spark, sf_dir):
    """Events of drivers that the reference table does not know."""
    events = telemetry(spark, sf_dir).select("event_id", "driver_id")
    return reference.fk_orphans(events, "driver_id", reference_rows(spark, sf_dir, "drivers"), "driver_id")


@query
def constraint_report(spark, sf_dir):
    events = telemetry(spark, sf_dir).withColumn("note", F.when(~F.col("drs_active"), F.col("tire_compound")))
    return reference.check_constraints(
        events,
        not_null=("event_id", "driver_id", "note"),
        unique=("event_id", "driver_id"),
        foreign={"driver_id": (reference_rows(spark, sf_dir, "drivers"), "driver_id")},
    )


@query
def cdc_snapshot(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    rows = cdc.snapshot_changes(customers, "c_custkey", "racing.public.customer")
    return rows.select("op", "seq", "source_table", "key", "after.*")


@query
def cdc_unwrap(spark, sf_dir):
    return cdc.unwrap_changes(changes(spark, sf_dir), "o_custkey")


@query
def cdc_route(spark, sf_dir):
    routed = changes(spark, sf_dir).select(cdc.route_topic(F.col("source_table")).alias("topic"))
    return routed.groupBy("topic").agg(F.count("*").alias("n"))


@query
def dim_latest(spark, sf_dir):
    return cdc.latest_by_key(cdc.unwrap_changes(changes(spark, sf_dir), "o_custkey"), "o_custkey")


@query
def cdc_routed_dimension(spark, sf_dir):
    """The changes in two batches by topic, a snapshot between them, and one topic's latest rows."""
    folder, log = shared_folder(spark, "routed"), changes(spark, sf_dir)
    half = log.agg(F.expr("max(seq) div 2").alias("half")).first()["half"] or 0
    image = T.StructType.fromDDL("o_custkey long, o_orderstatus string, o_totalprice double")
    write_routed(log.where(F.col("seq") <= half), f"{folder}/log", 0)
    take_snapshot(spark, f"{folder}/log", f"{folder}/snapshots", image, "driver-profiles")
    write_routed(log.where(F.col("seq") > half), f"{folder}/log", 1)
    return read_routed_dimension(spark, f"{folder}/log", f"{folder}/snapshots", image, "driver-profiles", "o_custkey")


@query
def cdc_merged_table(spark, sf_dir):
    """A snapshot of customers handed over to the changes behind its position, merged in three steps."""
    folder = shared_folder(spark, "merged")
    image = T.StructType.fromDDL("o_custkey long, o_orderstatus string, o_totalprice double")
    rows = project(spark, sf_dir, "SELECT c_custkey AS o_custkey, 'S' AS o_orderstatus, c_acctbal AS o_totalprice FROM {customer}")
    log = changes(spark, sf_dir)
    ends = log.agg(F.expr("max(seq) div 3").alias("first"), F.expr("max(seq) * 2 div 3").alias("second")).first()
    first, second = ends["first"] or 0, ends["second"] or 0
    # The table was read when a third of the log was written: those changes are in no need of repeating.
    cdc.snapshot_changes(rows, "o_custkey", "racing.public.customer", seq=first).write.parquet(f"{folder}/log")
    seq = F.col("seq")
    for some in (seq <= first, (seq > first) & (seq <= second), seq > second):
        log.where(some).write.mode("append").parquet(f"{folder}/log")
        merge_changes(spark, f"{folder}/table", read_changes(spark, f"{folder}/log", image), image, "o_custkey")
    return read_merged(spark, f"{folder}/table", image)


@query
def cdc_compact(spark, sf_dir):
    return cdc.compact_changes(changes(spark, sf_dir)).select("key", "seq", "op", "after.o_totalprice")


@query
def within_retention(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    newest = events.agg(F.max("ts")).scalar()
    return cdc.within_retention(events, RETENTION_MS["pit-predictions"], newest, "ts")


@query
def retention_by_hour(spark, sf_dir):
    """Two sinks of the same records, expired at two hours and at six, with what is left of each."""
    events = table(spark, sf_dir, "events").select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp_ms"))
    newest, left = events.agg(F.max("timestamp_ms")).first()[0] or 0, []
    for topic in ("raw-telemetry", "enriched-telemetry"):
        folder = shared_folder(spark, topic)
        for n in range(2):
            some = events.where(F.col("event_id") % 2 == n).repartitionByRange(24, "timestamp_ms")
            write_batch(some, folder, n, bounds=("timestamp_ms",))
        expire(spark, folder, newest - RETENTION_MS[topic])
        rows = cdc.within_retention(read_batches(spark, folder, events.schema), RETENTION_MS[topic], newest)
        left.append(rows.select(F.lit(topic).alias("topic"), "event_id", "timestamp_ms"))
    return left[0].unionByName(left[1])


# Metric series


@query
def counter_rate(spark, sf_dir):
    rates = metrics.counter_rate(samples(spark, sf_dir), RATE_RANGE_S)
    return rates.select("series", metrics.epoch_us("ts").alias("epoch_us"), "rate")


@query
def metric_latest(spark, sf_dir):
    return metrics.metric_latest(samples(spark, sf_dir)).select("series", "value")


@query
def recent_series(spark, sf_dir):
    rows = metrics.recent_series(samples(spark, sf_dir))
    return rows.select("series", "age", "value")


@query
def parse_metric_text(spark, sf_dir):
    texts = project(spark, sf_dir, inputs.METRIC_TEXT_SQL)
    parsed = metrics.parse_metric_lines(metrics.text_lines(texts, "event_id", "text"), "ml_consumer")
    return parsed.withColumnRenamed("source", "event_id")


# Streams, run to the end of the given events and read back from their sinks


def enrich_by_stream(spark: SparkSession, sf_dir: str) -> str:
    folder = shared_folder(spark, "enriched")
    start_enrichment(
        project_stream(spark, sf_dir, inputs.TELEMETRY_SQL),
        lambda session: dimensions(session, sf_dir),
        f"{folder}/data",
        f"{folder}/checkpoint",
        name=folder,
        as_of_ms=inputs.AS_OF_MS,
        trigger=NOW,
    ).awaitTermination()
    return f"{folder}/data"


@query
def stream_enrich(spark, sf_dir):
    rows = read_enriched(spark, enrich_by_stream(spark, sf_dir), extra=(EVENT_ID,))
    return rows.drop("batch_id", "event_date")


@query
def stream_enrich_dirty(spark, sf_dir):
    """Rows enriched and rows quarantined by one stream over dirty events."""
    folder = shared_folder(spark, "enriched-dirty")
    start_enrichment(
        project_stream(spark, sf_dir, inputs.DIRTY_SQL).select(*TELEMETRY.names),
        lambda session: dimensions(session, sf_dir),
        f"{folder}/data",
        f"{folder}/checkpoint",
        name=folder,
        as_of_ms=inputs.AS_OF_MS,
        trigger=NOW,
        dead_path=f"{folder}/dead",
    ).awaitTermination()
    good, bad = read_enriched(spark, f"{folder}/data"), read_batches(spark, f"{folder}/dead", DEAD_LETTER)
    good = good.select(F.lit("enriched").alias("outcome"), *TELEMETRY.names, "circuit_name", "driver_full_name", "enriched")
    letter = F.from_json("value", TELEMETRY)
    bad = bad.select(letter.alias("row"), F.col("headers")["X-Error-Message"].alias("reason"))
    bad = bad.select(F.lit("dead").alias("outcome"), "row.*", "reason")
    return good.unionByName(bad, allowMissingColumns=True)


@query
def stream_hop_metrics(spark, sf_dir):
    source = enrich_by_stream(spark, sf_dir)
    folder = shared_folder(spark, "aggregates")
    start_aggregation(
        read_enriched(spark, source, streaming=True),
        f"{folder}/data",
        f"{folder}/checkpoint",
        name=folder,
        trigger=NOW,
        state_partitions=spark.sparkContext.defaultParallelism,
    ).awaitTermination()
    return read_aggregates(spark, f"{folder}/data")


@query
def stream_dead_letters(spark, sf_dir):
    folder = shared_folder(spark, "quarantine")
    start_quarantine(
        project_stream(spark, sf_dir, inputs.DIRTY_SQL).select(*TELEMETRY.names),
        f"{folder}/valid",
        f"{folder}/dead",
        f"{folder}/checkpoint",
        name=folder,
        as_of_ms=inputs.AS_OF_MS,
        trigger=NOW,
    ).awaitTermination()
    return letter_columns(read_batches(spark, f"{folder}/dead", DEAD_LETTER))


@query
def stream_predictions(spark, sf_dir):
    """Scores by stream, from the same model as the batch form."""
    folder = shared_folder(spark, "predictions")
    start_scoring(
        project_stream(spark, sf_dir, inputs.GAPPY_SQL),
        trained_model(spark),
        f"{folder}/data",
        f"{folder}/checkpoint",
        name=folder,
        trigger=NOW,
    ).awaitTermination()
    return read_predictions(spark, f"{folder}/data")


@query
def stream_counters(spark, sf_dir):
    """What a scoring stream counted, over the halves of the events and a restart between them."""
    folder, events = shared_folder(spark, "counters"), project(spark, sf_dir, inputs.GAPPY_SQL)
    middle = events.agg(F.expr("max(event_id) div 2").alias("half")).first()["half"] or 0
    for half in (events.where(F.col("event_id") <= middle), events.where(F.col("event_id") > middle)):
        half.write.mode("append").parquet(f"{folder}/events")
        start_scoring(
            read_events(spark, f"{folder}/events", events.schema, streaming=True),
            trained_model(spark),
            f"{folder}/data",
            f"{folder}/checkpoint",
            name=folder,
            trigger=NOW,
        ).awaitTermination()
    return metrics.metric_latest(read_counters(spark, f"{folder}/data")).select("series", F.col("value").cast("long").alias("total"))


@query
def stream_enrich_routed(spark, sf_dir):
    """Enrichment by dimensions that are a snapshot and the changes after it, as of versions decided per batch."""
    folder, tables = shared_folder(spark, "enriched-routed"), {}
    for name, key, topic in (("circuits", "circuit_id", "circuit-metadata"), ("drivers", "driver_id", "driver-profiles")):
        rows = reference_rows(spark, sf_dir, name)
        shown = "circuit_name" if name == "circuits" else "full_name"
        moved = F.crc32(F.col(key).cast("binary")) % 2 == 0  # half of the rows change after the snapshot
        log, source = f"{folder}/{name}", f"racing.public.{name}"
        stale = rows.withColumn(shown, F.when(moved, F.lit("before")).otherwise(F.col(shown)))
        write_routed(cdc.snapshot_changes(stale, key, source, seq=1), log, 0)
        take_snapshot(spark, log, f"{log}-snapshots", rows.schema, topic)
        write_routed(cdc.snapshot_changes(rows.where(moved), key, source, seq=2).withColumn("op", F.lit("u")), log, 1)
        tables[name] = (log, f"{log}-snapshots", rows.schema, topic, key)

    def versions(session: SparkSession) -> dict:
        return {name: dimension_version(session, log, snapshots) for name, (log, snapshots, *_) in tables.items()}

    def read(session: SparkSession, chosen: dict) -> tuple[DataFrame, ...]:
        return tuple(read_routed_dimension(session, *table, version=chosen[name]) for name, table in tables.items())

    start_enrichment(
        project_stream(spark, sf_dir, inputs.TELEMETRY_SQL),
        read,
        f"{folder}/data",
        f"{folder}/checkpoint",
        name=folder,
        as_of_ms=inputs.AS_OF_MS,
        trigger=NOW,
        versions=versions,
    ).awaitTermination()
    return read_enriched(spark, f"{folder}/data", extra=(EVENT_ID,)).drop("batch_id", "event_date")


@query
def stream_hop_metrics_folded(spark, sf_dir):
    """Window metrics of a stream that runs three times; closed windows are folded after each."""
    folder, rows = shared_folder(spark, "folded"), enriched(spark, sf_dir)
    ends = rows.agg(F.min("timestamp_ms").alias("low"), F.max("timestamp_ms").alias("high")).first()
    low, third = ends["low"] or 0, ((ends["high"] or 0) - (ends["low"] or 0)) // 3 + 1
    for n in range(3):
        slot = F.floor((F.col("timestamp_ms") - low) / third) == n
        write_batch(with_event_date(rows.where(slot)), f"{folder}/enriched", n, by=("event_date",))
        start_aggregation(
            read_enriched(spark, f"{folder}/enriched", streaming=True),
            f"{folder}/data",
            f"{folder}/checkpoint",
            name=folder,
            lateness="1 minute",
            trigger=NOW,
            state_partitions=spark.sparkContext.defaultParallelism,
        ).awaitTermination()
        fold_aggregates(spark, f"{folder}/data", 60_000)
    return read_aggregates(spark, f"{folder}/data")
