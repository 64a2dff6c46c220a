"""The same results in plain SQL, for the correctness check."""

from __future__ import annotations

from undercut.operators.quality import QUANTISED
from undercut.plans import inputs
from undercut.schemas import MAX_TIME_MS, TELEMETRY

COLUMNS = ", ".join(TELEMETRY.names)


def with_inputs(body: str, **views: str) -> str:
    heads = [f"{name} AS ({inputs.oracle_text(text)})" for name, text in views.items()]
    return f"WITH {', '.join(heads)} {body}"


def on_telemetry(body: str) -> str:
    return with_inputs(body, telemetry=inputs.TELEMETRY_SQL)


# Enrichment

CIRCUIT_ID = "string_split(rtrim(session_id, '_'), '_')[3]"

ENRICHED_VIEWS = {
    "telemetry": inputs.TELEMETRY_SQL,
    "circuits": inputs.CIRCUITS_SQL,
    "drivers": inputs.DRIVERS_SQL,
    "enriched_rows": f"""
        SELECT t.*, c.circuit_name, c.country AS circuit_country,
          CAST(CAST(c.length_km AS DECIMAL(6, 3)) AS DOUBLE) AS circuit_length_km,
          CAST(c.num_laps AS INTEGER) AS num_laps, CAST(c.drs_zones AS INTEGER) AS drs_zones,
          CAST(CAST(c.pit_loss_time_s AS DECIMAL(5, 2)) AS DOUBLE) AS pit_loss_time_s,
          d.full_name AS driver_full_name, d.abbreviated_name AS driver_abbrev,
          d.team_id AS driver_team, d.nationality AS driver_nationality,
          CAST({inputs.AS_OF_MS} AS BIGINT) AS enrichment_ts_ms,
          c.circuit_id IS NOT NULL OR d.driver_id IS NOT NULL AS enriched
        FROM telemetry t
        LEFT JOIN circuits c ON c.circuit_id = {CIRCUIT_ID.replace("session_id", "t.session_id")}
        LEFT JOIN drivers d ON d.driver_id = t.driver_id""",
}

DRIVER_COLUMNS = "driver_full_name, driver_abbrev, driver_team, driver_nationality"
CIRCUIT_COLUMNS = "circuit_name, circuit_country, circuit_length_km, num_laps, drs_zones, pit_loss_time_s"

HOPS = """
    SELECT car_id, ws AS window_start_ms, ws + 30000 AS window_end_ms,
      avg(speed_kph) AS avg_speed_kph, max(speed_kph) AS max_speed_kph,
      avg((tire_temp_fl + tire_temp_fr + tire_temp_rl + tire_temp_rr) / 4.0) AS avg_tire_temp_c,
      avg((tire_wear_fl + tire_wear_fr + tire_wear_rl + tire_wear_rr) / 4.0) AS avg_tire_wear_pct,
      CAST(count(*) AS BIGINT) AS event_count
    FROM (SELECT e.*, CAST(timestamp_ms - timestamp_ms % 10000 - k * 10000 AS BIGINT) AS ws
          FROM enriched_rows e, (VALUES (0), (1), (2)) AS h(k) WHERE enriched) AS hopped
    WHERE ws >= 0 GROUP BY car_id, ws"""

HOP_SQL = with_inputs(HOPS, **ENRICHED_VIEWS)

HASH = """list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split({key}, ''),
    lambda ch: CAST(ord(ch) AS BIGINT))), lambda a, c: (a * 31 + c) % 4294967296)"""


def key_partition(key: str, partitions: int) -> str:
    unsigned = HASH.format(key=key)
    signed = f"CASE WHEN {unsigned} >= 2147483648 THEN {unsigned} - 4294967296 ELSE {unsigned} END"
    return f"CAST(abs({signed}) % {partitions} AS INTEGER)"


# Quality

RULE_NAMES = {
    "coalesce(length(trim(car_id)) > 0, false)": "car_id",
    "coalesce(length(trim(driver_id)) > 0, false)": "driver_id",
    "coalesce(length(trim(session_id)) > 0, false)": "session_id",
    f"timestamp_ms BETWEEN 0 AND {MAX_TIME_MS}": "timestamp_ms",
    "lap >= 1": "lap",
    "sector BETWEEN 1 AND 3": "sector",
    "speed_kph BETWEEN 0 AND 400": "speed_kph",
    "rpm >= 0": "rpm",
    "gear BETWEEN 0 AND 8": "gear",
    "throttle_pct BETWEEN 0 AND 100": "throttle_pct",
    "brake_pct BETWEEN 0 AND 100": "brake_pct",
    "drs_active IS NOT NULL": "drs_active",
    "tire_compound IN ('SOFT', 'MEDIUM', 'HARD', 'INTER', 'WET')": "tire_compound",
    "tire_temp_fl BETWEEN 0 AND 200": "tire_temp_fl",
    "tire_temp_fr BETWEEN 0 AND 200": "tire_temp_fr",
    "tire_temp_rl BETWEEN 0 AND 200": "tire_temp_rl",
    "tire_temp_rr BETWEEN 0 AND 200": "tire_temp_rr",
    "tire_wear_fl BETWEEN 0 AND 100": "tire_wear_fl",
    "tire_wear_fr BETWEEN 0 AND 100": "tire_wear_fr",
    "tire_wear_rl BETWEEN 0 AND 100": "tire_wear_rl",
    "tire_wear_rr BETWEEN 0 AND 100": "tire_wear_rr",
    "fuel_load_kg BETWEEN 0 AND 120": "fuel_load_kg",
    "engine_temp_c BETWEEN 0 AND 200": "engine_temp_c",
    "ers_deploy_pct BETWEEN 0 AND 100": "ers_deploy_pct",
    "g_force_lat BETWEEN -10 AND 10": "g_force_lat",
    "g_force_lon BETWEEN -10 AND 10": "g_force_lon",
}

CHECKED_VIEWS = {
    "dirty": inputs.DIRTY_SQL,
    "checked": "SELECT *, concat_ws(',', "
    + ", ".join(f"CASE WHEN NOT ({rule}) THEN '{name}' END" for rule, name in RULE_NAMES.items())
    + ") AS reason FROM dirty",
}

RECORD = "to_json(struct_pack(" + ", ".join(f"{c} := {c}" for c in TELEMETRY.names) + "))"

DEAD_LETTER_SQL = with_inputs(
    f"""SELECT car_id AS key, CAST({RECORD} AS VARCHAR) AS value, reason AS error_message,
      'raw-telemetry' AS original_topic, '{inputs.AS_OF_MS}' AS error_timestamp,
      'ValidationError' AS exception_class, car_id AS original_car_id
    FROM checked WHERE reason <> ''""",
    **CHECKED_VIEWS,
)

FINITE = "CASE WHEN NOT isnan({c}) AND NOT isinf({c}) THEN {c} END"
CLEAN = FINITE.format(c="reading")

# Features

MEAN_WEAR = "(tire_wear_fl + tire_wear_fr + tire_wear_rl + tire_wear_rr) / 4.0 / 100.0"
PREDICTION_VIEWS = {
    "telemetry": inputs.TELEMETRY_SQL,
    "predictions": f"""SELECT *, p AS pit_probability, p >= 0.65 AS recommend_pit, 'rf-1.0.0' AS model_version
        FROM (SELECT *, {MEAN_WEAR} AS p FROM telemetry) AS scored""",
}


def clip(value: str) -> str:
    return f"CAST(least(1.0, greatest(0.0, {value})) AS DOUBLE)"


FEATURES = {
    "wear": clip("(tire_wear_fl + tire_wear_fr + tire_wear_rl + tire_wear_rr) / 400.0"),
    "temp": clip("(tire_temp_fl + tire_temp_fr + tire_temp_rl + tire_temp_rr) / 600.0"),
    "fuel": clip("fuel_load_kg / 120.0"),
    "speed": clip("speed_kph / 380.0"),
    "ers": clip("ers_deploy_pct / 100.0"),
    "lap": clip("CAST(least(lap, 100) AS DOUBLE) / 100.0"),
}
FEATURE_LIST = ", ".join(f"{sql} AS {name}" for name, sql in FEATURES.items())
SCORABLE = "tire_wear_fl IS NOT NULL AND lap IS NOT NULL AND NOT isnan(speed_kph)"

# One decimal as shown: printf rounds the binary value, but ties to even.
PERCENT = """CASE WHEN x - floor(x) IN (0.25, 0.75) THEN printf('%.1f', floor(x * 10 + 0.5) / 10)
    ELSE printf('%.1f', x) END || '%'"""


# Scores: the nodes of the trained forest, as rows, walked by a recursive query


def forest_oracles(rows: list[tuple]) -> dict[str, str]:
    """SQL for the scores of a forest of nodes (tree, node, feature, split, left, right, no, yes)."""
    names = ("tree", "node", "feature", "split", "left_", "right_", "no", "yes")
    columns = [", ".join(repr(row[i]) if row[i] is not None else "NULL" for row in rows) for i in range(len(names))]
    nodes = "SELECT " + ", ".join(f"unnest([{values}]) AS {name}" for name, values in zip(names, columns))
    readings = ", ".join(FEATURES.values())

    def scored(source: str, condition: str) -> str:
        return f"""WITH RECURSIVE rows_in AS ({inputs.oracle_text(source)}),
        nodes AS ({nodes}),
        walk AS (
          SELECT event_id, [{readings}] AS x, tree, 0 AS node FROM rows_in, (SELECT DISTINCT tree FROM nodes) AS t WHERE {condition}
          UNION ALL
          SELECT event_id, x, w.tree, CASE WHEN x[feature + 1] <= split THEN left_ ELSE right_ END
          FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node WHERE feature >= 0
        ),
        votes AS (
          SELECT event_id, list(no / (no + yes) ORDER BY w.tree) AS against, list(yes / (no + yes) ORDER BY w.tree) AS in_favour
          FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node WHERE feature < 0 GROUP BY event_id
        ),
        sums AS (
          SELECT event_id, list_reduce(against, lambda a, b: a + b) AS n, list_reduce(in_favour, lambda a, b: a + b) AS y FROM votes
        )
        SELECT r.event_id, car_id, timestamp_ms, y / (n + y) AS pit_probability, y / (n + y) >= 0.65 AS recommend_pit,
          'rf-1.0.0' AS model_version FROM sums s JOIN rows_in r ON r.event_id = s.event_id"""

    batch = scored(inputs.TELEMETRY_SQL, "true")
    stream = scored(inputs.GAPPY_SQL, f"decoded AND {SCORABLE}")
    rest = "SELECT car_id, timestamp_ms, pit_probability, recommend_pit, model_version"
    return {"pit_scores": batch, "stream_predictions": f"{rest} FROM ({stream}) AS s"}


# Positions


def positions(partitions: int) -> str:
    return (
        f"CAST(event_id % {partitions} AS INTEGER) AS _kafka_partition, event_id // {partitions} AS _kafka_offset"
    )


def tails(source: str, per_partition: int) -> str:
    return f"""SELECT r.* FROM {source} r JOIN (
        SELECT _kafka_partition AS p, greatest(min(_kafka_offset), max(_kafka_offset) + 1 - {per_partition}) AS low
        FROM {source} GROUP BY 1) AS b ON r._kafka_partition = b.p AND r._kafka_offset >= b.low"""


# Change data

CHANGES_VIEWS = {"changes": inputs.CHANGES_SQL}
GONE = "(op IS NULL OR op = 'd')"
UNWRAPPED = f"""SELECT CAST(key AS BIGINT) AS o_custkey,
    CASE WHEN NOT {GONE} THEN o_orderstatus END AS o_orderstatus,
    CASE WHEN NOT {GONE} THEN o_totalprice END AS o_totalprice,
    seq, source_table, op = 'd' AS __deleted FROM changes"""

# Metric text

LINES = """SELECT event_id, unnest(string_split(text, chr(10))) AS raw,
    generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM texts"""
METRIC_VIEWS = {
    "texts": inputs.METRIC_TEXT_SQL,
    "lines": LINES,
    "parts": r"""SELECT event_id, pos,
        trim(regexp_extract(trim(raw), '^(.+) ([^ ]*)$', 1)) AS named,
        regexp_extract(trim(raw), '^(.+) ([^ ]*)$', 2) AS text FROM lines
        WHERE trim(raw) NOT LIKE '#%' AND regexp_matches(trim(raw), '^(.+) ([^ ]*)$')""",
    "readings": r"""SELECT event_id, pos, string_split(named, chr(123))[1] AS name,
        TRY_CAST(regexp_extract(text, '^([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)', 1) AS DOUBLE) AS value
        FROM parts""",
}

RATE_SQL = with_inputs(
    """SELECT series, us AS epoch_us,
      CASE WHEN us > min(us) OVER span
           THEN (sum(delta) OVER span - first_value(delta) OVER span) / ((us - min(us) OVER span) / 1e6) END AS rate
    FROM deltas
    WINDOW span AS (PARTITION BY series ORDER BY us RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW)""",
    samples=inputs.SAMPLES_SQL,
    timed="SELECT series, epoch_us(ts) AS us, value FROM samples",
    steps="SELECT series, us, value, lag(value) OVER (PARTITION BY series ORDER BY us) AS before FROM timed",
    deltas="""SELECT series, us, CASE WHEN before IS NULL THEN 0.0 WHEN value < before THEN value
        ELSE value - before END AS delta FROM steps""",
)

WHOLE_OBJECT = "json_valid(value) AND json_type(value) = 'OBJECT'"

# Repeated keys and numbers that are not finite, beyond what this parser takes.
LOOSE = "event_id % 37 = 0 OR event_id % 41 = 0 OR event_id % 43 = 0 OR event_id % 47 = 0"

ORACLES: dict[str, str] = {
    "scan_telemetry": on_telemetry(f"SELECT {COLUMNS} FROM telemetry"),
    "event_time_source": with_inputs(
        "SELECT event_id, timestamp_ms, make_timestamp(timestamp_ms * 1000) AS event_time "
        f"FROM dirty WHERE timestamp_ms BETWEEN 0 AND {MAX_TIME_MS}",
        dirty=inputs.DIRTY_SQL,
    ),
    "extract_circuit_id": with_inputs(
        f"SELECT event_id, session_id, {CIRCUIT_ID} AS circuit_id FROM sessions", sessions=inputs.SESSIONS_SQL
    ),
    "key_partition": on_telemetry(
        f"SELECT event_id, {key_partition('car_id', 20)} AS car_partition, "
        f"{key_partition('session_id', 7)} AS session_partition FROM telemetry"
    ),
    "enrich_circuit": with_inputs(
        f"SELECT event_id, {COLUMNS}, {CIRCUIT_COLUMNS}, circuit_name IS NOT NULL AS enriched FROM enriched_rows",
        **ENRICHED_VIEWS,
    ),
    "enrich_driver": with_inputs(
        f"SELECT event_id, {COLUMNS}, {DRIVER_COLUMNS}, driver_full_name IS NOT NULL AS enriched FROM enriched_rows",
        **ENRICHED_VIEWS,
    ),
    "enrich_full": with_inputs("SELECT * FROM enriched_rows", **ENRICHED_VIEWS),
    "hop_metrics": HOP_SQL,
    "aggregates_json": with_inputs(f"SELECT car_id AS key, * FROM ({HOPS}) AS m", **ENRICHED_VIEWS),
    "quantise_sensors": "SELECT event_id, floor((value * 1.37 - 20.0) * 100 + 0.5) / 100 AS q FROM events",
    "validate_events": with_inputs("SELECT event_id, reason = '' AS is_valid FROM checked", **CHECKED_VIEWS),
    "quarantine_reasons": with_inputs("SELECT event_id, reason FROM checked WHERE reason <> ''", **CHECKED_VIEWS),
    "dead_letter": DEAD_LETTER_SQL,
    "dead_letter_async": on_telemetry(
        f"""SELECT car_id AS key, 'async-failure:' || coalesce(cause, 'null') AS value,
          CASE WHEN length(cause) > 500 THEN left(cause, 500) || '...' ELSE coalesce(cause, 'null') END
            AS error_message,
          'raw-telemetry' AS original_topic, '{inputs.AS_OF_MS}' AS error_timestamp,
          'PublishError' AS exception_class, car_id AS original_car_id
        FROM (SELECT *, CASE WHEN drs_active THEN repeat(session_id, lap) END AS cause FROM telemetry) AS f"""
    ),
    "sanitize_numeric": with_inputs(
        f"""SELECT event_id, {CLEAN} AS reading, value AS item_0, {CLEAN} AS item_1, {CLEAN} AS named_a,
          value AS named_b, {CLEAN} AS deep_x, {CLEAN} AS deep_inner FROM rows_in""",
        rows_in=inputs.NON_FINITE_SQL,
    ),
    "pit_flag": with_inputs("SELECT event_id, pit_probability, recommend_pit FROM predictions", **PREDICTION_VIEWS),
    "prediction_rows": with_inputs(
        "SELECT car_id, timestamp_ms, pit_probability, recommend_pit, model_version FROM predictions",
        **PREDICTION_VIEWS,
    ),
    "pit_features": with_inputs(
        f"SELECT event_id, {FEATURE_LIST} FROM gappy WHERE {SCORABLE}", gappy=inputs.GAPPY_SQL
    ),
    "pit_label_rule": on_telemetry(
        f"""SELECT event_id, CAST(wear > 0.72 OR (wear > 0.52 AND fuel < 0.28) AS INTEGER) AS label
        FROM (SELECT event_id, {FEATURE_LIST} FROM telemetry) AS f"""
    ),
    "scoring_counters": with_inputs(
        f"""SELECT CAST(count(*) FILTER (decoded) AS BIGINT) AS consumed,
          CAST(count(*) FILTER (decoded AND {SCORABLE}) AS BIGINT) AS emitted,
          CAST(count(*) FILTER (NOT decoded OR NOT ({SCORABLE})) AS BIGINT) AS errors FROM gappy""",
        gappy=inputs.GAPPY_SQL,
    ),
    "publish_summary": with_inputs(
        """SELECT CAST(count(DISTINCT car_id) AS BIGINT) AS active_cars,
          CAST(count(*) FILTER (reason = '') AS BIGINT) AS published,
          CAST(count(*) FILTER (reason <> '') AS BIGINT) AS dead_lettered FROM checked""",
        **CHECKED_VIEWS,
    ),
    "tail_per_partition": with_inputs(tails("p", 8), p=f"SELECT event_id, {positions(7)} FROM events"),
    "recent_predictions": with_inputs(
        f"""SELECT event_id, car_id, timestamp_ms, pit_probability, recommend_pit, model_version,
          _kafka_partition, _kafka_offset FROM ({tails("placed", 9)}) AS t
        ORDER BY timestamp_ms DESC, _kafka_partition, _kafka_offset LIMIT 20""",
        **PREDICTION_VIEWS,
        placed=f"SELECT *, {positions(5)} FROM predictions",
    ),
    "recent_aggregates": with_inputs(
        f"SELECT * FROM ({tails('placed', 9)}) AS t "
        "ORDER BY window_start_ms DESC, _kafka_partition, _kafka_offset LIMIT 40",
        **ENRICHED_VIEWS,
        hops=HOPS,
        placed="""SELECT *, CAST(window_start_ms // 10000 % 10 AS INTEGER) AS _kafka_partition,
          window_start_ms // 100000 * 20 + CAST(substr(car_id, 5, 2) AS BIGINT) - 1 AS _kafka_offset FROM hops""",
    ),
    "decode_json_rows": with_inputs(
        f"""SELECT event_id, CASE WHEN event_id % 37 = 0 THEN 2 WHEN NOT ({LOOSE}) AND {WHOLE_OBJECT}
            THEN CAST(json_extract(value, '$.k') AS BIGINT) END AS k,
          CASE WHEN NOT ({LOOSE}) AND json_valid(value) AND json_type(value) <> 'OBJECT' THEN trim(value) END AS _raw
        FROM json_values WHERE {LOOSE} OR value = '' OR json_valid(value)""",
        json_values=inputs.JSON_VALUES_SQL,
    ),
    "pit_wall_view": with_inputs(
        f"""SELECT event_id, car_id, strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ')
            AS timestamp,
          {PERCENT} AS probability, CASE WHEN recommend_pit THEN 'yes' ELSE 'no' END AS recommend_pit, model_version
        FROM (SELECT *, pit_probability * 100.0 AS x FROM predictions) AS t""",
        **PREDICTION_VIEWS,
    ),
    "topic_stats": f"""SELECT _kafka_partition, min(_kafka_offset) AS low, max(_kafka_offset) + 1 AS high,
        CAST(count(*) AS BIGINT) AS n FROM (SELECT {positions(20)} FROM events) AS t GROUP BY 1""",
    "topic_has_records": "SELECT count(*) > 0 AS has_records FROM events",
    "reference_tables": with_inputs(
        """SELECT t.team_id, team_name, power_unit, base_country, CAST(NULL AS VARCHAR) AS principal,
          d.drivers, d.titles, d.wins
        FROM teams t LEFT JOIN (SELECT team_id, CAST(count(*) AS BIGINT) AS drivers,
          CAST(sum(championships) AS BIGINT) AS titles, CAST(0 AS BIGINT) AS wins FROM drivers GROUP BY 1) AS d
        ON d.team_id = t.team_id""",
        teams=inputs.TEAMS_SQL,
        drivers=inputs.DRIVERS_SQL,
    ),
    "reference_circuits": with_inputs(
        """SELECT circuit_id, circuit_name, country, CAST(NULL AS VARCHAR) AS city,
          CAST(CAST(length_km AS DECIMAL(6, 3)) AS DOUBLE) AS length_km, CAST(num_laps AS INTEGER) AS num_laps,
          CAST(drs_zones AS INTEGER) AS drs_zones,
          CAST(CAST(pit_loss_time_s AS DECIMAL(5, 2)) AS DOUBLE) AS pit_loss_time_s,
          CAST(NULL AS VARCHAR) AS overtaking_diff FROM circuits""",
        circuits=inputs.CIRCUITS_SQL,
    ),
    "reference_regulations": with_inputs(
        """SELECT regulation_id, season, CAST(max_fuel_load_kg AS DOUBLE) AS max_fuel_load_kg,
          CAST(min_weight_kg AS DOUBLE) AS min_weight_kg,
          CAST(drs_activation_gap_s AS DOUBLE) AS drs_activation_gap_s, mandatory_compounds,
          pit_lane_speed_limit_kph, fastest_lap_bonus_point FROM regulations""",
        regulations=inputs.REGULATIONS_SQL,
    ),
    "insert_if_absent": """
        WITH target AS (SELECT s_suppkey, s_name, s_acctbal, 1 AS s_visits FROM supplier),
        firsts AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)
        SELECT * FROM target UNION ALL
        SELECT user_id, event_type, CASE WHEN event_type <> 'signup' THEN value END, 0
        FROM firsts WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM target WHERE s_suppkey = user_id)""",
    "fk_orphans": with_inputs(
        """SELECT event_id, driver_id FROM telemetry WHERE NOT EXISTS
        (SELECT 1 FROM drivers d WHERE d.driver_id = telemetry.driver_id)""",
        telemetry=inputs.TELEMETRY_SQL,
        drivers=inputs.DRIVERS_SQL,
    ),
    "constraint_report": with_inputs(
        """SELECT 'not_null:event_id' AS rule, CAST(count(*) FILTER (event_id IS NULL) AS BIGINT) AS violations
          FROM telemetry
        UNION ALL SELECT 'not_null:driver_id', count(*) FILTER (driver_id IS NULL) FROM telemetry
        UNION ALL SELECT 'not_null:note', count(*) FILTER (drs_active) FROM telemetry
        UNION ALL SELECT 'unique:event_id', count(event_id) - count(DISTINCT event_id) FROM telemetry
        UNION ALL SELECT 'unique:driver_id', count(driver_id) - count(DISTINCT driver_id) FROM telemetry
        UNION ALL SELECT 'foreign:driver_id', count(*) FROM telemetry WHERE NOT EXISTS
          (SELECT 1 FROM drivers d WHERE d.driver_id = telemetry.driver_id)""",
        telemetry=inputs.TELEMETRY_SQL,
        drivers=inputs.DRIVERS_SQL,
    ),
    "cdc_snapshot": """SELECT 'r' AS op, CAST(0 AS BIGINT) AS seq, 'racing.public.customer' AS source_table,
        CAST(c_custkey AS VARCHAR) AS key, * FROM customer""",
    "cdc_unwrap": with_inputs(UNWRAPPED, **CHANGES_VIEWS),
    "cdc_route": with_inputs(
        """SELECT CASE source_table WHEN 'racing.public.circuits' THEN 'circuit-metadata'
          WHEN 'racing.public.drivers' THEN 'driver-profiles' ELSE source_table END AS topic,
          CAST(count(*) AS BIGINT) AS n FROM changes GROUP BY 1""",
        **CHANGES_VIEWS,
    ),
    "dim_latest": with_inputs(
        """SELECT CAST(key AS BIGINT) AS o_custkey, o_orderstatus, o_totalprice
        FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq DESC) AS rn FROM changes) AS c
        WHERE rn = 1 AND op IS NOT NULL AND op <> 'd'""",
        **CHANGES_VIEWS,
    ),
    "cdc_routed_dimension": with_inputs(
        """SELECT CAST(key AS BIGINT) AS o_custkey, o_orderstatus, o_totalprice
        FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq DESC) AS rn FROM changes
              WHERE source_table = 'racing.public.drivers') AS c
        WHERE rn = 1 AND op IS NOT NULL AND op <> 'd'""",
        **CHANGES_VIEWS,
    ),
    "cdc_compact": with_inputs(
        f"""SELECT key, seq, op, CASE WHEN NOT {GONE} THEN o_totalprice END AS o_totalprice
        FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq DESC) AS rn FROM changes) AS c
        WHERE rn = 1""",
        **CHANGES_VIEWS,
    ),
    "within_retention": """SELECT event_id, ts FROM events
        WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 86400 SECOND""",
    "counter_rate": RATE_SQL,
    "metric_latest": with_inputs(
        "SELECT series, arg_max(value, ts) AS value FROM samples GROUP BY series", samples=inputs.SAMPLES_SQL
    ),
    "recent_series": with_inputs(
        """SELECT series, CAST(age AS INTEGER) AS age, value FROM (SELECT series, value,
          row_number() OVER (PARTITION BY series ORDER BY ts DESC, value DESC) AS age FROM samples) AS r
        WHERE age <= 72""",
        samples=inputs.SAMPLES_SQL,
    ),
    "parse_metric_text": with_inputs(
        """SELECT event_id, name, arg_max(value, pos) AS value FROM readings
        WHERE name LIKE 'ml\\_consumer%' ESCAPE '\\' AND isfinite(value) GROUP BY event_id, name""",
        **METRIC_VIEWS,
    ),
    "stream_enrich": with_inputs("SELECT * FROM enriched_rows", **ENRICHED_VIEWS),
    "stream_enrich_routed": with_inputs("SELECT * FROM enriched_rows", **ENRICHED_VIEWS),
    "stream_hop_metrics_folded": HOP_SQL,
    "stream_counters": with_inputs(
        f"""SELECT series, CAST(sum(n) AS BIGINT) AS total FROM (
          SELECT unnest(['consumed', 'emitted', 'errors']) AS series, unnest([
            CAST(decoded AS BIGINT), CAST(decoded AND {SCORABLE} AS BIGINT), CAST(NOT decoded OR NOT ({SCORABLE}) AS BIGINT)
          ]) AS n FROM gappy) AS t GROUP BY series""",
        gappy=inputs.GAPPY_SQL,
    ),
    "tail_of_log": with_inputs(tails("p", 8), p=f"SELECT event_id, {positions(7)} FROM events"),
    "cdc_merged_table": with_inputs(
        """SELECT CAST(key AS BIGINT) AS o_custkey, o_orderstatus, o_totalprice FROM (
          SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq DESC) AS rn FROM (
            SELECT key, seq, op, o_orderstatus, o_totalprice FROM changes
            WHERE seq > (SELECT max(seq) // 3 FROM changes)
            UNION ALL SELECT CAST(c_custkey AS VARCHAR), 0, 'r', 'S', c_acctbal FROM customer) AS u) AS c
        WHERE rn = 1 AND op IS NOT NULL AND op <> 'd'""",
        **CHANGES_VIEWS,
    ),
    "retention_by_hour": """SELECT topic, event_id, timestamp_ms FROM (
          SELECT event_id, epoch_us(ts) // 1000 AS timestamp_ms, max(epoch_us(ts) // 1000) OVER () AS newest FROM events) AS e,
          (VALUES ('raw-telemetry', 7200000), ('enriched-telemetry', 21600000)) AS r(topic, kept)
        WHERE timestamp_ms >= newest - kept""",
    "events_from_json": on_telemetry(f"SELECT {COLUMNS} FROM telemetry"),
    "sensors_quantised": on_telemetry(
        "SELECT event_id, " + ", ".join(f"floor(({c} * 1.37 - 20.0) * 100 + 0.5) / 100 AS {c}" for c in QUANTISED) + " FROM telemetry"
    ),
    "placed_by_car": on_telemetry(
        f"SELECT {key_partition('car_id', 20)} AS _kafka_partition, car_id, CAST(count(*) AS BIGINT) AS n FROM telemetry GROUP BY 1, 2"
    ),
    "reference_from_files": with_inputs(
        """SELECT d.team_id, driver_id, full_name, championships, team_name FROM drivers d LEFT JOIN teams t ON t.team_id = d.team_id""",
        teams=inputs.TEAMS_SQL,
        drivers=inputs.DRIVERS_SQL,
    ),
    "scrapes_from_files": with_inputs(
        """SELECT name, arg_max(value, event_id * 1000 + pos) AS value FROM readings
        WHERE name LIKE 'ml\\_consumer%' ESCAPE '\\' AND isfinite(value) GROUP BY name""",
        **METRIC_VIEWS,
    ),
    "stream_enrich_dirty": with_inputs(
        f"""SELECT outcome, {", ".join(f"c.{name}" for name in TELEMETRY.names)}, circuit_name, driver_full_name, enriched,
          CASE WHEN outcome = 'dead' THEN c.reason END AS reason
        FROM (SELECT *, CASE WHEN reason = '' THEN 'enriched' ELSE 'dead' END AS outcome FROM checked) AS c
        LEFT JOIN (SELECT event_id AS id, circuit_name, driver_full_name, enriched FROM enriched_rows) AS e
          ON c.event_id = e.id AND outcome = 'enriched'""",
        **CHECKED_VIEWS,
        **ENRICHED_VIEWS,
    ),
    "stream_hop_metrics": HOP_SQL,
    "stream_dead_letters": DEAD_LETTER_SQL,
}
