"""Query inputs, projected from the given tables by SQL that both engines run.

``{name}`` stands for a table: Spark binds a DataFrame to it, the oracle its view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from undercut.schemas import TELEMETRY

# Declared, so that opening a table reads no file footers.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}

AS_OF_MS = 1_735_689_600_000

TELEMETRY_SQL = """
SELECT event_id,
  concat('CAR_', lpad(CAST(1 + user_id % 20 AS STRING), 2, '0')) AS car_id,
  concat('DRV_', lpad(CAST(user_id AS STRING), 9, '0')) AS driver_id,
  CASE event_type WHEN 'click' THEN 'RACE_2024_C01_R1' WHEN 'view' THEN 'RACE_2024_C02_R1'
                  WHEN 'purchase' THEN 'RACE_2024_C03_R1' WHEN 'signup' THEN 'RACE_2024_C99_R1'
                  ELSE 'SHORT' END AS session_id,
  CAST(1704067200000 + event_id * 50 AS BIGINT) AS timestamp_ms,
  CAST(1 + event_id % 70 AS INT) AS lap,
  CAST(1 + event_id % 3 AS INT) AS sector,
  CAST(80 + (event_id * 7919) % 256 AS DOUBLE) AS speed_kph,
  CAST(4000 + (event_id * 53) % 12000 AS INT) AS rpm,
  CAST(1 + event_id % 8 AS INT) AS gear,
  CAST((event_id * 29) % 101 AS DOUBLE) AS throttle_pct,
  CAST((event_id * 47) % 101 AS DOUBLE) AS brake_pct,
  (event_id % 5 = 0) AS drs_active,
  CASE event_id % 5 WHEN 0 THEN 'SOFT' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'HARD'
                    WHEN 3 THEN 'INTER' ELSE 'WET' END AS tire_compound,
  CAST(60 + (event_id * 13) % 71 AS DOUBLE) AS tire_temp_fl,
  CAST(60 + (event_id * 17) % 71 AS DOUBLE) AS tire_temp_fr,
  CAST(60 + (event_id * 19) % 71 AS DOUBLE) AS tire_temp_rl,
  CAST(60 + (event_id * 23) % 71 AS DOUBLE) AS tire_temp_rr,
  CAST((event_id * 31) % 101 AS DOUBLE) AS tire_wear_fl,
  CAST((event_id * 37) % 101 AS DOUBLE) AS tire_wear_fr,
  CAST((event_id * 41) % 101 AS DOUBLE) AS tire_wear_rl,
  CAST((event_id * 43) % 101 AS DOUBLE) AS tire_wear_rr,
  CAST((event_id * 59) % 111 AS DOUBLE) AS fuel_load_kg,
  CAST(90 + (event_id * 61) % 20 AS DOUBLE) AS engine_temp_c,
  CAST((event_id * 67) % 101 AS DOUBLE) AS ers_deploy_pct,
  CAST((event_id * 71) % 500 AS DOUBLE) / 100 AS g_force_lat,
  CAST((event_id * 73) % 600 AS DOUBLE) / 100 - 4 AS g_force_lon
FROM {events}
"""


def _altered(changes: dict[str, str], extra: tuple[str, ...] = ()) -> str:
    columns = ["event_id", *[f"{changes[c]} AS {c}" if c in changes else c for c in TELEMETRY.names], *extra]
    return f"SELECT {', '.join(columns)} FROM ({TELEMETRY_SQL}) AS t"


# Records out of range, one kind of fault per residue.
DIRTY_SQL = _altered(
    {
        "sector": "CASE WHEN event_id % 97 = 0 THEN 99 ELSE sector END",
        "timestamp_ms": "CASE WHEN event_id % 101 = 0 THEN -1 WHEN event_id % 127 = 0 THEN 9223372036854775807 "
        "WHEN event_id % 131 = 0 THEN -9223372036854775807 - 1 ELSE timestamp_ms END",
        "throttle_pct": "CASE WHEN event_id % 103 = 0 THEN CAST(200 AS DOUBLE) ELSE throttle_pct END",
        "tire_compound": "CASE WHEN event_id % 107 = 0 THEN 'SLICK' ELSE tire_compound END",
        "g_force_lat": "CASE WHEN event_id % 109 = 0 THEN CAST(50 AS DOUBLE) ELSE g_force_lat END",
        "driver_id": "CASE WHEN event_id % 113 = 0 THEN ' ' ELSE driver_id END",
    }
)

# Records that cannot be decoded or scored.
GAPPY_SQL = _altered(
    {
        "tire_wear_fl": "CASE WHEN event_id % 89 = 0 THEN NULL ELSE tire_wear_fl END",
        "lap": "CASE WHEN event_id % 83 = 0 THEN NULL ELSE lap END",
        "speed_kph": "CASE WHEN event_id % 73 = 0 THEN CAST('NaN' AS DOUBLE) ELSE speed_kph END",
        "fuel_load_kg": "CASE WHEN event_id % 71 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE fuel_load_kg END",
    },
    ("(event_id % 79 <> 0) AS decoded",),
)

SESSIONS_SQL = """
SELECT event_id,
  CASE event_type WHEN 'click' THEN concat('RACE_2024_C', CAST(user_id AS STRING), '_R1')
                  WHEN 'view' THEN concat('A_B_', repeat('_', CAST(event_id % 3 AS INT)))
                  WHEN 'purchase' THEN concat('A_B__C', CAST(user_id AS STRING))
                  WHEN 'signup' THEN CASE WHEN user_id % 2 = 0 THEN NULL ELSE '' END
                  ELSE CASE WHEN user_id % 2 = 0 THEN 'SHORT' ELSE '_lead_ing' END END AS session_id
FROM {events}
"""

# Dimensions: circuits from regions, teams from nations, drivers from suppliers.
CIRCUITS_SQL = """
SELECT concat('C', lpad(CAST(r_regionkey AS STRING), 2, '0')) AS circuit_id,
  concat(r_name, ' RING') AS circuit_name,
  r_name AS country,
  CAST(4137 + r_regionkey * 213 AS DECIMAL(12, 3)) / 1000 AS length_km,
  50 + r_regionkey * 3 AS num_laps,
  1 + r_regionkey % 3 AS drs_zones,
  CAST(1950 + r_regionkey * 75 AS DECIMAL(12, 2)) / 100 AS pit_loss_time_s
FROM {region}
"""

TEAMS_SQL = """
SELECT concat('TEAM_', lpad(CAST(n_nationkey AS STRING), 2, '0')) AS team_id,
  concat('Team ', n_name) AS team_name,
  concat('PU_', CAST(n_regionkey AS STRING)) AS power_unit,
  r_name AS base_country
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
"""

DRIVERS_SQL = """
SELECT concat('DRV_', lpad(CAST(s_suppkey AS STRING), 9, '0')) AS driver_id,
  s_name AS full_name,
  concat('D', lpad(CAST(s_suppkey % 100 AS STRING), 2, '0')) AS abbreviated_name,
  concat('TEAM_', lpad(CAST(s_nationkey AS STRING), 2, '0')) AS team_id,
  CAST(1 + s_suppkey % 99 AS INT) AS car_number,
  concat('N', CAST(s_nationkey AS STRING)) AS nationality,
  CAST(s_suppkey % 4 AS INT) AS championships
FROM {supplier}
"""

REGULATIONS_SQL = """
SELECT concat('REG_', CAST(season AS STRING)) AS regulation_id, season,
  110 AS max_fuel_load_kg, 798 AS min_weight_kg, 1 AS drs_activation_gap_s,
  2 AS mandatory_compounds, 80 AS pit_lane_speed_limit_kph, true AS fastest_lap_bonus_point
FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS season FROM {orders}) AS s
"""

# Orders as change records of customers; one kind is a tombstone.
CHANGES_SQL = """
SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'd'
            WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN NULL
            WHEN o_orderpriority = '1-URGENT' THEN 'c' ELSE 'u' END AS op,
  o_orderkey AS seq,
  concat('racing.public.', CASE o_orderstatus WHEN 'F' THEN 'circuits' WHEN 'O' THEN 'drivers'
                                              ELSE 'orders' END) AS source_table,
  CAST(o_custkey AS STRING) AS key,
  o_custkey, o_orderstatus, o_totalprice
FROM {orders}
"""

SAMPLES_SQL = """
SELECT event_type AS series, ts, CAST(event_id % 500 AS DOUBLE) AS value FROM {events}
"""

JSON_VALUES_SQL = """
SELECT event_id,
  CASE WHEN event_id % 37 = 0 THEN '{{"k": 1, "k": 2}}' WHEN event_id % 41 = 0 THEN '{{"k": NaN}}'
       WHEN event_id % 43 = 0 THEN '{{"k": Infinity, "z": 1}}' WHEN event_id % 47 = 0 THEN 'NaN'
       WHEN event_type = 'click' THEN props ELSE
  CASE event_type WHEN 'view' THEN concat('  ', props, ' ')
                  WHEN 'purchase' THEN concat('[', props, ', 7]')
                  WHEN 'signup' THEN concat(props, CASE user_id % 3 WHEN 0 THEN ',2' WHEN 1 THEN ' x' ELSE '}}' END)
                  ELSE CASE user_id % 3 WHEN 0 THEN '' WHEN 1 THEN CAST(event_id AS STRING) ELSE NULL END
       END END AS value
FROM {events}
"""

METRIC_TEXT_SQL = """
SELECT event_id, concat(
  '# HELP ml_consumer_messages_consumed_total messages 1', chr(10),
  'ml_consumer_messages_consumed_total{{type="x y"}} ', CAST(event_id AS STRING), chr(10),
  '  ml_consumer_messages_consumed_total ', CAST(value AS STRING), '  ', chr(10), chr(10),
  'ml_consumer_errors_total ', CASE WHEN user_id % 2 = 0 THEN 'NaN' ELSE '1.5e2x' END, chr(10),
  'ml_consumer_predictions_emitted_total +Inf', chr(10),
  'http_requests_total 5', chr(10), 'ml_consumer_lone') AS text
FROM {events}
"""

NON_FINITE_SQL = """
SELECT event_id,
  CASE event_type WHEN 'click' THEN CAST('NaN' AS DOUBLE) WHEN 'view' THEN CAST('Infinity' AS DOUBLE)
                  WHEN 'signup' THEN CAST('-Infinity' AS DOUBLE) ELSE value END AS reading, value
FROM {events}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def project(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run an input projection over the tables it names."""
    named = {name: table(spark, sf_dir, name) for name in TABLES if f"{{{name}}}" in text}
    return spark.sql(text, **named)


def project_stream(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """The same projection over the events as a stream, whether file or folder."""
    events = spark.readStream.schema(TABLES["events"]).parquet(f"{sf_dir}/{{events.parquet}}")
    return spark.sql(text, events=events)


def oracle_text(text: str) -> str:
    return text.format(**{name: name for name in TABLES})
