"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then three times to the end without a sink; the
median counts. Model training happens before, as it does once per deployment.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from undercut.plans.queries import QUERIES, trained_model  # noqa: E402
from undercut.session import build_session  # noqa: E402

HEADLINE = (
    "scan_telemetry",
    "enrich_full",
    "hop_metrics",
    "aggregates_json",
    "validate_events",
    "dead_letter",
    "quantise_sensors",
    "sanitize_numeric",
    "pit_features",
    "pit_scores",
    "scoring_counters",
    "publish_summary",
    "recent_predictions",
    "pit_wall_view",
    "decode_json_rows",
    "topic_stats",
    "key_partition",
    "dim_latest",
    "cdc_route",
    "insert_if_absent",
    "constraint_report",
    "within_retention",
    "counter_rate",
    "recent_series",
    "parse_metric_text",
    "tail_per_partition",
    "recent_aggregates",
    "cdc_routed_dimension",
    "stream_enrich",
    "stream_hop_metrics",
    "stream_dead_letters",
    "stream_predictions",
)
RUNS = 3


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        app="undercut-bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    trained_model(spark)
    timings = {}
    for name in HEADLINE:

        def run(query=QUERIES[name]):
            query(spark, folder).write.format("noop").mode("overwrite").save()

        run()
        timings[name] = round(statistics.median(seconds(run) for _ in range(RUNS)), 4)
    events = spark.read.parquet(f"{folder}/events.parquet").count()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "events": events,
        "hop_metrics_events_per_sec": round(events / timings["hop_metrics"]),
        "stream_enrich_events_per_sec": round(events / timings["stream_enrich"]),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
