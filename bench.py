"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hillwarden.catalog import QUERIES  # noqa: E402
from hillwarden.session import build_session  # noqa: E402

HEADLINE = [
    "clean_readings", "node_velocity", "node_alerts", "backfill_levels", "sensor_alerts", "rain_rolling_totals", "rainfall_alerts",
    "merge_alert_intervals", "trending_levels", "event_starts", "marker_levels_recomputed", "quake_alerts", "nearest_gauges",
    "decode_tilt_v2", "message_routes", "release_schedule", "sent_matching", "roc_curve", "data_presence",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]", "bench",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").count()
    times = {}
    for name in HEADLINE:
        t = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
