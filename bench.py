"""Time the headline queries once each and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma
separated names, default: the list below).
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from zoneflow.queries import queries
from zoneflow.session import SETTINGS

HEADLINE = (
    "enrich_trips", "trip_quality_filter", "hourly_pickups", "pickup_dropoff_flow", "lag_features",
    "rolling_features", "feature_store_month", "upsert_month_stored", "dq_trip_rules", "duplicate_check",
    "time_split", "median_impute", "time_lag_join", "fill_missing", "opportunity_score", "forecast_output",
    "train_forecast",
)


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    conf = {**SETTINGS, "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = session()
    registered = queries()
    registered["month_window"](spark, sf_dir).collect()  # start the JVM's code paths, untimed
    seconds = {}
    for name in names:
        begin = time.perf_counter()
        # The noop sink runs every row of the result without moving it to the driver.
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
