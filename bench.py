"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data, BENCH_CPUS the cores, BENCH_QUERIES (comma-separated) replaces the list.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from ontime.catalogue import queries
from ontime.schemas import TARGETS
from ontime.session import SETTINGS
from ontime.workspace import workspace

HEADLINE = [
    "normalize_flights", "dim_carrier", "dim_date", "dim_route", "dim_time", "fact_flights", "delay_reasons",
    "flights_summary", "rp_airport_depart_delays", "rp_airport_arrival_delays", "rp_carrier_delays",
    "rp_monthly_delays", "rp_monthly_delays_packed_key", "rp_routes_by_delay", "rp_delay_reasons_by_time",
    "rp_delay_reasons_by_airport", "delay_reason_summary", "table_profile", "orphan_facts", "enriched_flights",
    "features_arrival", "split_hash", "feature_vector", "eval_confusion_metrics", "train_rf", "train_gbt",
]


def timed(work) -> float:
    started = time.perf_counter()
    work()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")

    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    for key, value in {**SETTINGS, "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
                       "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
                       "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    ws = workspace(spark, folder)
    seconds = {
        # The order tables become raw flights; then the loads every report reads from.
        "prepare_input": timed(lambda: (ws.flown, ws.flights_csv)),
        "load_warehouse": timed(lambda: ws.warehouse),
        "load_packed_warehouse": timed(lambda: ws.packed_warehouse),
        # What several queries share, so that none of them hides it: encoded training rows, and score counts.
        "prepare_training": timed(lambda: [ws.training_set(label) for label in TARGETS.values()]),
        "rule_counts": timed(lambda: ws.rule_counts),
    }
    registered = queries()
    for name in names:
        seconds[name] = timed(
            lambda: registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        )
        print(name, seconds[name], file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "headline queries, total time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                "queries": seconds, "sf": folder.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
