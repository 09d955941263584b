"""Time the full boosting search: four grid points, three folds and the refit, thirteen fits in all.

Carriers are as they are, a thousand at sf0.1, unless BENCH_CARRIERS=100 groups them to a hundred, which makes
the vectors about as wide as the published models'. The time to encode and store the rows is part of the value.
Takes a quarter of an hour at sf0.1. BENCH_SF_DIR and BENCH_CPUS as in bench.py; BENCH_PARALLELISM,
BENCH_TARGET (arrival or departure) and BENCH_COMPACT=1 vary the run.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ontime.operators.features import hash_split
from ontime.operators.models import GRADIENT_BOOSTING, evaluate, fit, prepare
from ontime.schemas import TARGETS
from ontime.session import SETTINGS
from ontime.workspace import workspace


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    target = os.environ.get("BENCH_TARGET", "arrival")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench-grid")
    for key, value in {**SETTINGS, "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "20g",
                       "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
                       "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    ws, label = workspace(spark, folder), TARGETS[target]
    frame = ws.features(target)
    if grouped := os.environ.get("BENCH_CARRIERS") == "100":
        frame = frame.withColumn("carrier_code", F.regexp_replace("carrier_code", "^(C...).*", "$1"))
    train, test = hash_split(frame)
    started = time.perf_counter()
    training = prepare(train, label, f"{ws.folder}/grid", cpus, one_hot=os.environ.get("BENCH_COMPACT") != "1")
    prepared = time.perf_counter() - started
    result = fit(training, GRADIENT_BOOSTING, parallelism=int(os.environ.get("BENCH_PARALLELISM", "4")))
    print(
        json.dumps(
            {
                "metric": f"{target} boosting search", "value": round(prepared + result.seconds, 1), "unit": "sec",
                "prepare_seconds": round(prepared, 1), "carriers_grouped": grouped, "cores": cpus, "rows": training.vectors.count(),
                "width": result.model.stages[-1].numFeatures, "grid": result.grid_scores,
                "test": evaluate(result.model, test, label),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
