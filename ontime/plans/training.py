"""Training and comparing delay classifiers for both targets."""

from __future__ import annotations

import time
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.operators.features import SEED, TRAIN_SHARE, feature_table, labelled, random_bucket
from ontime.operators.metrics import best_model
from ontime.operators.models import (
    FOLDS, GRADIENT_BOOSTING, PARALLELISM, RANDOM_FOREST, Fitted, Learner, evaluate, fit, metrics_table, prepare,
)
from ontime.schemas import TARGETS
from ontime.session import plan_shuffles
from ontime.sinks.outputs import save_model, write_json
from ontime.sources.tables import write_table
from ontime.staging import owner, staged_folder

# How rows are dealt to training and test: by their content, or at random when the table is stored.
SPLITS = ("hash", "random")


@dataclass(frozen=True)
class Comparison:
    fitted: dict[tuple[str, str], Fitted]
    metrics: DataFrame
    seconds: dict[str, float] = field(default_factory=dict)

    def best(self) -> dict[str, Fitted]:
        return {row["target"]: self.fitted[row["target"], row["model"]] for row in best_model(self.metrics).collect()}


def compare_models(
    enriched: DataFrame,
    folder: str | None = None,
    learners: tuple[Learner, ...] = (RANDOM_FOREST, GRADIENT_BOOSTING),
    targets: Mapping[str, str] = TARGETS,
    folds: int = FOLDS,
    parallelism: int = PARALLELISM,
    partitions: int | None = None,
    one_hot: bool = True,
    split: str = "hash",
    ledger: str | None = None,
) -> Comparison:
    """Fit every learner for every target and evaluate on the held-out rows.

    The features, all labels and the side that each row is on are stored once, before any fit: joins and
    hashes run once, and a random split stays as it was drawn. Training and test rows of every target
    are filters on that table. What is stored for that goes when the models are fitted, or fail to be;
    in a ``folder`` that the caller names it stays. ``ledger`` keeps the scores of a grid search beyond the
    run, so that one that was stopped goes on where it ended.
    """
    spark = enriched.sparkSession
    plan_shuffles(spark, enriched)
    with owner(spark):
        return _compare(
            enriched, folder or staged_folder(spark, "training"), learners, targets, folds, parallelism, partitions, one_hot, split, ledger
        )


def _compare(
    enriched: DataFrame, folder: str, learners: tuple[Learner, ...], targets: Mapping[str, str], folds: int, parallelism: int,
    partitions: int | None, one_hot: bool, split: str, ledger: str | None,
) -> Comparison:
    started = time.perf_counter()
    table = write_table(feature_table(enriched, targets), f"{folder}/features").frame
    seconds = {"preprocessing": time.perf_counter() - started, "split": 0.0, "training": 0.0, "evaluation": 0.0}
    if split == "random":
        at = time.perf_counter()
        drawn = {f"{label}_bucket": random_bucket(SEED + k) for k, label in enumerate(targets.values())}
        table = write_table(
            table.withColumns({b: F.when(F.col(b).isNotNull(), drawn[b]) for b in drawn}), f"{folder}/random_split"
        ).frame
        seconds["split"] = time.perf_counter() - at
    fitted, rows = {}, []
    for target, label in targets.items():
        train, test = labelled(table, label, TRAIN_SHARE)
        at = time.perf_counter()
        training = prepare(train, label, f"{folder}/train_{target}", partitions, one_hot=one_hot)
        seconds["training"] += time.perf_counter() - at
        try:
            for learner in learners:
                result = fit(training, learner, folds, parallelism, ledger)
                fitted[target, learner.name] = result
                seconds["training"] += result.seconds
                rows.append((target, result, evaluate(result.model, test, label)))
                seconds["evaluation"] += rows[-1][2]["evaluation_time"]
        finally:
            training.release()
    seconds["total"] = time.perf_counter() - started
    return Comparison(fitted, metrics_table(enriched.sparkSession, rows), seconds)


def run_stamp() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")


def store_comparison(comparison: Comparison, folder: str, stamp: str | None = None) -> dict[str, str]:
    """Save the best model per target, its description, the metrics of all models, and how long it took.

    Everything goes to a folder of the run, named by its stamp, so runs do not overwrite each other.
    Returns the model folders. ``run_metrics``, ``best_models`` and ``timings`` are JSON.
    """
    stamp = stamp or run_stamp()
    folder = f"{folder}/{stamp}"
    spark = comparison.metrics.sparkSession
    write_json(comparison.metrics.withColumn("run", F.lit(stamp)), f"{folder}/run_metrics")
    chosen = comparison.best()
    paths = {target: f"{folder}/{target}_{fitted.name}" for target, fitted in chosen.items()}
    for target, fitted in chosen.items():
        save_model(fitted.model, paths[target])
    saved = spark.createDataFrame(
        [(stamp, target, chosen[target].name, path) for target, path in paths.items()],
        "run string, target string, model string, model_path string",
    )
    write_json(saved.join(comparison.metrics, ["target", "model"]), f"{folder}/best_models")
    timings = spark.createDataFrame([(stamp, k, v) for k, v in comparison.seconds.items()], "run string, part string, seconds double")
    write_json(timings.coalesce(1), f"{folder}/timings")
    return paths
