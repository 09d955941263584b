"""Registered queries: every operator as ``(spark, folder) -> DataFrame`` over the whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ontime.functions.keys import surrogate_key
from ontime.operators import metrics, quality, star
from ontime.operators.features import encoder, hash_split, index_by_tables, index_stage, one_hot_stage, width_and_slot
from ontime.operators.models import GRADIENT_BOOSTING, RANDOM_FOREST, Fitted, Learner, evaluate, plain, prepare, score
from ontime.operators.trees import score_by_nodes, store_nodes
from ontime.plans import reports
from ontime.schemas import AIRPORTS, CATEGORICAL_FEATURES, DELAY_CAUSES, FEATURES, FLIGHTS, TARGETS
from ontime.sinks.outputs import load_model, register_views, save_model, write_json
from ontime.sources.files import conform, fill_nulls, normalize, scan_csv
from ontime.sources.tables import read_table, write_table
from ontime.staging import owner, staged_folder
from ontime.workspace import PLANTED, Workspace, workspace


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _at_once(spark: SparkSession, step: Callable[[str], Any], targets: Iterable[str]) -> list:
    """What a step finds for each target, all at the same time: the short jobs of one leave cores to the others."""
    targets = list(targets)
    with ThreadPoolExecutor(max_workers=len(targets)) as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(step), target) for target in targets]
        return [job.result() for job in jobs]


# -- sources and quality


def scan_flights_csv(ws: Workspace) -> DataFrame:
    return scan_csv(ws.spark, ws.flights_csv)


def conform_schema(ws: Workspace) -> DataFrame:
    return conform(scan_csv(ws.spark, ws.flights_csv), FLIGHTS)


def null_fill(ws: Workspace) -> DataFrame:
    return fill_nulls(ws.flights)


def normalize_flights(ws: Workspace) -> DataFrame:
    return normalize(scan_csv(ws.spark, ws.flights_csv), FLIGHTS)


def normalize_delays(ws: Workspace) -> DataFrame:
    return normalize(scan_csv(ws.spark, ws.causes_csv, null_text="NA"), DELAY_CAUSES)


def table_profile(ws: Workspace) -> DataFrame:
    return quality.profile(ws.stored_flights)


def csv_profile(ws: Workspace) -> DataFrame:
    return quality.profile_in_one_scan(scan_csv(ws.spark, ws.flights_csv, null_text="NA"))


def sample_rows(ws: Workspace) -> DataFrame:
    return quality.sample(ws.warehouse.flights.frame)


def key_uniqueness(ws: Workspace) -> DataFrame:
    return quality.key_uniqueness(ws.warehouse.star())


def key_uniqueness_packed_key(ws: Workspace) -> DataFrame:
    return quality.key_uniqueness(ws.packed_warehouse.star())


def orphan_facts(ws: Workspace) -> DataFrame:
    return quality.orphan_facts(ws.warehouse.star())


# -- star schema


def surrogate_keys(ws: Workspace) -> DataFrame:
    flights = ws.warehouse.flights.frame

    def keyed(kind: str, *columns: str) -> DataFrame:
        return flights.select(*columns).distinct().select(
            F.lit(kind).alias("kind"),
            F.concat_ws("|", *columns).alias("parts"),
            surrogate_key(*columns).alias("safe_key"),
            surrogate_key(*columns, sep="").alias("packed_key"),
        )

    return keyed("date", "year", "month", "day").unionByName(keyed("route", "origin", "dest", "distance"))


def dim_carrier(ws: Workspace) -> DataFrame:
    return star.carriers(ws.warehouse.flights.frame)


def dim_airport(ws: Workspace) -> DataFrame:
    return star.airports(conform(scan_csv(ws.spark, ws.airports_csv), AIRPORTS))


def dim_date(ws: Workspace) -> DataFrame:
    return star.dates(ws.warehouse.flights.frame)


def dim_route(ws: Workspace) -> DataFrame:
    return star.routes(ws.warehouse.flights.frame)


def dim_time(ws: Workspace) -> DataFrame:
    return star.times(ws.warehouse.flights.frame)


def fact_flights(ws: Workspace) -> DataFrame:
    return star.facts(ws.warehouse.flights.frame)


def delay_reasons(ws: Workspace) -> DataFrame:
    return star.delay_reasons(normalize(ws.causes, DELAY_CAUSES))


# -- sinks


def _digest(name: str, df: DataFrame) -> DataFrame:
    """Row count and an order-free checksum over every value of a table."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in sorted(df.columns)])
    number = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(number).alias("checksum")).select(
        F.lit(name).alias("table_name"), "n_rows", "checksum"
    )


def _stored(ws: Workspace, *names: str) -> DataFrame:
    tables = ws.warehouse.tables
    return _union([_digest(name, read_table(ws.spark, tables[name].path)) for name in names])


def sink_star_roundtrip(ws: Workspace) -> DataFrame:
    return _stored(ws, *star.DIMENSION_KEYS, "fact_flights")


def sink_delays_roundtrip(ws: Workspace) -> DataFrame:
    return _stored(ws, "delay_reasons")


def report_views(ws: Workspace) -> DataFrame:
    built = {name: build(ws.warehouse) for name, build in reports.REPORTS.items()}
    return _union(
        [
            ws.spark.table(name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("view_name"), "n_rows")
            for name in register_views(built)
        ]
    )


# -- reports


def report(name: str) -> Callable[[Workspace], DataFrame]:
    """A report as registered: decimal percentages as doubles."""

    def build(ws: Workspace) -> DataFrame:
        found = reports.REPORTS[name](ws.warehouse)
        decimals = [c for c, kind in found.dtypes if kind.startswith("decimal")]
        return found.withColumns({c: F.col(c).cast("double") for c in decimals})

    return build


def rp_monthly_delays_packed_key(ws: Workspace) -> DataFrame:
    return reports.REPORTS["rp_monthly_delays"](ws.packed_warehouse)


# -- model inputs


def enriched_flights(ws: Workspace) -> DataFrame:
    return ws.enriched


def features_arrival(ws: Workspace) -> DataFrame:
    return ws.features("arrival")


def features_departure(ws: Workspace) -> DataFrame:
    return ws.features("departure")


def model_row_counts(ws: Workspace) -> DataFrame:
    return _union(
        [quality.row_count(ws.features(t)).select(F.lit(t).alias("target"), "n_rows") for t in TARGETS]
    )


def split_hash(ws: Workspace) -> DataFrame:
    train, test = hash_split(ws.features("arrival"))
    return train.withColumn("in_train", F.lit(True)).unionByName(test.withColumn("in_train", F.lit(False)))


def feature_splits(ws: Workspace) -> DataFrame:
    """The stored table that training reads: features, labels, and the split bucket of each label."""
    return ws.feature_table


def string_index(ws: Workspace) -> DataFrame:
    frame = ws.features("arrival").select(*CATEGORICAL_FEATURES)
    return index_stage().fit(frame).transform(frame)


def string_index_tables(ws: Workspace) -> DataFrame:
    """The same indexes from stored dictionaries, ranked and joined without a category on the driver."""
    return index_by_tables(ws.features("arrival").select(*CATEGORICAL_FEATURES), ws.dictionaries)


def one_hot(ws: Workspace) -> DataFrame:
    indexed = string_index(ws)
    encoded = one_hot_stage().fit(indexed).transform(indexed)
    columns = []
    for name in CATEGORICAL_FEATURES:
        width, slot = width_and_slot(f"{name}_ohe")
        columns += [width.alias(f"{name}_width"), slot.alias(f"{name}_slot")]
    return encoded.select(*CATEGORICAL_FEATURES, *columns)


def feature_vector(ws: Workspace) -> DataFrame:
    """What the assembled vectors hold, slot by slot: non-zero rows and total."""
    frame = ws.features("arrival")
    seen = Summarizer.metrics("sum", "numNonZeros").summary(F.col("features"))
    slots = encoder().fit(frame).transform(frame).agg(seen.alias("seen")).select(
        F.arrays_zip(
            vector_to_array("seen.sum").alias("total"), vector_to_array("seen.numNonZeros").alias("n_nonzero")
        ).alias("slots")
    )
    return slots.select(F.posexplode("slots").alias("slot", "value")).select(
        "slot", F.round("value.total", 3).alias("total"), F.col("value.n_nonzero").cast("bigint").alias("n_nonzero")
    )


# -- models


def _rescored(ws: Workspace, fitted: Fitted, test: DataFrame) -> Row:
    """Held-out rows, and how many of them the model's node table answers otherwise than the model."""
    trees = fitted.model.stages[-1]
    with owner(ws.spark):
        answered = fitted.model.transform(test).select(F.monotonically_increasing_id().alias("row"), "features", "prediction")
        stored = write_table(answered, staged_folder(ws.spark, "answered")).frame
        by_nodes = score_by_nodes(stored, store_nodes(trees, staged_folder(ws.spark, "nodes")), trees)
        both = stored.select("row", "prediction").join(by_nodes.withColumnRenamed("prediction", "by_nodes"), "row", "left")
        return both.agg(
            F.count(F.lit(1)).alias("n"), F.count_if(~F.col("prediction").eqNullSafe(F.col("by_nodes"))).alias("changed")
        ).first()


def _trained(ws: Workspace, learner: Learner) -> DataFrame:
    """Per target, what a fit with the library's settings saw, and that its node table gives every held-out row the model's answer."""
    rows = []
    for target, label in TARGETS.items():
        fitted, test = ws.fit(label, plain(learner))
        trees, found = fitted.model.stages[-1], _rescored(ws, fitted, test)
        rows.append(
            (target, fitted.name, ws.training_set(label).vectors.count(), found["n"], trees.numFeatures, trees.getNumTrees, found["changed"])
        )
    return ws.spark.createDataFrame(
        rows, "target string, model string, fit_rows bigint, test_rows bigint, width int, trees int, n_changed_by_nodes bigint"
    )


def train_rf(ws: Workspace) -> DataFrame:
    return _trained(ws, RANDOM_FOREST)


def train_gbt(ws: Workspace) -> DataFrame:
    return _trained(ws, GRADIENT_BOOSTING)


def training_frames(ws: Workspace) -> DataFrame:
    """All training rows of each target as stored for the learners: dealt to four partitions, held in memory, released."""
    rows = []
    with owner(ws.spark):
        for target, label in TARGETS.items():
            train, _ = ws.labelled(label)
            training = prepare(train, label, staged_folder(ws.spark, "vectors"), partitions=4)
            files = len(training.vectors.inputFiles())
            held = training.hold()
            rows.append((target, held.count(), files, held.is_cached))
            training.release()
            rows[-1] += (not training.vectors.is_cached,)
    return ws.spark.createDataFrame(rows, "target string, n_rows bigint, n_partitions int, held boolean, released boolean")


def cv_grid(ws: Workspace) -> DataFrame:
    """Every point of both learners' grids for both targets, and whether the best of them was refitted."""

    def searched(target: str) -> list[tuple]:
        rows = []
        for learner in (RANDOM_FOREST, GRADIENT_BOOSTING):
            fitted, _ = ws.fit(TARGETS[target], learner)
            best, _ = max(fitted.grid_scores, key=lambda scored: scored[1])
            last = fitted.model.stages[-1]
            refitted = all(last.getOrDefault(name) == value for name, value in best.items())
            rows += [
                (target, fitted.name, point["maxDepth"], point.get("numTrees", point.get("maxIter")), 0.0 <= auc <= 1.0, refitted)
                for point, auc in fitted.grid_scores
            ]
        return rows

    for label in TARGETS.values():
        ws.training_set(label)
    rows = [row for found in _at_once(ws.spark, searched, TARGETS) for row in found]
    return ws.spark.createDataFrame(
        rows, "target string, model string, max_depth int, trees int, auc_valid boolean, best_refitted boolean"
    )


def score_batch(ws: Workspace) -> DataFrame:
    return score(ws.planted_model.model, ws.planted).select(*FEATURES, PLANTED, "prediction")


def model_roundtrip(ws: Workspace) -> DataFrame:
    """Scores of a saved and reloaded model beside those of the original, row by row."""
    path = f"{ws.folder}/models/planted"
    save_model(ws.planted_model.model, path)
    scored = score(ws.planted_model.model, ws.planted.select(*FEATURES)).withColumnsRenamed(
        {"prediction": "first_prediction", "delay_probability": "first_probability"}
    )
    both = score(load_model(path), scored.select(*FEATURES, "first_prediction", "first_probability"))
    same = (F.col("prediction") == F.col("first_prediction")) & (F.col("delay_probability") == F.col("first_probability"))
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~same).alias("n_changed"))


# -- metrics


def eval_confusion_metrics(ws: Workspace) -> DataFrame:
    return metrics.confusion_metrics(metrics.confusion(ws.rule_counts, "target", "model")).select(
        "target", "model", "tp", "fp", "tn", "fn",
        *[F.round(m, 9).alias(m) for m in ("accuracy", "precision", "recall", "f1")],
    )


def eval_auc(ws: Workspace) -> DataFrame:
    return ws.rule_metrics.select("target", "model", F.round("auc", 9).alias("auc"))


def best_model(ws: Workspace) -> DataFrame:
    return metrics.best_model(ws.rule_metrics).select("target", "model", F.round("auc", 9).alias("auc"))


def metrics_long(ws: Workspace) -> DataFrame:
    return metrics.metrics_long(ws.rule_metrics).withColumn("value", F.round("value", 9))


def eval_planted_model(ws: Workspace) -> DataFrame:
    """What :func:`evaluate` finds for the model that has one right answer, over all rows."""
    found = evaluate(ws.planted_model.model, ws.planted, PLANTED)
    names = ["rows", *metrics.METRICS]
    return ws.spark.createDataFrame([tuple(found[name] for name in names)], "rows bigint, " + ", ".join(f"{m} double" for m in metrics.METRICS))


def run_metrics_json(ws: Workspace) -> DataFrame:
    path = f"{ws.folder}/run_metrics"
    write_json(ws.rule_metrics, path)
    return ws.spark.read.schema(ws.rule_metrics.schema).json(path).select(
        "target", "model", *[F.round(m, 9).alias(m) for m in metrics.METRICS]
    )


_QUERIES: dict[str, Callable[[Workspace], DataFrame]] = {
    "scan_csv": scan_flights_csv,
    **{
        build.__name__: build
        for build in (
            conform_schema, null_fill, normalize_flights, normalize_delays, table_profile, csv_profile, sample_rows,
            key_uniqueness, key_uniqueness_packed_key, orphan_facts, surrogate_keys,
            dim_carrier, dim_airport, dim_date, dim_route, dim_time, fact_flights, delay_reasons,
            sink_star_roundtrip, sink_delays_roundtrip, report_views, rp_monthly_delays_packed_key,
            enriched_flights, features_arrival, features_departure, model_row_counts, split_hash, feature_splits,
            string_index, string_index_tables, one_hot, feature_vector, training_frames, train_rf, train_gbt, cv_grid, score_batch, model_roundtrip,
            eval_confusion_metrics, eval_auc, eval_planted_model, best_model, metrics_long, run_metrics_json,
        )
    },
    **{name: report(name) for name in reports.REPORTS},
}


def _registered(build: Callable[[Workspace], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        ws = workspace(spark, folder.rstrip("/"))
        with ws.lock:
            return build(ws)

    return query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _registered(build) for name, build in _QUERIES.items()}
