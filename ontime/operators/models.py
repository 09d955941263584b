"""Delay classifiers: fitting, grid search, evaluation and scoring."""

from __future__ import annotations

import hashlib
import json
import math
import time
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import product

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ontime.functions.keys import surrogate_key
from ontime.operators.features import SEED, encoder
from ontime.operators.metrics import METRICS, area_under_roc, confusion, confusion_metrics, score_counts
from ontime.schemas import CATEGORICAL_FEATURES, FEATURE_ROW, NUMERIC_FEATURES
from ontime.session import enable_checkpoints
from ontime.sources.tables import write_table
from ontime.staging import owner, read_text, remove, staged_folder, write_text


# How trees are grown, not what they look like: with more memory per task, each level of a deep
# tree takes fewer passes over the rows.
EXECUTION = {"maxMemoryInMB": 512}

# Split candidates per number; one-hot inputs never need more.
BINS = 32


@dataclass(frozen=True)
class Learner:
    """A classifier with its settings and the grid to search."""

    name: str
    kind: type
    settings: Mapping[str, float]
    grid: Mapping[str, list[float]] = field(default_factory=dict)

    def estimator(self, label: str, bins: int):
        return self.kind(labelCol=label, featuresCol="features", seed=SEED, maxBins=bins, **EXECUTION, **self.settings)


# Settings and search grids of the two learners, and the number of folds.
RANDOM_FOREST = Learner(
    "RandomForest", RandomForestClassifier, {"numTrees": 100}, {"maxDepth": [5, 10], "numTrees": [50, 100]}
)
GRADIENT_BOOSTING = Learner("GBT", GBTClassifier, {"maxIter": 50}, {"maxDepth": [5, 10], "maxIter": [20, 50]})
FOLDS = 3


def plain(learner: Learner) -> Learner:
    """The learner with its settings and without a search."""
    return Learner(learner.name, learner.kind, learner.settings)


# Fits that run at the same time, at least: the small levels of one tree leave room for those of another.
PARALLELISM = 4


# A fit holds a number of so many bytes per slot and row, however sparse the rows are. A task of it holds at most so
# many bytes, and is worth its start from so many on.
SLOT_BYTES, TASK_BYTES, LEAST_TASK_BYTES = 4, 64 * 1024 * 1024, 4 * 1024 * 1024


def fit_bytes(rows: DataFrame) -> int:
    """What a fit on all these rows holds."""
    first = rows.select("features").head()
    return rows.count() * first["features"].size * SLOT_BYTES if first else 0


def dealt(rows: DataFrame, alone: bool = False) -> DataFrame:
    """Rows in as many partitions as keep what a task of a fit holds small. Sparse rows take few files, so fits would
    have few tasks. A fit that runs ``alone`` has a task per core, if each is worth it."""
    held, cores = fit_bytes(rows), rows.sparkSession.sparkContext.defaultParallelism
    pieces = max(-(-held // TASK_BYTES), min(cores, held // LEAST_TASK_BYTES) if alone else 0)
    return rows if pieces <= rows.rdd.getNumPartitions() else rows.repartition(pieces)


def storage_bytes(spark: SparkSession) -> int:
    """What the session's executors can hold of stored rows, together."""
    held = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().values().iterator()
    total = 0
    while held.hasNext():
        total += held.next()._1()
    return total


def fits_at_once(rows: DataFrame) -> int:
    """As many fits as the cores can take when each has a task per partition of its rows, while these fit in half
    of the memory for stored rows; at least one, which spills what it cannot hold."""
    wanted = max(PARALLELISM, rows.sparkSession.sparkContext.defaultParallelism // max(1, rows.rdd.getNumPartitions()))
    return max(1, min(wanted, storage_bytes(rows.sparkSession) // 2 // max(1, fit_bytes(rows))))


@dataclass(frozen=True)
class Fitted:
    name: str
    model: PipelineModel
    seconds: float
    grid_scores: list[tuple[dict[str, float], float]]


@dataclass(frozen=True)
class TrainingSet:
    """Encoded training rows in a stored table; kept in memory from the first fit until released."""

    vectors: DataFrame
    encoding: PipelineModel
    label: str
    bins: int = BINS

    def hold(self) -> DataFrame:
        return self.vectors.persist(StorageLevel.MEMORY_AND_DISK)

    def release(self) -> None:
        self.vectors.unpersist()


def prepare(
    train: DataFrame,
    label: str,
    path: str,
    partitions: int | None = None,
    categorical: list[str] = CATEGORICAL_FEATURES,
    numeric: list[str] = NUMERIC_FEATURES,
    one_hot: bool = True,
    fit_rows: int | None = None,
) -> TrainingSet:
    """Encode the training rows once, for every fit of every learner.

    ``fit_rows`` bounds the labelled rows that learners are fitted on, drawn by a hash of their content;
    by default all are. The encoding is always fitted on all rows. Its categories come to the driver,
    so ``categorical`` is for columns such as carriers and airports, not for row identifiers.

    The encoding looks at the inputs only, never at the label, so sharing it between folds
    tells a fold nothing about the answers. Storing the vectors cuts the lineage and fixes
    their order: folds come out the same when an executor is lost and rows are read again.
    """
    enable_checkpoints(train.sparkSession)
    encoding = encoder(categorical, numeric, one_hot).fit(train)
    drawn = train if fit_rows is None else train.orderBy(surrogate_key(*train.columns)).limit(fit_rows)
    encoded = encoding.transform(drawn).select("features", label)
    if partitions:
        encoded = encoded.repartition(partitions)
    # A category in one slot needs a bin per value and one for unseen values.
    bins = BINS if one_hot else max(BINS, *[len(labels) + 1 for labels in encoding.stages[0].labelsArray])
    return TrainingSet(write_table(encoded, path).frame, encoding, label, bins)


def _points(grid: Mapping[str, list[float]]) -> list[dict[str, float]]:
    return [dict(zip(grid, point)) for point in product(*grid.values())]


def content_key(training: TrainingSet, learner: Learner, folds: int) -> str:
    """A name for a search: what it fits (rows in any order), how, and on which folds."""
    rows = training.vectors.agg(
        F.count(F.lit(1)).alias("n"), F.sum(_row_hash(training).cast("decimal(20,0)")).alias("h")
    ).first()
    said = [learner.name, sorted(learner.settings.items()), training.label, training.bins, SEED, folds, rows["n"], str(rows["h"])]
    return hashlib.sha256(json.dumps(said).encode()).hexdigest()[:32]


def _row_hash(training: TrainingSet) -> Column:
    return F.xxhash64(vector_to_array("features"), F.col(training.label))


def with_fold(training: TrainingSet, folds: int) -> DataFrame:
    """Training rows with the fold they are held out in, by content: the same in every layout and after every
    restart, and copies of a row are in one fold."""
    return training.vectors.withColumn("fold", F.pmod(_row_hash(training), F.lit(folds)).cast("int"))


def _draws_slots(learner: Learner, estimator) -> bool:
    """Whether the learner draws slots by their number, so that it depends on slots that it cannot split."""
    name = "featureSubsetStrategy"
    return name in learner.grid or not estimator.hasParam(name) or estimator.getOrDefault(name) != "all"


def without_constant_slots(rows: DataFrame) -> DataFrame:
    """Rows whose vectors lack the slots that hold the same value in all of them, in the order of the others.

    Where few rows are fitted, most categories do not occur, and a slot that has one value splits nothing. A learner
    that tries all slots grows the same trees without them, in time that follows the rows and not the width. The
    first slot stays, as sums over a node are taken from it.
    """
    ends = rows.agg(Summarizer.metrics("min", "max").summary(F.col("features")).alias("of")).select("of.*").first()
    if not ends["min"].size:
        return rows
    constant = ends["min"].toArray() == ends["max"].toArray()
    kept = [slot for slot, same in enumerate(constant.tolist()) if slot == 0 or not same]
    if len(kept) == len(constant):
        return rows
    whole = rows.withColumnRenamed("features", "__whole")
    return VectorSlicer(inputCol="__whole", outputCol="features", indices=kept).transform(whole).drop("__whole")


def cross_validate(
    training: TrainingSet, learner: Learner, folds: int = FOLDS, parallelism: int | None = None, ledger: str | None = None
) -> list[tuple[dict[str, float], float]]:
    """The grid's points with their mean AUC over the folds, ``parallelism`` fits at a time (as many as the cores take).

    Each score is noted in ``ledger``, a folder that outlives the run, as soon as it is known, under the
    content of the training set and the settings. A search that was stopped takes up what is noted there and
    fits the rest only; other rows or settings have another name and share nothing.
    """
    spark = training.vectors.sparkSession
    points = _points(learner.grid)
    notes = f"{ledger}/{content_key(training, learner, folds)}" if ledger else None
    rows = with_fold(training, folds)
    bound = learner.estimator(training.label, training.bins)
    scorer = BinaryClassificationEvaluator(labelCol=training.label)

    def note(point: dict[str, float], fold: int) -> str:
        named = "-".join(f"{name}={value}" for name, value in sorted(point.items()))
        return f"{notes}/{named}-fold={fold}"

    def score(task: tuple[dict[str, float], int]) -> float:
        point, fold = task
        known = read_text(spark, note(point, fold)) if notes else None
        if known and known.endswith("\n"):
            return float(known)
        params = {bound.getParam(name): value for name, value in point.items()}
        fitted = bound.fit(rows.where(F.col("fold") != fold), params)
        auc = float(scorer.evaluate(fitted.transform(rows.where(F.col("fold") == fold))))
        if notes:
            if known is not None:  # cut short when it was written
                remove(spark, note(point, fold))
            write_text(spark, note(point, fold), f"{auc!r}\n")
        return auc

    tasks = [(point, fold) for point in points for fold in range(folds)]
    with owner(spark):
        narrow = rows if _draws_slots(learner, bound) else without_constant_slots(rows)
        if narrow is not rows:
            # Stored, as each task of a fit carries the plan of its rows with a name for every slot in it.
            rows = write_table(narrow, staged_folder(spark, "slots")).frame
        rows = dealt(rows)
        rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            with ThreadPoolExecutor(max_workers=parallelism or fits_at_once(rows)) as pool:
                # The deepest and longest first, so that none of them is left running alone.
                longest = sorted(range(len(tasks)), key=lambda k: -math.prod(tasks[k][0].values()))
                jobs = {k: pool.submit(inheritable_thread_target(spark)(score), tasks[k]) for k in longest}
                try:
                    found = [jobs[k].result() for k in range(len(tasks))]
                except BaseException:
                    pool.shutdown(wait=True, cancel_futures=True)
                    raise
        finally:
            rows.unpersist()
    return [(point, sum(found[k * folds : (k + 1) * folds]) / folds) for k, point in enumerate(points)]


def fit(
    training: TrainingSet, learner: Learner, folds: int = FOLDS, parallelism: int | None = None, ledger: str | None = None
) -> Fitted:
    """Fit one learner; with a grid, the point with the best cross-validated AUC is refitted on all rows.

    ``ledger`` lets a search that was stopped go on, see :func:`cross_validate`.
    """
    started = time.perf_counter()
    estimator, vectors = learner.estimator(training.label, training.bins), training.hold()
    scores, chosen = [], {}
    if learner.grid:
        scores = cross_validate(training, learner, folds, parallelism, ledger)
        chosen = max(scores, key=lambda scored: scored[1])[0]
    best = estimator.fit(dealt(vectors, alone=True), {estimator.getParam(name): value for name, value in chosen.items()})
    model = PipelineModel(stages=[*training.encoding.stages, best])
    return Fitted(learner.name, model, time.perf_counter() - started, scores)


def evaluate(model: PipelineModel, test: DataFrame, label: str, bins: int = 0) -> dict[str, float]:
    """The five metrics, rows counted and scoring time. Rows are scored once and kept as counts per score.

    The area under the curve is exact; ``bins`` takes it over at most so many thresholds, as the usual
    evaluator does with 1000.
    """
    started = time.perf_counter()
    late = vector_to_array("rawPrediction")[1]
    counts = score_counts(model.transform(test), label, late).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cells = confusion_metrics(confusion(counts)).first().asDict()
        seconds = time.perf_counter() - started
        values = {"auc": area_under_roc(counts, bins), **cells}
    finally:
        counts.unpersist()
    rows = sum(cells[name] for name in ("tp", "fp", "tn", "fn"))
    return {**{name: values[name] for name in METRICS}, "rows": rows, "evaluation_time": seconds}


def metrics_table(spark: SparkSession, rows: Iterable[tuple[str, Fitted, Mapping[str, float]]]) -> DataFrame:
    """One row per (target, model) with metrics and times: a handful of rows, whatever the data."""
    return spark.createDataFrame(
        [
            Row(
                target=target, model=fitted.name, position=i,
                **{name: float(values[name]) for name in METRICS},
                evaluation_time=float(values["evaluation_time"]), training_time=float(fitted.seconds),
            )
            for i, (target, fitted, values) in enumerate(rows)
        ]
    )


def rows_to_score(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Feature rows given in code, with the declared feature types."""
    return spark.createDataFrame([[row[name] for name in FEATURE_ROW.fieldNames()] for row in rows], FEATURE_ROW)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with the prediction and the probability of a delay."""
    return model.transform(df).select(
        *df.columns, "prediction", vector_to_array("probability")[1].alias("delay_probability")
    )
