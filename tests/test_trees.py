"""Fitted trees as node tables, scored by joins here and by another engine; searches that were stopped."""

import os
import re

import duckdb
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, SparseVector, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import plan
from ontime.operators import models
from ontime.operators.features import width_and_slot
from ontime.operators.models import GRADIENT_BOOSTING, RANDOM_FOREST, Learner, cross_validate, fit, prepare
from ontime.operators.trees import score_by_nodes, store_nodes
from ontime.sources.tables import Table

LABEL = "late"


@pytest.fixture(scope="module")
def frame(spark):
    base = spark.range(0, 3000, 1, 4)
    return base.select(
        F.concat(F.lit("C"), F.col("id") % 9).alias("carrier"), F.concat(F.lit("A"), F.col("id") % 13).alias("origin"),
        (F.col("id") * 31 % 97).cast("int").alias("distance"), (F.col("id") * 7 % 24).cast("int").alias("hour"),
        (((F.col("id") % 9 < 4) & (F.col("id") * 31 % 97 > 40)) | (F.col("id") * 17 % 23 == 3)).cast("double").alias(LABEL),
    )


def prepared(frame, path, one_hot):
    return prepare(frame, LABEL, path, 2, ["carrier", "origin"], ["distance", "hour"], one_hot)


LEARNERS = [
    Learner("RandomForest", RANDOM_FOREST.kind, {"numTrees": 15, "maxDepth": 6}),
    Learner("GBT", GRADIENT_BOOSTING.kind, {"maxIter": 8, "maxDepth": 4}),
]

# Down every tree at once, then the leaves of a row in the order of the trees.
SQL = """
WITH RECURSIVE walk AS (
  SELECT row, x, t.tree, t.tree * 4294967296 AS node_key FROM rows, (SELECT DISTINCT tree FROM nodes) t
  UNION ALL
  SELECT row, x, w.tree, CASE WHEN coalesce(x[feature + 1] <= threshold, list_contains(categories, x[feature + 1])) THEN "left" ELSE "right" END
  FROM walk w JOIN nodes USING (node_key) WHERE NOT leaf
),
leaves AS (SELECT row, w.tree, votes, value * weight AS told FROM walk w JOIN nodes USING (node_key) WHERE leaf)
SELECT row,
  list_reduce(list(votes[1] ORDER BY tree), lambda a, b: a + b) AS on_time, list_reduce(list(votes[2] ORDER BY tree), lambda a, b: a + b) AS late,
  list_reduce(list(told ORDER BY tree), lambda a, b: a + b) AS margin
FROM leaves GROUP BY row
"""


@pytest.mark.parametrize("one_hot", [True, False])
@pytest.mark.parametrize("learner", LEARNERS, ids=lambda learner: learner.name)
def test_the_node_table_answers_as_the_model_does(spark, frame, tmp_path, learner, one_hot):
    training = prepared(frame, str(tmp_path / "vectors"), one_hot)
    fitted = fit(training, learner)
    trees = fitted.model.stages[-1]
    unseen = frame.withColumn("origin", F.when(F.col("hour") == 5, F.lit("nowhere")).otherwise(F.col("origin")))
    answered = fitted.model.transform(unseen).select(
        F.monotonically_increasing_id().alias("row"), "features", "prediction", vector_to_array("rawPrediction")[1].alias("raw")
    )
    answered.write.parquet(str(tmp_path / "answered"))
    stored = spark.read.parquet(str(tmp_path / "answered"))
    nodes = store_nodes(trees, str(tmp_path / "nodes"))
    assert nodes.frame.count() == trees.totalNumNodes and nodes.memory_bytes > 0
    assert not nodes.frame.where("categories IS NOT NULL").isEmpty() and not nodes.frame.where("threshold IS NOT NULL").isEmpty()
    expected = {r.row: (r.prediction, r.raw) for r in stored.collect()}
    for table in (nodes, Table(nodes.frame, nodes.path)):  # broadcast, joined by node
        got = {r.row: (r.prediction, r.score) for r in score_by_nodes(stored, table, trees).collect()}
        assert {k: p for k, (p, _) in got.items()} == {k: p for k, (p, _) in expected.items()}
        assert all(s == pytest.approx(expected[k][1], abs=1e-9) for k, (_, s) in got.items())
    stored.select("row", vector_to_array("features").alias("x")).write.parquet(str(tmp_path / "rows"))
    connection = duckdb.connect()
    for name in ("rows", "nodes"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}/*.parquet'")
    told = connection.sql(SQL).fetchall()
    predictions = {row: float(margin > 0 if learner.name == "GBT" else late > on_time) for row, on_time, late, margin in told}
    assert predictions == {k: p for k, (p, _) in expected.items()}
    assert len(set(predictions.values())) == 2


WIDEST = 2**31 - 1  # as an array, such a vector would be 16 GB


@pytest.mark.parametrize("learner", LEARNERS, ids=lambda learner: learner.name)
def test_rows_are_scored_where_they_are_whatever_the_width(spark, frame, tmp_path, learner):
    fitted = fit(prepared(frame, str(tmp_path / "vectors"), True), learner)
    trees = fitted.model.stages[-1]
    nodes = store_nodes(trees, str(tmp_path / "nodes"))
    sparse = [SparseVector(trees.numFeatures, {k % trees.numFeatures: 1.0, trees.numFeatures - 2: float(k)}) for k in range(60)]
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(sparse)], ["row", "features"])
    dense = spark.createDataFrame([(k, DenseVector(v.toArray())) for k, v in enumerate(sparse)], ["row", "features"])
    wide = spark.createDataFrame([(k, SparseVector(WIDEST, v.indices, v.values)) for k, v in enumerate(sparse)], ["row", "features"])
    expected = {r.row: r.prediction for r in trees.transform(rows).collect()}
    assert "Exchange" not in plan(score_by_nodes(rows, nodes, trees))
    for table in (nodes, Table(nodes.frame, nodes.path)):
        for given in (rows, dense, wide):
            assert {r.row: r.prediction for r in score_by_nodes(given, table, trees).collect()} == expected


def test_the_slot_of_a_one_hot_vector_is_read_whatever_its_width(spark):
    vectors = [(SparseVector(WIDEST, [7], [1.0]),), (SparseVector(3, [], []),), (None,)]
    schema = T.StructType([T.StructField("v", VectorUDT())])
    found = spark.createDataFrame(vectors, schema).select(*width_and_slot("v")).collect()
    assert [tuple(r) for r in found] == [(WIDEST, 7), (3, -1), (None, None)]


# -- searches


SEARCH = Learner("GBT", GRADIENT_BOOSTING.kind, {}, {"maxDepth": [1, 2], "maxIter": [1, 2]})


@pytest.fixture
def counted(monkeypatch):
    """Counts fits of a learner, and can be told to fail after some."""
    kind, state = GRADIENT_BOOSTING.kind, {"fits": 0, "fail_after": None}
    original = kind.fit

    def counting(self, *a):
        if state["fail_after"] is not None and state["fits"] >= state["fail_after"]:
            raise RuntimeError("stopped")
        state["fits"] += 1
        return original(self, *a)

    monkeypatch.setattr(kind, "fit", counting)
    return state


def test_a_stopped_search_goes_on_where_it_ended(spark, frame, tmp_path, counted):
    training, ledger = prepared(frame, str(tmp_path / "vectors"), False), str(tmp_path / "ledger")
    whole = cross_validate(training, SEARCH, folds=2, parallelism=1)
    assert counted["fits"] == 8
    counted |= {"fits": 0, "fail_after": 4}  # two points
    with pytest.raises(RuntimeError, match="stopped"):
        cross_validate(training, SEARCH, folds=2, parallelism=1, ledger=ledger)
    counted |= {"fits": 0, "fail_after": None}
    again = prepared(frame.repartition(5), str(tmp_path / "again"), False)  # the same rows elsewhere
    assert cross_validate(again, SEARCH, folds=2, parallelism=1, ledger=ledger) == whole
    assert counted["fits"] == 4
    assert cross_validate(training, SEARCH, folds=2, parallelism=3, ledger=ledger) == whole
    assert counted["fits"] == 4
    result = fit(training, SEARCH, folds=2, ledger=ledger)
    assert result.grid_scores == whole and counted["fits"] == 5  # the refit


def test_other_rows_or_settings_share_no_scores(spark, frame, tmp_path, counted):
    training, ledger = prepared(frame, str(tmp_path / "vectors"), False), str(tmp_path / "ledger")
    cross_validate(training, SEARCH, folds=2, ledger=ledger)
    fewer = prepared(frame.where("hour <> 3"), str(tmp_path / "fewer"), False)
    other = Learner("GBT", GRADIENT_BOOSTING.kind, {"stepSize": 0.2}, SEARCH.grid)
    for found, learner, folds in ((fewer, SEARCH, 2), (training, other, 2), (training, SEARCH, 3)):
        counted["fits"] = 0
        cross_validate(found, learner, folds=folds, ledger=ledger)
        assert counted["fits"] == 4 * folds


def test_a_score_cut_short_is_found_again(spark, frame, tmp_path, counted):
    training, ledger = prepared(frame, str(tmp_path / "vectors"), False), str(tmp_path / "ledger")
    whole = cross_validate(training, SEARCH, folds=2, ledger=ledger)
    notes = os.path.join(ledger, models.content_key(training, SEARCH, 2))
    name = sorted(n for n in os.listdir(notes) if not n.startswith("."))[0]
    for hidden in (f"{notes}/{name}", f"{notes}/.{name}.crc"):
        if os.path.exists(hidden):
            os.truncate(hidden, 0) if hidden.endswith("crc") else open(hidden, "w").write("0.")
    os.remove(f"{notes}/.{name}.crc")
    counted["fits"] = 0
    assert cross_validate(training, SEARCH, folds=2, ledger=ledger) == whole and counted["fits"] == 1


def test_copies_of_a_row_are_in_one_fold(spark, frame, tmp_path):
    training = prepared(frame.unionByName(frame), str(tmp_path / "vectors"), False)
    folded = models.with_fold(training, 3)
    assert folded.groupBy("features", LABEL).agg(F.countDistinct("fold").alias("n")).where("n > 1").isEmpty()
    assert sorted(r.fold for r in folded.select("fold").distinct().collect()) == [0, 1, 2]


# Rows of a few of many categories: most slots hold the same value in all of them.
def _few_of_many(spark, frame, path):
    many = [(f"M{k}",) for k in range(300)]
    wide = frame.where(F.col("hour") < 3).drop("carrier").join(spark.createDataFrame(many, "carrier string")).select(*frame.columns)
    return prepare(wide, LABEL, path, partitions=1, categorical=["carrier", "origin"], numeric=["distance", "hour"], fit_rows=60)


@pytest.mark.parametrize("learner", [SEARCH, Learner("RandomForest", RANDOM_FOREST.kind, {"numTrees": 3}, {"maxDepth": [2]})])
def test_a_search_fits_boosted_trees_on_the_slots_that_vary(spark, frame, tmp_path, monkeypatch, learner):
    training = _few_of_many(spark, frame, str(tmp_path / "vectors"))
    width, fit_width, kind = training.vectors.first().features.size, [], learner.kind
    original = kind.fit

    def seen(self, rows, *a):
        fit_width.append(rows.first().features.size)
        return original(self, rows, *a)

    monkeypatch.setattr(kind, "fit", seen)
    found = cross_validate(training, learner, folds=2)
    monkeypatch.setattr(models, "without_constant_slots", lambda rows: rows)
    narrow, fit_width[:] = set(fit_width), []
    assert cross_validate(training, learner, folds=2) == found and set(fit_width) == {width}
    # A forest draws slots by their number, so it sees all of them.
    assert narrow == {width} if learner is not SEARCH else max(narrow) < 100 < 300 < width


def test_trees_without_constant_slots_are_the_same_trees(spark, frame, tmp_path):
    training = _few_of_many(spark, frame, str(tmp_path / "vectors"))
    narrow = models.without_constant_slots(training.vectors)
    assert narrow.columns[0] != "__whole" and set(narrow.columns) == set(training.vectors.columns)
    grown = GRADIENT_BOOSTING.kind(labelCol=training.label, maxIter=4, maxDepth=4, seed=1)
    ends = training.vectors.agg(F.collect_list("features")).first()[0]
    kept = [k for k in range(ends[0].size) if k == 0 or len({v[k] for v in ends}) > 1]
    whole, cut = grown.fit(training.vectors), grown.fit(narrow)

    def named(model, names):
        return [re.sub(r"feature (\d+)", lambda m: f"feature {names[int(m[1])]}", tree.toDebugString).split("\n", 1)[1] for tree in model.trees]

    assert named(cut, kept) == named(whole, range(ends[0].size))
