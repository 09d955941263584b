"""The registered training queries fit on every training row, in tasks that hold little of them."""

import pytest
from pyspark.sql import functions as F

from ontime import oracles
from ontime.operators import models
from ontime.operators.models import GRADIENT_BOOSTING, RANDOM_FOREST, dealt, fit_bytes, fits_at_once, plain, prepare
from ontime.schemas import TARGETS
from ontime.workspace import PLANTED, close_workspace, workspace


@pytest.fixture(scope="module")
def many(spark, tmp_path_factory):
    """A workspace over 1,000 flights, more than any bound there was."""
    folder = str(tmp_path_factory.mktemp("many"))

    def store(name, n, *columns):
        spark.range(n).selectExpr(*columns).coalesce(1).write.parquet(f"{folder}/{name}.parquet")

    store("region", 2, "int(id) r_regionkey", "'R' || id r_name")
    store("nation", 4, "int(id) n_nationkey", "'N' || id n_name", "int(id % 2) n_regionkey")
    store("customer", 4, "id c_custkey", "int(id) c_nationkey")
    store("supplier", 3, "id s_suppkey", "'S' || id s_name", "int(id) s_nationkey")
    store("orders", 500, "id o_orderkey", "id % 4 o_custkey", "concat(1 + id % 5, '-X') o_orderpriority")
    store(
        "lineitem", 1000, "id div 2 l_orderkey", "id l_partkey", "id % 3 l_suppkey", "int(id % 2) l_linenumber", "double(id % 50) l_quantity",
        "0.01D l_tax", "'N' l_returnflag", "timestamp_ntz'2001-02-03 00:00:00' + make_dt_interval(int(id % 90)) l_shipdate",
    )
    yield workspace(spark, folder)
    close_workspace(spark, folder)


@pytest.mark.parametrize("label", [*TARGETS.values(), PLANTED])
def test_all_training_rows_are_fitted(many, label):
    train, test = many.labelled(label)
    assert many.training_set(label).vectors.count() == train.count() > 500 > test.count() > 0


@pytest.mark.parametrize("learner", [RANDOM_FOREST, GRADIENT_BOOSTING], ids=lambda learner: learner.name)
def test_a_fit_sees_all_training_rows(many, monkeypatch, learner):
    label, seen, original = TARGETS["arrival"], [], learner.kind.fit

    def counted(self, rows, *a):
        seen.append(rows.count())
        return original(self, rows, *a)

    monkeypatch.setattr(learner.kind, "fit", counted)
    few = models.Learner(learner.name, learner.kind, {next(iter(learner.settings)): 2}, {"maxDepth": [2, 3]})
    many.fit(label, few)
    n = many.labelled(label)[0].count()
    # Two points on three folds see each row twice a point; the refit sees all of them.
    assert seen[-1] == n and sum(seen) == 2 * 2 * n + n
    assert plain(few).settings == few.settings


def test_the_sql_of_training_has_no_bound():
    assert not any("least(" in oracles.oracle_sql()[name] for name in ("train_rf", "train_gbt"))


def test_tasks_of_a_fit_hold_little(many, tmp_path, monkeypatch):
    train, _ = many.labelled(TARGETS["arrival"])
    rows = prepare(train, TARGETS["arrival"], str(tmp_path / "v"), partitions=1).vectors
    held = rows.count() * rows.first()["features"].size * models.SLOT_BYTES
    assert fit_bytes(rows) == held and fit_bytes(rows.where(F.lit(False))) == 0
    assert dealt(rows).rdd.getNumPartitions() == dealt(rows, alone=True).rdd.getNumPartitions() == 1
    assert fits_at_once(rows) >= models.PARALLELISM
    monkeypatch.setattr(models, "LEAST_TASK_BYTES", held // 3)
    assert dealt(rows).rdd.getNumPartitions() == 1 and dealt(rows, alone=True).rdd.getNumPartitions() == 3
    monkeypatch.setattr(models, "TASK_BYTES", held // 20 + 1)
    assert dealt(rows).rdd.getNumPartitions() == 20
    assert sorted(map(str, dealt(rows).collect())) == sorted(map(str, rows.collect()))
    monkeypatch.setattr(models, "storage_bytes", lambda spark: 5 * held)
    assert fits_at_once(rows) == 2
    monkeypatch.setattr(models, "storage_bytes", lambda spark: held)
    assert fits_at_once(rows) == 1
