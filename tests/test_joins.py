import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from ontime.operators.joins import attach_dimension
from ontime.plans.load import open_warehouse
from ontime.sources.tables import Table, measure, write_table


@pytest.fixture(scope="module")
def hot_facts(spark):
    """Nine hundred rows, a third of them identical, over ten keys; two keys have no dimension row."""
    return spark.range(0, 900, 1, 12).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 10).cast("int").alias("key"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("payload"),
    )


@pytest.fixture(scope="module")
def dimension(spark):
    return spark.createDataFrame([(k, f"name {k}") for k in range(8)] + [(3, "second three")], "key int, name string")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("broadcast_bytes", [10**9, 0])
def test_both_ways_give_the_rows_of_a_plain_join(spark, hot_facts, dimension, tmp_path, how, broadcast_bytes):
    facts = hot_facts.unionByName(spark.createDataFrame([(None, -1), (None, -2)], "key int, payload bigint"))
    stored = write_table(dimension, str(tmp_path / "dim"), dimension=True)
    got = attach_dimension(facts, stored, "key", how, broadcast_bytes)
    expected = facts.join(dimension, "key", how)
    assert got.columns == expected.columns
    assert rows(got) == rows(expected)


def test_only_a_measured_small_dimension_is_broadcast(hot_facts, dimension, tmp_path):
    stored = write_table(dimension, str(tmp_path / "dim"), dimension=True)
    hinted = "ResolvedHint"
    logical = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert hinted in logical(attach_dimension(hot_facts, stored, "key"))
    assert hinted not in logical(attach_dimension(hot_facts, stored, "key", broadcast_bytes=10))
    assert hinted not in logical(attach_dimension(hot_facts, Table(dimension, "unmeasured"), "key"))
    assert "Generate" not in plan(attach_dimension(hot_facts, stored, "key", broadcast_bytes=0))


def test_rows_count_whatever_they_hold(spark):
    empty = spark.range(100_000).select(F.lit(None).cast("string").alias("a"), F.lit("").alias("b"))
    assert measure(empty) >= 100_000 * 64
    assert measure(empty.limit(0)) == 0
    narrow = spark.range(100_000).selectExpr("cast(id % 10 AS int) AS a", "cast(1 AS int) AS b")
    assert measure(narrow) >= 100_000 * 80


def test_a_reopened_warehouse_knows_its_sizes(spark, ws):
    loaded = ws.warehouse.tables
    opened = open_warehouse(spark, f"{ws.folder}/warehouse")
    for name, table in loaded.items():
        assert opened.tables[name].memory_bytes == table.memory_bytes
        assert (table.memory_bytes is not None) == name.startswith("dim_")
