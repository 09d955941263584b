"""Carriers beyond 9,999 share codes of four digits: each code then has several names."""

from collections import Counter

import duckdb
import pytest
from helpers import plan, rows

import __spark_entry__ as contract
from ontime.operators import joins
from ontime.operators.joins import attach_dimension, attach_repeated
from ontime.sources.tables import write_table
from ontime.workspace import close_workspace

TABLES = "region nation customer supplier orders lineitem".split()


@pytest.fixture(scope="module")
def shared(spark, tmp_path_factory):
    """400 flights of six carriers under the codes C1234 (four of them), C0007 and C1235."""
    folder = str(tmp_path_factory.mktemp("shared_codes"))

    def store(name, n, *columns):
        spark.range(n).selectExpr(*columns).coalesce(1).write.parquet(f"{folder}/{name}.parquet")

    key = "element_at(array(12345L, 12346L, 1234L, 123456L, 7L, 1235L), int({} % 6 + 1))"
    store("region", 2, "int(id) r_regionkey", "'R' || id r_name")
    store("nation", 4, "int(id) n_nationkey", "'N' || id n_name", "int(id % 2) n_regionkey")
    store("customer", 4, "id c_custkey", "int(id) c_nationkey")
    store("supplier", 6, f"{key.format('id')} s_suppkey", "'S' || (9 - id) s_name", "int(id % 4) s_nationkey")
    store("orders", 200, "id o_orderkey", "id % 4 o_custkey", "concat(1 + id % 5, '-X') o_orderpriority")
    store(
        "lineitem", 400, "id div 2 l_orderkey", "id * 7 l_partkey", f"{key.format('(id * 5 div 4)')} l_suppkey", "int(id % 2) l_linenumber",
        "double(id % 50) l_quantity", "0.01D l_tax", "'N' l_returnflag", "timestamp_ntz'2001-02-03 00:00:00' + make_dt_interval(int(id % 90)) l_shipdate",
    )
    yield folder
    close_workspace(spark, folder)


@pytest.mark.parametrize("name", ["delay_reason_summary", "delay_reasons", "normalize_delays", "flights_summary", "report_views", "rp_delay_reasons_by_time"])
def test_codes_with_several_names_equal_sql(spark, shared, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{shared}/{table}.parquet/*.parquet'")
    relation = connection.sql(contract.oracle_sql()[name])
    columns = sorted(relation.columns)
    order = [relation.columns.index(c) for c in columns]
    expected = Counter(tuple(row[i] for i in order) for row in relation.fetchall())
    found = contract.queries()[name](spark, shared)
    assert Counter(tuple(row[c] for c in columns) for row in found.collect()) == expected and expected


def dimension(spark, *more):
    return spark.createDataFrame([("A", "x", 1), ("A", "y", 2), ("A", None, 3), ("A", "x", 1), ("B", "z", None), (None, "n", 4), *more], "k string, name string, n int")


@pytest.mark.parametrize("listed", [1, 2, 1024])
@pytest.mark.parametrize("stored", [True, False])
def test_lists_join_as_rows_do(spark, tmp_path, monkeypatch, listed, stored):
    monkeypatch.setattr(joins, "LISTED_ROWS", listed)
    facts = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3), ("C", 4), (None, 5)], "k string, f int")
    dim = dimension(spark)
    given = write_table(dim, str(tmp_path / "dim"), dimension=True) if stored else dim
    expected, got = attach_dimension(facts, dim, "k"), attach_repeated(facts, given, "k")
    assert got.columns == expected.columns and rows(got) == rows(expected) and len(rows(got)) == 9


def test_a_repeated_dimension_is_broadcast_only_when_small(spark, tmp_path):
    facts, stored = spark.range(5).selectExpr("concat('A', id) k"), write_table(dimension(spark), str(tmp_path / "dim"), dimension=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(attach_repeated(facts, stored, "k"))
        assert "Broadcast" not in plan(attach_repeated(facts, stored, "k", broadcast_bytes=1))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
