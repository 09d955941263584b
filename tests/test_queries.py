"""Every registered query against its SQL on the smallest data set."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from ontime import catalogue

TABLES = "region nation customer supplier part orders lineitem events".split()
QUERIES = {name: contract.queries()[name] for name in catalogue.queries()}
ORACLES = {name: sql for name, sql in contract.oracle_sql().items() if name in QUERIES}

SQL_TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT",
    "boolean": "BOOLEAN", "date": "DATE",
}


@pytest.fixture(scope="module")
def sql(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, folder, sql, name):
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    relation = sql.sql(ORACLES[name])
    assert sorted(relation.columns) == columns
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: SQL_TYPES[t] for c, t in df.dtypes} == types
    order = [relation.columns.index(c) for c in columns]
    expected = Counter(tuple(row[i] for i in order) for row in relation.fetchall())
    assert Counter(tuple(row[c] for c in columns) for row in df.collect()) == expected
    assert expected


def test_entry(spark):
    report = contract.entry(spark)
    assert report.count() == 10
    assert report.columns[:3] == ["carrier_code", "carrier_name", "total_flights"]


def test_causes_add_up_to_the_delays(ws):
    totals = ws.warehouse["delay_reasons"].selectExpr(
        "sum(total_delays) as d",
        "sum(carrier_cause_delay + weather_cause_delay + nas_cause_delay + security_cause_delay"
        " + late_aircraft_cause_delay) as c",
    ).first()
    assert totals["d"] == totals["c"] > 0


def test_each_flight_has_one_date_and_one_carrier(ws):
    facts = ws.warehouse["fact_flights"]
    for dimension, key in [("dim_date", "date_code"), ("dim_carrier", "carrier_code"), ("dim_route", "route_key")]:
        assert facts.join(ws.warehouse[dimension], key).count() == facts.count()


def test_queries_may_be_built_from_several_threads(spark, folder, tmp_path):
    import os
    from concurrent.futures import ThreadPoolExecutor

    for name in TABLES:
        os.symlink(f"{folder}/{name}.parquet", tmp_path / f"{name}.parquet")
    names = ["rp_carrier_delays", "rp_monthly_delays", "dim_carrier", "null_fill"]
    with ThreadPoolExecutor(4) as pool:
        counts = list(pool.map(lambda n: QUERIES[n](spark, str(tmp_path)).count(), names))
    assert counts == [QUERIES[n](spark, folder).count() for n in names]
