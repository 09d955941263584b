import pytest
from helpers import rows
from pyspark.sql import functions as F

from ontime.session import shared_folder
from ontime.sinks.jdbc import jdbc_options
from ontime.sinks.outputs import register_views, write_json
from ontime.sources.tables import read_table, spread, write_table

ENV = {"JDBC_HOST": "db", "JDBC_PORT": "5432", "JDBC_DB": "dwh", "JDBC_USER": "u", "JDBC_PASSWORD": "p"}


def test_jdbc_options_come_from_the_environment():
    assert jdbc_options(ENV) == {
        "url": "jdbc:postgresql://db:5432/dwh", "user": "u", "password": "p", "driver": "org.postgresql.Driver",
    }


@pytest.mark.parametrize("name", sorted(ENV))
def test_a_missing_jdbc_variable_is_an_error(name):
    with pytest.raises(KeyError, match=name):
        jdbc_options({k: v for k, v in ENV.items() if k != name})


def test_a_table_is_replaced_not_appended_to(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    table = write_table(spark.range(3), path)
    assert rows(table.frame) == [(0,), (1,), (2,)] == rows(read_table(spark, path))


def test_a_failing_write_is_raised(spark, tmp_path):
    with pytest.raises(Exception):
        write_table(spark.range(3).select(F.raise_error(F.lit("no")).cast("int").alias("x")), str(tmp_path / "t"))


def test_json_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("a", 0.25), ("b", None)], "name string, value double")
    write_json(df, str(tmp_path / "j"))
    assert rows(spark.read.schema(df.schema).json(str(tmp_path / "j"))) == rows(df)


def test_views_can_be_queried(spark):
    assert register_views({"report_a": spark.range(4), "report_b": spark.range(2)}) == ["report_a", "report_b"]
    assert spark.sql("select (select count(*) from report_a) - (select count(*) from report_b) as n").first()["n"] == 2


def test_small_scans_are_spread_and_wide_ones_left_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == cores
    assert spread(spark.range(0, 100, 1, 3 * cores)).rdd.getNumPartitions() == 3 * cores


def test_everything_is_staged_below_the_configured_folder(spark):
    folder = shared_folder(spark)
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir") + "/ontime-")
    assert folder == shared_folder(spark)


def test_wide_keys_are_stored_once_per_file(spark, tmp_path):
    """Forty thousand distinct keys, each on some ten rows: far less than the keys written out in full."""
    number = F.pmod(F.hash("id"), F.lit(40_000)).cast("string")
    keys = spark.range(0, 400_000, 1, 1).select(F.sha2(number, 256).alias("route_key"))
    write_table(keys, str(tmp_path / "t"))
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    assert size < 400_000 * 64 / 5
