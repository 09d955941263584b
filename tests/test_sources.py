import math
import re

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from helpers import plan
from ontime import testbed
from ontime.schemas import DELAY_CAUSES, FLIGHTS, declare
from ontime.sources.files import conform, fill_nulls, normalize, scan_csv

SMALL = declare("year int, carrier string, delay float")


def write(path, text):
    path.write_text(text)
    return str(path)


def test_columns_are_found_by_header_name_and_extras_survive(spark, tmp_path):
    path = write(tmp_path / "f.csv", "note,carrier,delay,year\nhi,AA,1.5,2013\n")
    df = conform(scan_csv(spark, path), SMALL)
    assert dict(df.dtypes) == {"note": "string", "carrier": "string", "delay": "float", "year": "int"}
    assert df.first().asDict() == {"note": "hi", "carrier": "AA", "delay": 1.5, "year": 2013}


def test_scan_reads_text_unless_asked_to_infer(spark, tmp_path):
    path = write(tmp_path / "f.csv", "a,b\n1,2.5\n")
    assert [kind for _, kind in scan_csv(spark, path).dtypes] == ["string", "string"]
    assert [kind for _, kind in scan_csv(spark, path, infer=True).dtypes] == ["int", "double"]


def test_scan_without_header(spark, tmp_path):
    path = write(tmp_path / "f.csv", "1,2\n3,4\n")
    assert scan_csv(spark, path, header=False).count() == 2


@pytest.mark.parametrize(
    "text, number",
    [("7", 7), ("7.0", 7), ("7.9", 7), ("-7.9", -7), ("1e3", 1000), ("NA", None), ("", None), ("12abc", None),
     ("5d", None), ("NaN", None), ("99999999999", None)],
)
def test_text_becomes_a_whole_number_or_null(spark, text, number):
    df = spark.createDataFrame([(text,)], "year string")
    assert conform(df, declare("year int")).first()["year"] == number


def test_text_without_a_digit_is_never_cast(spark):
    """A cast that fails raises inside Spark; in a column of NA that took most of the scan's time."""
    found = plan(conform(spark.createDataFrame([("NA",)], "year string").repartition(1), declare("year int")))
    casts = [found[at.start() - 60 : at.start()] for at in re.finditer(r"(try_)?cast\(year#\d+ as int\)", found)]
    assert casts and all(re.search(r"WHEN RLIKE\(year#\d+, \[0-9\]\) THEN coalesce\($", before) for before in casts)


def test_bad_float_is_null(spark):
    df = spark.createDataFrame([("x",), ("2.5",)], "d string")
    assert [r["d"] for r in conform(df, declare("d float")).collect()] == [None, 2.5]


def test_a_missing_declared_column_is_an_error(spark):
    with pytest.raises(AnalysisException):
        conform(spark.createDataFrame([("AA",)], "carrier string"), SMALL)


def test_null_text_marks_missing_strings_only_when_named(spark, tmp_path):
    path = write(tmp_path / "f.csv", "year,carrier,delay\nNA,NA,NA\n")
    assert tuple(normalize(scan_csv(spark, path), SMALL).first()) == (0, "NA", None)
    assert tuple(normalize(scan_csv(spark, path, null_text="NA"), SMALL).first()) == (0, "Unknown", None)


def test_null_fill_goes_by_type_and_leaves_float_and_bigint_alone(spark):
    schema = T.StructType(
        [
            T.StructField("i", T.IntegerType()), T.StructField("s", T.StringType()), T.StructField("d", T.DoubleType()),
            T.StructField("f", T.FloatType()), T.StructField("l", T.LongType()), T.StructField("b", T.BooleanType()),
        ]
    )
    filled = fill_nulls(spark.createDataFrame([(None,) * 6], schema))
    assert tuple(filled.first()) == (0, "Unknown", 0.0, None, None, None)
    assert filled.schema.simpleString() == schema.simpleString()


def test_null_fill_keeps_nan(spark):
    assert math.isnan(fill_nulls(spark.createDataFrame([(float("nan"),)], "d double")).first()["d"])


def test_declared_schemas():
    assert len(FLIGHTS) == 20 and len(DELAY_CAUSES) == 21
    assert {type(f.dataType) for f in DELAY_CAUSES.fields[6:]} == {T.FloatType}


def test_csv_scan_reads_only_needed_columns(spark, tmp_path):
    from helpers import plan

    path = write(tmp_path / "f.csv", "year,carrier,delay\n2013,AA,1\n")
    assert "ReadSchema: struct<carrier:string>" in plan(conform(scan_csv(spark, path), SMALL).select("carrier"))


def test_flights_are_shuffled_without_their_supplier(spark, tmp_path):
    def store(name, n, *columns):
        spark.range(n).selectExpr(*columns).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")

    store("customer", 3, "id c_custkey", "int(id) c_nationkey")
    store("supplier", 3, "id s_suppkey", "'S' || id s_name", "int(id) s_nationkey")
    store("orders", 2000, "id o_orderkey", "id % 3 o_custkey", "'1-URGENT' o_orderpriority")
    store(
        "lineitem", 4000, "id div 2 l_orderkey", "id l_partkey", "id % 3 l_suppkey", "int(id % 2) l_linenumber", "double(id % 50) l_quantity",
        "0.08D l_tax", "'R' l_returnflag", "timestamp_ntz'2001-02-03 00:00:00' l_shipdate",
    )
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")
    try:
        flown = testbed.flights_with_keys(spark, str(tmp_path))
        blocks = [block for block in plan(flown).split("\n\n") if "hashpartitioning(l_orderkey" in block]
        assert blocks and not any("s_name" in block for block in blocks)
        narrow = [block for block in plan(flown.select(*FLIGHTS.fieldNames())).split("\n\n") if "hashpartitioning(l_orderkey" in block]
        assert narrow and not any(wide in block for block in narrow for wide in ("l_shipdate", "l_tax", "l_returnflag", "l_linenumber"))
        assert flown.count() == 4000 and flown.where("name <> 'S' || (l_partkey % 3)").isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_flights_are_not_broadcast_where_few_of_their_columns_are_read(spark, folder):
    from ontime import testbed

    narrow = plan(testbed.flights(spark, folder).select("carrier", "year", "hour"))
    assert "SortMergeJoin" in narrow and "BuildLeft" not in narrow
