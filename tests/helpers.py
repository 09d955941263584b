"""Small builders shared by the tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ontime.schemas import FLIGHTS

FLIGHT = {
    "year": 2013, "month": 1, "day": 11, "dep_time": 600, "sched_dep_time": 600, "dep_delay": 0, "arr_time": 700,
    "sched_arr_time": 700, "arr_delay": 0, "carrier": "AA", "flight": 1, "tailnum": "N1", "origin": "JFK",
    "dest": "LAX", "air_time": 60, "distance": 500, "hour": 6, "minute": 0, "time_hour": "x", "name": "Alpha",
}


def flights(spark: SparkSession, *changes: dict) -> DataFrame:
    rows = [tuple({**FLIGHT, **change}[name] for name in FLIGHTS.fieldNames()) for change in changes]
    return spark.createDataFrame(rows, FLIGHTS)


def rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df: DataFrame) -> str:
    """The physical plan as ``explain`` prints it."""
    import contextlib
    import io

    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()
