import datetime as dt

import pytest
from helpers import flights, rows
from pyspark.sql import functions as F

from ontime.functions import calendar, measures
from ontime.operators import star
from ontime.operators.quality import key_uniqueness, orphan_facts
from ontime.schemas import AIRPORTS, DELAY_CAUSES

AIRPORT_ROWS = [("JFK", "Kennedy", "US", "New York"), ("LAX", "Angeles", "US", "Los Angeles"), (None, "Field", "US", "X")]


def airports(spark, extra=()):
    return spark.createDataFrame([*AIRPORT_ROWS, *extra], AIRPORTS)


@pytest.mark.parametrize("delay, late", [(14, False), (15, False), (16, True), (None, False), (-3, False)])
def test_late_means_more_than_fifteen_minutes(spark, delay, late):
    fact = star.facts(flights(spark, {"dep_delay": delay, "arr_delay": delay})).first()
    assert (fact["is_departure_delayed"], fact["is_arrival_delayed"]) == (late, late)


def test_the_threshold_can_be_changed(spark):
    fact = star.facts(flights(spark, {"dep_delay": 16}), delay_minutes=20).first()
    assert fact["is_departure_delayed"] is False


@pytest.mark.parametrize(
    "hour, part",
    [(0, "Night"), (4, "Night"), (5, "Morning"), (11, "Morning"), (12, "Afternoon"), (16, "Afternoon"),
     (17, "Evening"), (20, "Evening"), (21, "Night"), (23, "Night")],
)
def test_parts_of_the_day(spark, hour, part):
    time = star.times(flights(spark, {"hour": hour, "minute": 5})).first()
    assert time["time_of_day"] == part
    assert time["formatted_time"] == f"{hour:02d}:05"
    assert time["time_id"] == hour * 60 + 5


def test_date_attributes(spark):
    date = star.dates(flights(spark, {"year": 2013, "month": 11, "day": 3})).first()
    assert date["date"] == dt.date(2013, 11, 3)
    assert date["day_of_week"] == "Sunday" and date["is_weekend"] is True
    assert date["month_name"] == "November"
    assert (date["day_of_year"], date["quarter"], date["day_of_month"]) == ("307", "4", 3)


@pytest.mark.parametrize("day, weekend", [(1, False), (2, True), (3, True), (4, False)])
def test_weekend_is_saturday_and_sunday(spark, day, weekend):
    assert star.dates(flights(spark, {"month": 11, "day": day})).first()["is_weekend"] is weekend


@pytest.mark.parametrize("parts", [(0, 1, 1), (2013, 2, 30), (2013, 0, 0)])
def test_impossible_dates_are_null(spark, parts):
    date = star.dates(flights(spark, dict(zip(("year", "month", "day"), parts)))).first()
    assert date["date"] is None and date["day_of_week"] is None and date["is_weekend"] is False


def test_packed_keys_collide_and_separated_keys_do_not(spark):
    two = flights(spark, {"month": 1, "day": 11}, {"month": 11, "day": 1})
    assert star.dates(two).select("date_code").distinct().count() == 2
    assert star.dates(two, sep="").select("date_code").distinct().count() == 1


def test_column_types_of_the_star(spark):
    built = star.build_star(flights(spark, {}), airports(spark))
    kinds = {name: dict(df.dtypes) for name, df in built.tables().items()}
    assert kinds["dim_date"] == {
        "year": "int", "month": "int", "day": "int", "date": "date", "date_code": "string", "day_of_week": "string",
        "day_of_month": "int", "day_of_year": "string", "month_name": "string", "quarter": "string",
        "is_weekend": "boolean",
    }
    assert kinds["dim_route"] == {"origin": "string", "destination": "string", "distance": "int", "route_key": "string"}
    assert kinds["dim_time"]["time_id"] == "int"
    assert kinds["fact_flights"] == {
        "tail_number": "string", "carrier_code": "string", "flight_number": "int", "air_time": "int",
        "route_key": "string", "date_code": "string", "time_id": "int", "is_departure_delayed": "boolean",
        "is_arrival_delayed": "boolean",
    }


def test_airports_without_code_are_dropped_and_repeats_kept_apart(spark):
    dim = star.airports(airports(spark, [("JFK", "Kennedy", "US", "Queens"), ("LAX", "Angeles", "US", "Los Angeles")]))
    assert [r[0] for r in rows(dim)] == ["JFK", "JFK", "LAX"]


def test_dimensions_hold_each_combination_once(spark):
    built = star.build_star(flights(spark, {}, {}, {"minute": 1}, {"distance": 501}), airports(spark))
    counts = {name: df.count() for name, df in built.tables().items()}
    assert counts == {
        "dim_carrier": 1, "dim_airport": 2, "dim_date": 1, "dim_route": 2, "dim_time": 2, "fact_flights": 4,
    }


def test_delay_reasons_keep_thirteen_columns(spark):
    causes = spark.createDataFrame(
        [(2013, 1, "AA", "Alpha", "JFK", "Kennedy", *[float(i) for i in range(15)])], DELAY_CAUSES
    )
    kept = star.delay_reasons(causes)
    assert len(kept.columns) == 13
    assert kept.first()["total_diversions"] == 8.0 and dict(kept.dtypes)["total_delays"] == "float"


def test_key_checks(spark):
    built = star.build_star(
        flights(spark, {"month": 1, "day": 11}, {"month": 11, "day": 1}, {"origin": "ZZZ"}, {"origin": "ZZZ"}),
        airports(spark, [("JFK", "Kennedy", "US", "Queens")]), sep="",
    )
    unique = {r["table_name"]: tuple(r)[1:] for r in key_uniqueness(built).collect()}
    assert unique["dim_date"] == (1, 1, 2)
    assert unique["dim_airport"] == (2, 1, 2)
    assert unique["dim_route"] == (2, 0, 1)
    orphans = {r["reference"]: tuple(r)[1:] for r in orphan_facts(built).collect()}
    assert orphans["origin"] == (1, 2)
    assert orphans["destination"] == orphans["carrier_code"] == orphans["date_code"] == (0, 0)


def test_a_date_needs_all_three_parts(spark):
    given = spark.createDataFrame([(2013, None, 5), (2013, 5, None), (None, 1, 1), (2013, 2, 30), (2013, 5, 1)], "y int, m int, d int")
    got = given.select(calendar.calendar_date(F.col("y"), F.col("m"), F.col("d")).cast("string")).collect()
    assert [r[0] for r in got] == [None, None, None, None, "2013-05-01"]


def test_a_clock_needs_hour_and_minute(spark):
    given = spark.createDataFrame([(None, 5), (5, None), (5, 7)], "h int, m int")
    assert [r[0] for r in given.select(calendar.clock_text(F.col("h"), F.col("m"))).collect()] == [None, None, "05:07"]


def test_a_large_share_is_kept(spark):
    given = spark.createDataFrame([(1000.0, 10.0), (1.0, 0.0)], "part double, whole double")
    got = [r[0] for r in given.select(measures.share(F.col("part"), F.col("whole")).cast("double")).collect()]
    assert got == [10000.0, None]
