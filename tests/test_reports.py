import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from helpers import flights, plan, rows
from pyspark.sql import functions as F

from ontime.functions.measures import percentage, share
from ontime.operators.star import build_star
from ontime.plans import reports
from ontime.schemas import AIRPORTS

REASONS = (
    "year int, month int, carrier_code string, airport_code string, total_arrivals float, total_delays float, "
    "carrier_cause_delay float, weather_cause_delay float, nas_cause_delay float, security_cause_delay float, "
    "late_aircraft_cause_delay float, total_cancellations float, total_diversions float"
)


@pytest.mark.parametrize(
    "part, whole, expected",
    [(1, 3, 33.33), (2, 3, 66.67), (1, 800, 0.13), (201, 20000, 1.01), (3, 3, 100.0), (0, 7, 0.0), (5, 0, None)],
)
def test_percentage(spark, part, whole, expected):
    df = spark.createDataFrame([(part, whole)], "p bigint, w bigint")
    assert df.select(percentage(F.col("p"), F.col("w")).alias("x")).first()["x"] == expected


def test_percentage_equals_decimal_arithmetic(spark):
    draw = random.Random(3)
    pairs = [(draw.randrange(w + 1), w) for w in (draw.randrange(1, 10**draw.randrange(1, 10)) for _ in range(2000))]
    pairs += [(n, d) for d in (8, 16, 32, 80, 160, 800, 2000, 20000) for n in range(0, d, max(1, d // 100))]
    df = spark.createDataFrame(pairs, "p bigint, w bigint")
    for row in df.withColumn("x", percentage(F.col("p"), F.col("w"))).collect():
        exact = (Decimal(row["p"]) * 100 / row["w"]).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert row["x"] == float(exact)


@pytest.mark.parametrize(
    "part, whole, expected",
    [(1.0, 3.0, "33.33"), (1.0, 8.0, "12.50"), (5.0, 0.0, None), (None, 5.0, None), (5.0, None, None),
     (20.0, 2.0, "1000.00"), (9.99, 1.0, "999.00")],
)
def test_share(spark, part, whole, expected):
    df = spark.createDataFrame([(part, whole)], "p double, w double")
    got = df.select(share(F.col("p"), F.col("w")).alias("x"))
    assert dict(got.dtypes)["x"] == "decimal(38,2)"
    assert got.first()["x"] == (None if expected is None else Decimal(expected))


@pytest.fixture(scope="module", params=["-", ""])
def star(spark, request):
    """Random flights with one hot carrier and day, colliding dates, and repeated airport codes."""
    draw = random.Random(7)
    changes = [
        {
            "carrier": draw.choice(["AA", "AA", "AA", "BB", "CC"]), "month": draw.choice([1, 11]),
            "day": draw.choice([1, 11, 12]), "origin": draw.choice(["JFK", "LAX", "ZZZ"]),
            "dest": draw.choice(["JFK", "LAX", "ORD"]), "distance": draw.choice([100, 200]),
            "dep_delay": draw.choice([0, 16, None]), "arr_delay": draw.choice([0, 30]), "hour": draw.randrange(24),
        }
        for _ in range(400)
    ]
    names = {"AA": "Alpha", "BB": "Beta", "CC": None}
    for change in changes:
        change["name"] = names[change["carrier"]]
    airports = spark.createDataFrame(
        [("JFK", "Kennedy", "US", "New York"), ("JFK", "Kennedy", "US", "Queens"), ("JFK", "Idlewild", "US", "Queens"),
         ("LAX", "Angeles", "US", "LA"), ("ORD", "O'Hare", "US", "Chicago")], AIRPORTS,
    )
    built = build_star(flights(spark, *changes), airports, sep=request.param)
    for df in built.tables().values():
        df.cache()
    return built


def counted(joined, *keys):
    """Row-by-row counting after the join: what the reports must equal."""
    return rows(
        joined.groupBy(*keys).agg(
            F.count(F.lit(1)), F.count_if("is_departure_delayed"), F.count_if("is_arrival_delayed")
        )
    )


COUNTS = ["total_flights", "departure_delayed_flights", "arrival_delayed_flights"]


def test_carrier_report_counts_like_a_row_level_join(star):
    report = reports.carrier_delays(star.fact_flights, star.dim_carrier)
    joined = star.fact_flights.join(star.dim_carrier, "carrier_code")
    assert rows(report.select("carrier_code", "carrier_name", *COUNTS)) == counted(joined, "carrier_code", "carrier_name")
    assert [r["carrier_name"] for r in report.collect()] == [None, "Beta", "Alpha"]


def test_monthly_report_counts_like_a_row_level_join(star):
    report = reports.monthly_delays(star.fact_flights, star.dim_date)
    joined = star.fact_flights.join(star.dim_date, "date_code")
    assert rows(report.select("year", "month", *COUNTS)) == counted(joined, "year", "month")
    assert [r["month"] for r in report.collect()] == [1, 11]


def test_packed_keys_double_count_the_colliding_days(star):
    total = reports.monthly_delays(star.fact_flights, star.dim_date).agg(F.sum("total_flights")).first()[0]
    keys = star.dim_date.select("date_code").distinct().count()
    assert (total == 400) == (keys == star.dim_date.count())
    assert total >= 400


def test_route_report_counts_like_a_row_level_join(star):
    report = reports.route_delays(star.fact_flights, star.dim_route, star.dim_airport)
    from_airport = star.dim_airport.select(F.col("airport_code").alias("origin"), F.col("airport_name").alias("o"))
    to_airport = star.dim_airport.select(F.col("airport_code").alias("destination"), F.col("airport_name").alias("d"))
    joined = star.fact_flights.join(star.dim_route, "route_key").join(from_airport, "origin").join(to_airport, "destination")
    expected = sorted(((o, d, *n) for o, d, _, *n in counted(joined, "o", "d", "route_key")), key=repr)
    assert rows(report.select("origin_airport_name", "destination_airport_name", *COUNTS)) == expected


@pytest.mark.parametrize(
    "build, role, flag, names",
    [
        (reports.airport_departure_delays, "origin", "is_departure_delayed", ["total_departures", "delayed_departures"]),
        (reports.airport_arrival_delays, "destination", "is_arrival_delayed", ["total_arrivals", "delayed_arrivals"]),
    ],
)
def test_airport_reports_count_like_a_row_level_join(star, build, role, flag, names):
    per_airport = (
        star.fact_flights.join(star.dim_route, "route_key").groupBy(F.col(role).alias("airport_code"))
        .agg(F.count(F.lit(1)).alias("a"), F.count_if(flag).alias("b"))
    )
    expected = star.dim_airport.join(per_airport, "airport_code").select("airport_code", "airport_name", "city", "a", "b")
    report = build(star.fact_flights, star.dim_route, star.dim_airport)
    assert rows(report.select("airport_code", "airport_name", "city", *names)) == rows(expected)


def test_flight_list_has_one_row_per_match(star):
    listed = reports.flight_list(star.fact_flights, star.dim_carrier, star.dim_date, star.dim_route, star.dim_time)
    expected = star.fact_flights.join(star.dim_date, "date_code").count()
    assert listed.count() == expected and len(listed.columns) == 16


def reasons(spark, *changed):
    base = (2013, 1, "AA", "JFK", 10.0, 4.0, 1.0, 1.0, 1.0, 0.5, 0.5, 2.0, 1.0)
    names = [part.split()[0] for part in REASONS.split(", ")]
    return spark.createDataFrame(
        [tuple({**dict(zip(names, base)), **change}[n] for n in names) for change in changed], REASONS
    )


def test_causes_by_airport_lead_with_airports_without_figures_and_multiply_repeats(spark):
    airports = spark.createDataFrame(
        [("JFK", "Kennedy", "US", "a"), ("JFK", "Kennedy", "US", "b"), ("LAX", "Angeles", "US", "c"),
         ("ORD", "O'Hare", "US", "d")], "airport_code string, airport_name string, country string, city string",
    )
    nothing = {c: None for c in ("total_delays", "carrier_cause_delay", "weather_cause_delay", "nas_cause_delay",
                                 "security_cause_delay", "late_aircraft_cause_delay")}
    report = reports.delay_reasons_by_airport(
        reasons(spark, {}, {"month": 2}, {"airport_code": "LAX", "total_delays": 9.0}, {"airport_code": "ORD", **nothing},
                {"airport_code": "XXX"}), airports,
    ).collect()
    assert [(r["airport_code"], r["total_delayed_flights"]) for r in report] == [("ORD", None), ("JFK", 16.0), ("LAX", 9.0)]
    assert report[0]["delay_percentage"] is None and report[1]["delay_percentage"] == Decimal("40.00")


def test_causes_by_month_are_summed_in_double(spark):
    report = reports.delay_reasons_by_month(reasons(spark, {"month": 3}, {"month": 2}, {"month": 2, "total_delays": 0.1}))
    assert [r["month"] for r in report.collect()] == [2, 3]
    assert dict(report.dtypes)["total_delayed_flights"] == "double"
    assert report.first()["total_delayed_flights"] == pytest.approx(4.1, abs=1e-6)


def test_a_share_over_a_thousand_percent_is_kept(spark):
    report = reports.delay_reasons_by_month(reasons(spark, {"carrier_cause_delay": 100.0}))
    assert report.first()["carrier_delay_percentage"] == 2500


def test_facts_never_cross_the_network_before_they_are_counted(ws):
    """The first exchange above the fact scan carries partial counts."""
    w = ws.warehouse
    text = plan(reports.carrier_delays(w["fact_flights"], w["dim_carrier"]))
    tree = text[: text.index("(1) Scan")]
    fact_branch = tree[: tree.rindex("Scan parquet")] if tree.count("Scan parquet") > 1 else tree
    assert "HashAggregate" in fact_branch
    assert "ReadSchema: struct<carrier_code:string,is_departure_delayed:boolean,is_arrival_delayed:boolean>" in text


def test_flight_list_does_not_shuffle_the_facts(ws):
    w = ws.warehouse
    listed = reports.flight_list(
        w["fact_flights"], *[w.tables[d] for d in ("dim_carrier", "dim_date", "dim_route", "dim_time")]
    )
    text = plan(listed)
    assert text.count("BroadcastHashJoin Inner BuildRight") >= 4
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text


def test_flight_list_repeats_flights_for_shared_carrier_codes_after_all_other_lookups(spark):
    """A code with several names multiplies flights; date, route and time are then already found, once a flight."""
    found = flights(spark, *[{"name": name, "flight": k} for k, name in enumerate("Alpha Beta Gamma".split())])
    built = build_star(found, spark.createDataFrame([], AIRPORTS))
    dims = built.dim_carrier, built.dim_date, built.dim_route, built.dim_time
    listed = reports.flight_list(built.fact_flights, *dims)
    assert rows(listed.groupBy("flight_number").agg(F.count_distinct("carrier_name"), F.count("*"))) == [(k, 3, 3) for k in range(3)]
    keys = [block.split("Left keys [1]: [")[1].split("#")[0] for block in plan(listed).split("\n\n") if "Left keys [1]: [" in block]
    assert keys == ["date_code", "route_key", "time_id", "carrier_code"]
