"""Delay reports over the star schema.

Flights are counted per dimension key first and joined to the dimension afterwards. A fact
row never crosses the network: what is shuffled is one partial count per key and task, no
matter how many flights a single carrier, day or route holds. Counts are then multiplied out
by the join exactly as rows would be, so repeated dimension keys give the same numbers as
joining row by row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.functions.measures import percentage, share
from ontime.operators.joins import attach_dimension, attach_repeated
from ontime.plans.load import Warehouse
from ontime.sources.tables import Table

# Report name of each summed delay-cause measure, then the percentages and
# the measure each is relative to.
CAUSE_TOTALS = {
    "total_flights": "total_arrivals",
    "total_delayed_flights": "total_delays",
    "total_cancelled_flights": "total_cancellations",
    "total_diverted_flights": "total_diversions",
    "total_carrier_delays": "carrier_cause_delay",
    "total_weather_delays": "weather_cause_delay",
    "total_nas_delays": "nas_cause_delay",
    "total_security_delays": "security_cause_delay",
    "total_late_aircraft_delays": "late_aircraft_cause_delay",
}
CAUSE_SHARES = {
    "delay_percentage": ("total_delayed_flights", "total_flights"),
    "carrier_delay_percentage": ("total_carrier_delays", "total_delayed_flights"),
    "weather_delay_percentage": ("total_weather_delays", "total_delayed_flights"),
    "nas_delay_percentage": ("total_nas_delays", "total_delayed_flights"),
    "security_delay_percentage": ("total_security_delays", "total_delayed_flights"),
    "late_aircraft_delay_percentage": ("total_late_aircraft_delays", "total_delayed_flights"),
}

_COUNTS = ["total_flights", "departure_delayed_flights", "arrival_delayed_flights"]


def count_flights(facts: DataFrame, key: str) -> DataFrame:
    """Flights, late departures and late arrivals per key."""
    return facts.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_flights"),
        F.count_if("is_departure_delayed").alias("departure_delayed_flights"),
        F.count_if("is_arrival_delayed").alias("arrival_delayed_flights"),
    )


def add_counts(counted: DataFrame, *keys: str) -> DataFrame:
    return counted.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _COUNTS])


def _delay_percentages() -> dict[str, Column]:
    total = F.col("total_flights")
    return {
        "departure_delay_percentage": percentage(F.col("departure_delayed_flights"), total),
        "arrival_delay_percentage": percentage(F.col("arrival_delayed_flights"), total),
    }


def carrier_delays(facts: DataFrame, dim_carrier: DataFrame) -> DataFrame:
    """Delays by carrier, names in descending order with unnamed ones first."""
    report = count_flights(facts, "carrier_code").join(dim_carrier, "carrier_code")
    return (
        report.select("carrier_code", "carrier_name", *_COUNTS)
        .withColumns(_delay_percentages())
        .orderBy(F.desc_nulls_first("carrier_name"))
    )


def monthly_delays(facts: DataFrame, dim_date: DataFrame) -> DataFrame:
    by_day = count_flights(facts, "date_code").join(dim_date.select("date_code", "year", "month"), "date_code")
    return (
        add_counts(by_day, "year", "month")
        .withColumns(_delay_percentages())
        .orderBy(F.asc_nulls_last("year"), F.asc_nulls_last("month"))
    )


def route_delays(facts: DataFrame, dim_route: DataFrame, dim_airport: DataFrame) -> DataFrame:
    """Delays by route. The distance is part of a route, so a pair of airports can recur."""
    names = dim_airport.select("airport_code", "airport_name")
    by_route = count_flights(facts, "route_key").join(dim_route, "route_key")
    for role in ("origin", "destination"):
        by_route = by_route.join(
            names.select(F.col("airport_code").alias(role), F.col("airport_name").alias(f"{role}_airport_name")), role
        )
    endpoints = ["origin_airport_name", "destination_airport_name"]
    return (
        add_counts(by_route, *endpoints, "route_key")
        .select(*endpoints, *_COUNTS)
        .withColumns(_delay_percentages())
    )


def _airport_delays(
    facts: DataFrame, dim_route: DataFrame, dim_airport: DataFrame, role: str, movement: str, late: str
) -> DataFrame:
    total, delayed = f"total_{movement}s", f"delayed_{movement}s"
    by_airport = (
        facts.groupBy("route_key")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(late).alias("n_late"))
        .join(dim_route.select("route_key", role), "route_key")
        .groupBy(F.col(role).alias("airport_code"))
        .agg(F.sum("n").alias(total), F.sum("n_late").alias(delayed))
    )
    return dim_airport.join(by_airport, "airport_code").select(
        "airport_code", "airport_name", "city", "country", total, delayed,
        percentage(F.col(delayed), F.col(total)).alias(f"{movement}_delay_percentage"),
    )


def airport_departure_delays(facts: DataFrame, dim_route: DataFrame, dim_airport: DataFrame) -> DataFrame:
    return _airport_delays(facts, dim_route, dim_airport, "origin", "departure", "is_departure_delayed")


def airport_arrival_delays(facts: DataFrame, dim_route: DataFrame, dim_airport: DataFrame) -> DataFrame:
    return _airport_delays(facts, dim_route, dim_airport, "destination", "arrival", "is_arrival_delayed")


def flight_list(
    facts: DataFrame,
    dim_carrier: Table | DataFrame,
    dim_date: Table | DataFrame,
    dim_route: Table | DataFrame,
    dim_time: Table | DataFrame,
) -> DataFrame:
    """Every flight with its carrier, date, route and time; flights without a match drop out.

    A carrier code may have several names, and then a flight has a row for each. Carriers therefore come last: the
    other dimensions are looked up once a flight, and their keys are gone before it is repeated.
    """
    joined = facts
    for dimension, key in [(dim_date, "date_code"), (dim_route, "route_key"), (dim_time, "time_id")]:
        joined = attach_dimension(joined, dimension, key)
    joined = attach_repeated(joined, dim_carrier, "carrier_code")
    # The columns of the published list.
    return joined.select(
        "flight_number", "tail_number", "carrier_code", "carrier_name",
        "date", "day_of_week", "month", "year", "quarter",
        "origin", "destination", "distance", "formatted_time", "time_of_day",
        "is_departure_delayed", "is_arrival_delayed",
    )


def sum_causes(reasons: DataFrame, *keys: str) -> DataFrame:
    """The nine delay-cause totals per key, added up in double precision."""
    return reasons.groupBy(*keys).agg(
        *[F.sum(F.col(measure).cast("double")).alias(total) for total, measure in CAUSE_TOTALS.items()]
    )


def _with_shares(totals: DataFrame) -> DataFrame:
    return totals.withColumns(
        {name: share(F.col(part), F.col(whole)) for name, (part, whole) in CAUSE_SHARES.items()}
    )


def delay_reasons_by_month(reasons: DataFrame) -> DataFrame:
    return _with_shares(sum_causes(reasons, "year", "month")).orderBy(
        F.asc_nulls_last("year"), F.asc_nulls_last("month")
    )


def delay_reasons_by_airport(reasons: DataFrame, dim_airport: DataFrame) -> DataFrame:
    """Delay causes by airport, most delayed first; airports without any figure lead."""
    keys = ["airport_code", "airport_name"]
    summed = sum_causes(reasons, "airport_code").join(dim_airport.select(*keys), "airport_code")
    per_name = summed.groupBy(*keys).agg(*[F.sum(total).alias(total) for total in CAUSE_TOTALS])
    return _with_shares(per_name).orderBy(F.desc_nulls_first("total_delayed_flights"))


def delay_reason_list(
    reasons: DataFrame, dim_carrier: Table | DataFrame, dim_airport: Table | DataFrame
) -> DataFrame:
    """Every delay-cause row with its carrier and airport; a row for each name that the carrier code has, so names come last."""
    joined = attach_repeated(attach_dimension(reasons, dim_airport, "airport_code"), dim_carrier, "carrier_code")
    # The columns of the published list.
    return joined.select(
        "year", "month", "carrier_code", "carrier_name", "airport_code", "airport_name", "city", "country",
        "total_arrivals", "total_delays", "carrier_cause_delay", "weather_cause_delay", "nas_cause_delay",
        "security_cause_delay", "late_aircraft_cause_delay", "total_cancellations", "total_diversions",
    )


# Every report by name, over a loaded warehouse.
REPORTS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "flights_summary": lambda w: flight_list(
        w["fact_flights"], *[w.tables[d] for d in ("dim_carrier", "dim_date", "dim_route", "dim_time")]
    ),
    "rp_airport_depart_delays": lambda w: airport_departure_delays(
        w["fact_flights"], w["dim_route"], w["dim_airport"]
    ),
    "rp_airport_arrival_delays": lambda w: airport_arrival_delays(
        w["fact_flights"], w["dim_route"], w["dim_airport"]
    ),
    "rp_carrier_delays": lambda w: carrier_delays(w["fact_flights"], w["dim_carrier"]),
    "rp_monthly_delays": lambda w: monthly_delays(w["fact_flights"], w["dim_date"]),
    "rp_routes_by_delay": lambda w: route_delays(w["fact_flights"], w["dim_route"], w["dim_airport"]),
    "rp_delay_reasons_by_time": lambda w: delay_reasons_by_month(w["delay_reasons"]),
    "rp_delay_reasons_by_airport": lambda w: delay_reasons_by_airport(w["delay_reasons"], w["dim_airport"]),
    "delay_reason_summary": lambda w: delay_reason_list(
        w["delay_reasons"], w.tables["dim_carrier"], w.tables["dim_airport"]
    ),
}
