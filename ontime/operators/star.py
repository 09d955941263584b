"""The star schema around single flights."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.functions.calendar import calendar_date, clock_text, date_attributes, day_part, minute_of_day
from ontime.functions.keys import surrogate_key
from ontime.functions.measures import is_late
from ontime.schemas import DELAY_MINUTES, KEY_SEPARATOR

# Key column of each dimension.
DIMENSION_KEYS = {
    "dim_carrier": "carrier_code",
    "dim_airport": "airport_code",
    "dim_date": "date_code",
    "dim_route": "route_key",
    "dim_time": "time_id",
}

# Warehouse name of each delay-cause column that is kept.
DELAY_REASON_COLUMNS = {
    "year": "year",
    "month": "month",
    "carrier": "carrier_code",
    "airport": "airport_code",
    "arr_flights": "total_arrivals",
    "arr_del15": "total_delays",
    "carrier_ct": "carrier_cause_delay",
    "weather_ct": "weather_cause_delay",
    "nas_ct": "nas_cause_delay",
    "security_ct": "security_cause_delay",
    "late_aircraft_ct": "late_aircraft_cause_delay",
    "arr_cancelled": "total_cancellations",
    "arr_diverted": "total_diversions",
}


@dataclass(frozen=True)
class Star:
    dim_carrier: DataFrame
    dim_airport: DataFrame
    dim_date: DataFrame
    dim_route: DataFrame
    dim_time: DataFrame
    fact_flights: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {field.name: getattr(self, field.name) for field in fields(self)}


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def carriers(flights: DataFrame) -> DataFrame:
    return renamed(flights, {"carrier": "carrier_code", "name": "carrier_name"}).distinct()


def airports(raw: DataFrame) -> DataFrame:
    """Airports that have a code. Rows that differ in any column stay apart."""
    names = {
        "iata_code": "airport_code",
        "name": "airport_name",
        "iso_country": "country",
        "municipality": "city",
    }
    coded = raw.where(F.col("iata_code").isNotNull())
    return renamed(coded.select(*[F.col(c).cast("string").alias(c) for c in names]), names).distinct()


def dates(flights: DataFrame, sep: str = KEY_SEPARATOR) -> DataFrame:
    day = flights.select("year", "month", "day").distinct()
    dated = day.withColumn("date", calendar_date(F.col("year"), F.col("month"), F.col("day")))
    extra = date_attributes(F.col("date"))
    return dated.select(
        "year", "month", "day", "date",
        surrogate_key("year", "month", "day", sep=sep).alias("date_code"),
        extra["day_of_week"].alias("day_of_week"),
        F.col("day").alias("day_of_month"),
        *[extra[name].alias(name) for name in ("day_of_year", "month_name", "quarter", "is_weekend")],
    )


def routes(flights: DataFrame, sep: str = KEY_SEPARATOR) -> DataFrame:
    pairs = renamed(flights, {"origin": "origin", "dest": "destination", "distance": "distance"}).distinct()
    return pairs.withColumn("route_key", surrogate_key(*pairs.columns, sep=sep))


def times(flights: DataFrame) -> DataFrame:
    hour, minute = F.col("hour"), F.col("minute")
    return flights.select(hour, minute).distinct().select(
        hour,
        minute,
        minute_of_day(hour, minute).alias("time_id"),
        day_part(hour).alias("time_of_day"),
        clock_text(hour, minute).alias("formatted_time"),
    )


def fact_columns(sep: str = KEY_SEPARATOR, delay_minutes: int = DELAY_MINUTES) -> dict[str, Column]:
    """The columns of the facts, over normalized flights."""
    return {
        "tail_number": F.col("tailnum"),
        "carrier_code": F.col("carrier"),
        "flight_number": F.col("flight"),
        "air_time": F.col("air_time"),
        "route_key": surrogate_key("origin", "dest", "distance", sep=sep),
        "date_code": surrogate_key("year", "month", "day", sep=sep),
        "time_id": minute_of_day(F.col("hour"), F.col("minute")),
        "is_departure_delayed": is_late(F.col("dep_delay"), delay_minutes),
        "is_arrival_delayed": is_late(F.col("arr_delay"), delay_minutes),
    }


def facts(flights: DataFrame, sep: str = KEY_SEPARATOR, delay_minutes: int = DELAY_MINUTES) -> DataFrame:
    """One row per flight with dimension keys; a narrow projection, no shuffle."""
    return flights.select(*[column.alias(name) for name, column in fact_columns(sep, delay_minutes).items()])


def build_star(
    flights: DataFrame, airport_rows: DataFrame, sep: str = KEY_SEPARATOR, delay_minutes: int = DELAY_MINUTES
) -> Star:
    """All six tables from normalized flights and raw airports.

    Each dimension reads its own two or three columns of ``flights``; the sets do not
    overlap, so from columnar files the five passes read no column twice.
    """
    return Star(
        dim_carrier=carriers(flights),
        dim_airport=airports(airport_rows),
        dim_date=dates(flights, sep),
        dim_route=routes(flights, sep),
        dim_time=times(flights),
        fact_flights=facts(flights, sep, delay_minutes),
    )


def delay_reasons(causes: DataFrame) -> DataFrame:
    return renamed(causes, DELAY_REASON_COLUMNS)
