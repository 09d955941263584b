"""Declared schemas and the constants that define the numbers.

Everything in this module is a fixed value: names, types, thresholds and
formats that have to be exactly these for results to come out right.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"int": T.IntegerType(), "float": T.FloatType(), "string": T.StringType(), "double": T.DoubleType()}


def declare(text: str) -> T.StructType:
    """``"year int, carrier string"`` as a StructType (no session needed)."""
    pairs = [entry.split() for entry in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Columns of the three input files, in file order.
FLIGHTS = declare(
    "year int, month int, day int, dep_time int, sched_dep_time int, dep_delay int, arr_time int, "
    "sched_arr_time int, arr_delay int, carrier string, flight int, tailnum string, origin string, "
    "dest string, air_time int, distance int, hour int, minute int, time_hour string, name string"
)
DELAY_CAUSES = declare(
    "year int, month int, carrier string, carrier_name string, airport string, airport_name string, "
    "arr_flights float, arr_del15 float, carrier_ct float, weather_ct float, nas_ct float, "
    "security_ct float, late_aircraft_ct float, arr_cancelled float, arr_diverted float, "
    "arr_delay float, carrier_delay float, weather_delay float, nas_delay float, "
    "security_delay float, late_aircraft_delay float"
)
AIRPORTS = declare("iata_code string, name string, iso_country string, municipality string")

# Model inputs. The label is appended per target.
CATEGORICAL_FEATURES = ["carrier_code", "origin", "destination", "day_of_week", "month", "time_of_day"]
NUMERIC_FEATURES = ["distance", "air_time", "day_of_month", "is_weekend"]
FEATURES = [
    "carrier_code", "origin", "destination", "distance", "air_time",
    "day_of_week", "is_weekend", "day_of_month", "month", "time_of_day",
]
TARGETS = {"arrival": "is_arrival_delayed", "departure": "is_departure_delayed"}
FEATURE_ROW = declare(
    "carrier_code string, origin string, destination string, distance int, air_time int, "
    "day_of_week string, is_weekend double, day_of_month int, month int, time_of_day string"
)

# What a missing entry becomes, by declared type. Float is left out on
# purpose: delay-cause measures keep their nulls.
NULL_DEFAULTS = {T.IntegerType: 0, T.StringType: "Unknown", T.DoubleType: 0.0}

# A flight is late above this many minutes.
DELAY_MINUTES = 15

# Parts of the day as half-open hour ranges; any other hour is the last name.
DAY_PARTS = [("Morning", 5, 12), ("Afternoon", 12, 17), ("Evening", 17, 21)]
DAY_PART_OTHERWISE = "Night"

# Weekend days as numbered by ``dayofweek`` (Sunday is 1).
WEEKEND_DAYS = [1, 7]

# Separator between the parts of a surrogate key. An empty one packs the parts together,
# which makes 11 January and 1 November the same key.
KEY_SEPARATOR = "-"
