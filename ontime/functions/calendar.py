"""Calendar and clock expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ontime.schemas import DAY_PART_OTHERWISE, DAY_PARTS, WEEKEND_DAYS


def calendar_date(year: Column, month: Column, day: Column) -> Column:
    """The date, or null where the three numbers name no day."""
    # concat, unlike concat_ws, is null as soon as one part is.
    return F.concat(year, F.lit("-"), month, F.lit("-"), day).try_cast("date")


def date_attributes(date: Column) -> dict[str, Column]:
    """Calendar columns of a date. Day of year and quarter are text, as in the warehouse."""
    return {
        "day_of_week": F.date_format(date, "EEEE"),
        "day_of_year": F.dayofyear(date).cast("string"),
        "month_name": F.date_format(date, "MMMM"),
        "quarter": F.quarter(date).cast("string"),
        "is_weekend": F.coalesce(F.dayofweek(date).isin(WEEKEND_DAYS), F.lit(False)),
    }


def minute_of_day(hour: Column, minute: Column) -> Column:
    return (hour * 60 + minute).cast("int")


def clock_text(hour: Column, minute: Column) -> Column:
    """Hour and minute as HH:MM, or null where either is missing."""
    return F.when(hour.isNotNull() & minute.isNotNull(), F.format_string("%02d:%02d", hour, minute))


def day_part(hour: Column) -> Column:
    named = [F.when((hour >= first) & (hour < end), F.lit(name)) for name, first, end in DAY_PARTS]
    return F.coalesce(*named, F.lit(DAY_PART_OTHERWISE))
