"""Counts, percentages and shares used by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_late(delay: Column, minutes: int) -> Column:
    """True above the threshold; an unknown delay is not late."""
    return F.coalesce(delay > minutes, F.lit(False))


def percentage(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent with two decimals, halves away from zero; null when ``whole`` is 0.

    The quotient is taken in hundredths of a percent: a true half is then exact in a
    double, so the rounding never depends on how a decimal fraction is stored.
    """
    return F.round(part * F.lit(10000.0) / F.nullif(whole, F.lit(0)), 0) / 100


def share(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent with two decimals, however large; null when ``whole`` is 0."""
    return (part / F.nullif(whole, F.lit(0.0)) * 100).try_cast("decimal(38,2)")
