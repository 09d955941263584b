"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ontime.schemas import KEY_SEPARATOR


def surrogate_key(*parts: Column | str, sep: str = KEY_SEPARATOR) -> Column:
    """SHA-256 of the parts. ``sep=""`` packs them and lets different parts collide."""
    return F.sha2(F.concat_ws(sep, *parts), 256)


def hash_bucket(*parts: Column | str, buckets: int = 100) -> Column:
    """A bucket that depends on the row's content alone, never on where the row sits."""
    head = F.substring(surrogate_key(*parts), 1, 8)
    return (F.conv(head, 16, 10).cast("bigint") % buckets).cast("int")
