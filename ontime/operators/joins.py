"""Attaching dimensions to fact rows at any size and skew."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ontime.sources.tables import Table

# A dimension is broadcast only when its estimate in memory, taken when it was stored, is below this.
BROADCAST_BYTES = 64 * 1024 * 1024

# Rows of one key that are joined as one list; a key with more has several lists.
LISTED_ROWS = 1024


def attach_dimension(
    facts: DataFrame, dimension: Table | DataFrame, key: str | list[str], how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join a dimension to fact rows on ``key`` (inner or left).

    A stored dimension of proven small size is broadcast: the facts are not shuffled at all. Any other is
    joined by its key, where adaptive execution splits the partition of a hot key among tasks and
    repeats just that partition of the dimension. Building the plan runs no job.
    """
    frame = dimension.frame if isinstance(dimension, Table) else dimension
    measured = dimension.memory_bytes if isinstance(dimension, Table) else None
    small = measured is not None and measured <= broadcast_bytes
    return facts.join(F.broadcast(frame) if small else frame, key, how)


def attach_repeated(facts: DataFrame, dimension: Table | DataFrame, key: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The inner join of :func:`attach_dimension` for a dimension that may have many rows per key.

    Its rows are folded into lists first, so that a fact row looks up a list and not each of its rows. The lists are
    unfolded in place, which costs a fraction of following a hashed relation from row to row.
    """
    frame = dimension.frame if isinstance(dimension, Table) else dimension
    told = [c for c in frame.columns if c != key]
    place = F.row_number().over(Window.partitionBy(key).orderBy(*told))
    lists = frame.withColumn("__list", F.floor((place - 1) / LISTED_ROWS)).groupBy(key, "__list").agg(
        F.collect_list(F.struct(*told)).alias("__listed")
    ).drop("__list")
    if isinstance(dimension, Table):
        lists = Table(lists, dimension.path, dimension.memory_bytes)
    found = attach_dimension(facts, lists, key, broadcast_bytes=broadcast_bytes)
    return found.select(*[c for c in found.columns if c != "__listed"], F.inline("__listed"))
