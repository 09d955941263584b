"""Running totals in a global order, in two levels: within a partition, and over the partitions before."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontime.staging import staged_folder

_AT, _PART = "__at", "__part"


def running_totals(df: DataFrame, order: list[Column], totals: Mapping[str, Column]) -> DataFrame:
    """``df`` with a column per entry of ``totals``: the sum of its expression over all rows that come before.

    Rows are sorted by range across all partitions and stored in that order, so no task orders more than
    its share and a retried one sees the same rows. Partitions then add up their own rows; what the
    partitions before them hold is one row each, and only that is summed up in one place.
    """
    spark = df.sparkSession
    path = staged_folder(spark, "running")
    df.orderBy(*order).withColumn(_AT, F.monotonically_increasing_id()).write.parquet(path)
    # The upper bits of that number are the partition's.
    stored = spark.read.parquet(path).withColumn(_PART, F.shiftright(_AT, 33))
    names = list(totals)
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    sums = stored.groupBy(_PART).agg(*[F.sum(totals[name]).alias(name) for name in names])
    bases = sums.select(_PART, *[F.sum(name).over(earlier).alias(f"__{name}") for name in names])
    inside = Window.partitionBy(_PART).orderBy(_AT).rowsBetween(Window.unboundedPreceding, -1)
    found = stored.withColumns({name: F.sum(totals[name]).over(inside) for name in names})

    def whole(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)) + F.coalesce(F.col(f"__{name}"), F.lit(0))

    # One row per partition, so it can be sent to every task.
    return found.join(F.broadcast(bases), _PART).select(*df.columns, *[whole(name).alias(name) for name in names])
