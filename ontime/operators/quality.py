"""Profiles, samples and key checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.operators.star import DIMENSION_KEYS, Star


# Bytes of the digest that a longer value is counted by.
DIGEST_BYTES = 16


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def profile(df: DataFrame) -> DataFrame:
    """One row per column: position, type, rows, nulls and exact distinct values.

    Every column is grouped on its own. From columnar files each branch reads just that column,
    so together they read the table once, and counts are combined before they are shuffled. Files of
    text such as CSV would be parsed once for each column: :func:`profile_in_one_scan` is for those.
    """

    def one(position: int, name: str, kind: str) -> DataFrame:
        values = df.groupBy(F.col(name).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        return values.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_nulls"),
            F.count("value").alias("n_distinct"),
        ).select(
            F.lit(position).alias("position"), F.lit(name).alias("column_name"),
            F.lit(kind).alias("data_type"), "n_rows", "n_nulls", "n_distinct",
        )

    return _stack([one(i, name, kind) for i, (name, kind) in enumerate(df.dtypes, start=1)])


def profile_in_one_scan(df: DataFrame) -> DataFrame:
    """The rows of :func:`profile` from one reading of the input, for sources that cannot read a column alone.

    Every row emits each of its values, or a digest where that is shorter; they are counted per column and value
    in the partition before the one shuffle, so a frequent value is one row of each task.
    """

    def short(name: str, kind: str) -> Column:
        value = F.col(name)
        if kind in ("double", "float"):
            value = F.when(value == 0, F.lit(0.0)).otherwise(value)  # the two zeros are equal
        elif kind.startswith(("array", "struct")):
            value = F.to_json(value)
        value = value.cast("string").cast("binary")
        # A digest has 16 bytes, a value that stands for itself fewer, so the two never meet.
        return F.when(F.octet_length(value) < DIGEST_BYTES, value).otherwise(F.unhex(F.md5(value)))

    cells = F.array(*[
        F.struct(F.lit(i).alias("position"), short(name, kind).alias("value")) for i, (name, kind) in enumerate(df.dtypes, start=1)
    ])
    counts = df.select(F.inline(cells)).groupBy("position", "value").agg(F.count(F.lit(1)).alias("n"))
    found = counts.groupBy("position").agg(
        F.sum("n").alias("n_rows"), F.sum(F.when(F.col("value").isNull(), F.col("n"))).alias("n_nulls"), F.count("value").alias("n_distinct")
    )
    zero = F.lit(0).cast("bigint")
    columns = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes, start=1)]
    named = df.sparkSession.createDataFrame(columns, "position int, column_name string, data_type string")
    return named.join(found, "position", "left").select(
        "position", "column_name", "data_type", *[F.coalesce(c, zero).alias(c) for c in ("n_rows", "n_nulls", "n_distinct")]
    )


def sample(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows in the order of all columns: the same rows on every run."""
    return df.orderBy(*[F.asc_nulls_first(c) for c in df.columns]).limit(n)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def key_uniqueness(star: Star) -> DataFrame:
    """Per dimension: keys, keys with more than one row, and the most rows under one key."""

    def one(name: str, key: str) -> DataFrame:
        copies = star.tables()[name].groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        return copies.agg(
            F.count(F.lit(1)).alias("n_keys"),
            F.count_if(F.col("n") > 1).alias("n_repeated_keys"),
            F.coalesce(F.max("n"), F.lit(0)).alias("max_rows_per_key"),
        ).select(F.lit(name).alias("table_name"), "n_keys", "n_repeated_keys", "max_rows_per_key")

    return _stack([one(name, key) for name, key in DIMENSION_KEYS.items()])


def orphan_facts(star: Star) -> DataFrame:
    """Fact keys without a dimension row, and how many flights carry them.

    Facts are counted per key before any join, so a hot key is one row when it is checked.
    Airports are reached through the route, once as origin and once as destination.
    """

    def one(name: str, counted: DataFrame, key: str, dimension: DataFrame, dimension_key: str) -> DataFrame:
        known = dimension.select(F.col(dimension_key).alias(key))
        lost = counted.join(known, key, "left_anti")
        return lost.agg(
            F.count(F.lit(1)).alias("n_orphan_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_orphan_facts")
        ).select(F.lit(name).alias("reference"), "n_orphan_keys", "n_orphan_facts")

    def count_by(frame: DataFrame, key: str) -> DataFrame:
        return frame.groupBy(key).agg(F.count(F.lit(1)).alias("n"))

    direct = [
        one(key, count_by(star.fact_flights, key), key, star.tables()[name], key)
        for name, key in DIMENSION_KEYS.items()
        if key in star.fact_flights.columns
    ]
    by_route = count_by(star.fact_flights, "route_key").join(star.dim_route, "route_key")
    through_route = [
        one(role, by_route.groupBy(role).agg(F.sum("n").alias("n")), role, star.dim_airport, "airport_code")
        for role in ("origin", "destination")
    ]
    return _stack(direct + through_route)
