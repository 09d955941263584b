"""Model inputs: enriched facts, feature frames, splits and vector encoding."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.functions.keys import hash_bucket
from ontime.operators.joins import attach_dimension
from ontime.operators.running import running_totals
from ontime.schemas import CATEGORICAL_FEATURES, FEATURES, NUMERIC_FEATURES
from ontime.sources.tables import Table, write_table
from ontime.staging import owner

TRAIN_SHARE = 0.8
SEED = 42

# What the keys of dates and routes are made of, as the dimensions name it.
DATE_PARTS = ["year", "month", "day"]
ROUTE_PARTS = ["origin", "destination", "distance"]


def enrich(
    facts: DataFrame, dim_date: Table | DataFrame, dim_route: Table | DataFrame, dim_time: Table | DataFrame
) -> DataFrame:
    """Facts with date, route and time; a flight without a match keeps nulls."""
    dated = attach_dimension(facts, dim_date, "date_code", how="left")
    routed = attach_dimension(dated, dim_route, "route_key", how="left")
    return attach_dimension(routed, dim_time, "time_id", how="left")


def enrich_by_parts(
    flights: DataFrame, dim_date: Table | DataFrame, dim_route: Table | DataFrame, dim_time: Table | DataFrame
) -> DataFrame:
    """:func:`enrich` for flights that hold what the keys of dates and routes are made of.

    Both are joined by those parts, so no key is hashed, stored or compared per flight. The rows are the same
    while different parts have different keys, as they have with a separator that no part contains. Parts are not null.
    """
    dated = attach_dimension(flights, dim_date, DATE_PARTS, how="left")
    routed = attach_dimension(dated, dim_route, ROUTE_PARTS, how="left")
    return attach_dimension(routed, dim_time, "time_id", how="left")


def feature_frame(enriched: DataFrame, label: str, features: list[str] = FEATURES) -> DataFrame:
    """Feature columns with the label last, flags as numbers, rows with any null dropped."""
    flags = {name: F.col(name).cast("double") for name in ("is_weekend", label) if name in [*features, label]}
    return enriched.select(*features, label).withColumns(flags).na.drop(how="any")


def random_bucket(seed: int = SEED) -> Column:
    """A bucket from 0 to 99 drawn per row. Rows keep theirs while they keep their partitions and order, so a
    table that is read more than once is stored with its buckets."""
    return F.floor(F.rand(seed) * 100)


def random_split(df: DataFrame, train_share: float = TRAIN_SHARE, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Row-level random split. Repeatable only while the rows keep their partitions and order."""
    drawn, limit = df.withColumn("bucket", random_bucket(seed)), round(train_share * 100)
    return drawn.where(F.col("bucket") < limit).drop("bucket"), drawn.where(F.col("bucket") >= limit).drop("bucket")


def with_bucket(df: DataFrame, *key: str) -> DataFrame:
    """A bucket from 0 to 99 by content (all columns unless a key is named)."""
    return df.withColumn("bucket", hash_bucket(*(key or df.columns)))


def hash_split(df: DataFrame, *key: str, train_share: float = TRAIN_SHARE) -> tuple[DataFrame, DataFrame]:
    """Split by content: the same rows on every layout and after every retry, copies on one side."""
    bucketed = with_bucket(df, *key)
    limit = round(train_share * 100)
    train = bucketed.where(F.col("bucket") < limit)
    test = bucketed.where(F.col("bucket") >= limit)
    return train.drop("bucket"), test.drop("bucket")


def feature_table(enriched: DataFrame, targets: Mapping[str, str], features: list[str] = FEATURES) -> DataFrame:
    """Features with all labels, and for each label ``<label>_bucket``: the bucket that ``hash_split`` puts the
    row in, or null where the row lacks a feature or that label."""
    labels = list(targets.values())
    flags = {name: F.col(name).cast("double") for name in ["is_weekend", *labels] if name in [*features, *labels]}
    table = enriched.select(*features, *labels).withColumns(flags)
    whole = {
        label: reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) if kind in ("double", "float") else F.col(c).isNotNull()
                                           for c, kind in table.select(*features, label).dtypes])
        for label in labels
    }
    return table.withColumns({f"{label}_bucket": F.when(whole[label], hash_bucket(*features, label)) for label in labels})


def labelled(table: DataFrame, label: str, train_share: float = TRAIN_SHARE) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of a label, from a stored feature table."""
    others = [c for c in table.columns if c.endswith("_bucket") or f"{c}_bucket" in table.columns and c != label]
    limit, bucket = round(train_share * 100), F.col(f"{label}_bucket")
    return table.where(bucket < limit).drop(*others), table.where(bucket >= limit).drop(*others)


def index_stage(categorical: list[str] = CATEGORICAL_FEATURES) -> StringIndexer:
    """Most frequent value first, ties by value; unseen values get an index of their own."""
    return StringIndexer(
        inputCols=categorical,
        outputCols=[f"{c}_idx" for c in categorical],
        handleInvalid="keep",
        stringOrderType="frequencyDesc",
    )


def category_table(df: DataFrame, column: str, path: str) -> Table:
    """The dictionary ``(<column>, n, <column>_idx)`` of a column's values, stored: the indexes of :func:`index_stage`.

    Values are counted per partition before they are shuffled; their rank is a running total over all
    of them in the order of count and value. No value comes to the driver, so a column of identifiers
    may be indexed too. Values have the order of their bytes. Nulls are not counted.
    """
    value = F.col(column).cast("string")
    counts = df.where(value.isNotNull()).groupBy(value.alias(column)).agg(F.count(F.lit(1)).alias("n"))
    index = f"{column}_idx"
    with owner(df.sparkSession):
        ranked = running_totals(counts, [F.desc("n"), F.asc(column)], {index: F.lit(1)})
        return write_table(ranked.withColumn(index, F.col(index).cast("double")), path, dimension=True)


def index_by_tables(df: DataFrame, dictionaries: Mapping[str, Table]) -> DataFrame:
    """``df`` with ``<column>_idx`` for each column that has a dictionary.

    A dictionary of proven small size is broadcast, any other joined by value, where adaptive execution
    splits the partition of a frequent one. A value or null that the dictionary lacks gets the number of its
    entries, as an index of its own.
    """
    for column, dictionary in dictionaries.items():
        index = f"{column}_idx"
        unseen = dictionary.frame.agg(F.count(F.lit(1)).cast("double").alias("__unseen"))
        entries = Table(dictionary.frame.select(F.col(column).alias("__value"), index), dictionary.path, dictionary.memory_bytes)
        found = attach_dimension(df.withColumn("__value", F.col(column).cast("string")), entries, "__value", how="left")
        df = found.join(F.broadcast(unseen)).withColumn(index, F.coalesce(index, "__unseen")).drop("__value", "__unseen")
    return df


def one_hot_stage(categorical: list[str] = CATEGORICAL_FEATURES) -> OneHotEncoder:
    return OneHotEncoder(
        inputCols=[f"{c}_idx" for c in categorical], outputCols=[f"{c}_ohe" for c in categorical]
    )


def width_and_slot(encoded: str) -> tuple[Column, Column]:
    """The width of a one-hot vector and the slot that is set in it, or -1.

    Both are read from the vector's own parts: as an array it is as long as there are categories, in every row.
    """
    parts = F.unwrap_udt(encoded)
    slot = F.when(F.size(parts["indices"]) > 0, parts["indices"][0]).otherwise(F.when(parts.isNotNull(), -1))
    return parts["size"], slot.cast("bigint")


def encoder(
    categorical: list[str] = CATEGORICAL_FEATURES, numeric: list[str] = NUMERIC_FEATURES, one_hot: bool = True
) -> Pipeline:
    """Index, one-hot and assemble. All categories are counted in one pass over the data.

    Tree learners keep a number per vector slot and row. ``one_hot=False`` leaves each category
    in a single slot, which trees split by groups of values: the same inputs in ten slots
    instead of one per airport and carrier.
    """
    suffix = "ohe" if one_hot else "idx"
    assembler = VectorAssembler(inputCols=[f"{c}_{suffix}" for c in categorical] + numeric, outputCol="features")
    encoding = [one_hot_stage(categorical)] if one_hot else []
    return Pipeline(stages=[index_stage(categorical), *encoding, assembler])
