"""Stored tables."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.staging import names_in, read_text, remove, write_text

# Surrogate keys are 64 characters wide. A dictionary page of this size holds a quarter of a million
# of them; beyond the default page, each row would carry its key in full.
WRITE_OPTIONS = {"parquet.dictionary.page.size": str(16 * 1024 * 1024)}


# What a row of a hashed relation takes beside its values: its entry in the map, header and key.
ROW_BYTES = 64
VALUE_BYTES = 8


@dataclass(frozen=True)
class Table:
    """A stored table; dimensions come with an estimate of what they take in memory once broadcast."""

    frame: DataFrame
    path: str
    memory_bytes: int | None = None


def memory_bytes(df: DataFrame) -> Column:
    """An upper estimate of a table as a hashed relation, as an aggregate: rows, values and text."""
    texts = [F.octet_length(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in df.columns]
    row = F.lit(ROW_BYTES + VALUE_BYTES * len(df.columns))
    return F.coalesce(F.sum(sum(texts, row)), F.lit(0)).cast("bigint").alias("memory_bytes")


def measure(df: DataFrame) -> int:
    return df.agg(memory_bytes(df)).first()["memory_bytes"]


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Let all cores work on a scan that splits into fewer pieces than there are cores.

    Input of any size splits into more pieces than that and is left as it is, unshuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def write_table(df: DataFrame, path: str, dimension: bool = False) -> Table:
    """Replace a Parquet table and read it back, so later plans start from files of known size."""
    df.write.mode("overwrite").options(**WRITE_OPTIONS).parquet(path)
    stored = read_table(df.sparkSession, path, df.schema)
    return Table(stored, path, measure(stored) if dimension else None)


# -- versions of a folder of tables

# Loads that have been published, one small file each, named by a rising number. It holds the name of the
# folder with that load's tables and ends with a line end, so a file cut short is not taken for one.
PUBLISHED = "_published"
_DIGITS = 12


def new_version(folder: str) -> str:
    """A folder for the tables of a load that nobody reads yet."""
    return f"{folder}/load-{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


def published(spark: SparkSession, folder: str) -> list[str]:
    """Folders of all published loads that are still there, the latest last."""
    notes = [read_text(spark, f"{folder}/{PUBLISHED}/{name}") for name in names_in(spark, f"{folder}/{PUBLISHED}")]
    there = set(names_in(spark, folder))
    return [f"{folder}/{note.strip()}" for note in notes if note and note.endswith("\n") and note.strip() in there]


def publish(spark: SparkSession, folder: str, version: str, keep: int = 2) -> None:
    """Make a finished load the one that readers open, in one step.

    Of two loads that finish at once, the later takes the next number. The ``keep`` latest loads stay, so
    that frames opened on the former one still find their files; older ones are removed.
    """
    name = version.rsplit("/", 1)[-1]
    number = len(names_in(spark, f"{folder}/{PUBLISHED}"))
    while not write_text(spark, f"{folder}/{PUBLISHED}/{number:0{_DIGITS}d}", f"{name}\n"):
        number += 1
    for old in published(spark, folder)[:-keep]:
        remove(spark, old)
