"""Helpers shared by the operators: whole tables in, staged tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.staging import staged_folder

# White space that ends a word (space, tab, newline, vertical tab, form feed, return).
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    This cuts the lineage: what follows starts from committed files that outlive any executor,
    so a task that is run again reads the same rows under the same numbers. The folder belongs to the
    open owner of :mod:`ontime.staging`, and goes with it.
    """
    spark = df.sparkSession
    path = staged_folder(spark, f"llm/{name}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words(text: Column) -> Column:
    """The words of a text as an array; a null or blank text has none."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE_RUN)).otherwise(F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)
