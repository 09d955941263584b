"""CSV scans and type conformance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.schemas import NULL_DEFAULTS


def scan_csv(
    spark: SparkSession, path: str, header: bool = True, infer: bool = False, null_text: str | None = None
) -> DataFrame:
    """A CSV file or folder with columns by header name.

    Columns arrive as text and take their types in :func:`conform`, so the files are read once;
    ``infer=True`` spends a second pass on guessing types. Empty fields are null, as is
    ``null_text`` where one is named.
    """
    reader = spark.read.option("header", header).option("inferSchema", infer)
    if null_text is not None:
        reader = reader.option("nullValue", null_text)
    return reader.csv(path)


def _as_declared(field: T.StructField, source: T.DataType) -> Column:
    column = F.col(field.name)
    if isinstance(field.dataType, T.IntegerType) and isinstance(source, T.StringType):
        # "12.0" is a whole number too; fractions are cut off. Text without a digit is not tried: a cast that
        # fails raises inside Spark, which takes many times as long as one that succeeds.
        return F.when(column.rlike("[0-9]"), F.coalesce(column.try_cast("int"), column.try_cast("decimal(38,18)").try_cast("int")))
    return column.try_cast(field.dataType)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give the declared columns their types; text that does not parse becomes null.

    A declared column the data lacks is an analysis error; an undeclared one passes through.
    """
    present = {field.name: field.dataType for field in df.schema}
    return df.withColumns(
        {field.name: _as_declared(field, present.get(field.name, field.dataType)) for field in schema}
    )


def fill_nulls(df: DataFrame) -> DataFrame:
    """Replace nulls by the default of the column's type; types without a default keep them."""
    return df.withColumns(
        {
            field.name: F.coalesce(F.col(field.name), F.lit(NULL_DEFAULTS[type(field.dataType)]))
            for field in df.schema
            if type(field.dataType) in NULL_DEFAULTS
        }
    )


def normalize(df: DataFrame, schema: T.StructType) -> DataFrame:
    return fill_nulls(conform(df, schema))
