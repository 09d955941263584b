"""JSON files, views and fitted models."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def register_views(reports: Mapping[str, DataFrame]) -> list[str]:
    """Make reports available to SQL; nothing runs until a view is read."""
    for name, report in reports.items():
        report.createOrReplaceTempView(name)
    return list(reports)


def store_in_catalog(reports: Mapping[str, DataFrame], database: str) -> list[str]:
    """Write reports as tables of a database of the session's catalog, where any later session finds them by name.

    The database is made if it is not there; a table of the same name is replaced.
    """
    names = [f"`{database}`.`{name}`" for name in reports]
    for name, report in zip(names, reports.values()):
        report.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        report.write.mode("overwrite").format("parquet").saveAsTable(name)
    return names


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
