"""JDBC target for the warehouse tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

# Environment variables that describe the target.
HOST, PORT, DATABASE = "JDBC_HOST", "JDBC_PORT", "JDBC_DB"
USER, PASSWORD = "JDBC_USER", "JDBC_PASSWORD"
DRIVER = "org.postgresql.Driver"


def jdbc_options(env: Mapping[str, str]) -> dict[str, str]:
    """Connection options from the environment; a missing variable is an error."""
    missing = [name for name in (HOST, PORT, DATABASE, USER, PASSWORD) if not env.get(name)]
    if missing:
        raise KeyError(f"not set: {', '.join(missing)}")
    return {
        "url": f"jdbc:postgresql://{env[HOST]}:{env[PORT]}/{env[DATABASE]}",
        "user": env[USER],
        "password": env[PASSWORD],
        "driver": DRIVER,
    }


def write_jdbc(
    df: DataFrame, table: str, options: Mapping[str, str], connections: int = 16, batch_rows: int = 10_000
) -> None:
    """Replace a table's rows over at most ``connections`` connections, each of which writes one partition.

    Rows are dealt evenly to that many partitions first: a scan of any size then keeps its own tasks.

    The table itself is kept (``truncate``), so views on it survive a reload. Failures are raised.
    """
    settings = {
        **options,
        "dbtable": table,
        "truncate": "true",
        "numPartitions": str(connections),
        "batchsize": str(batch_rows),
    }
    df.repartition(connections).write.format("jdbc").options(**settings).mode("overwrite").save()
