"""Loading the warehouse: normalize once, store, and derive every table from the stored flights."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from ontime.operators.star import DIMENSION_KEYS, Star, build_star, delay_reasons
from ontime.schemas import AIRPORTS, DELAY_CAUSES, DELAY_MINUTES, FLIGHTS, KEY_SEPARATOR
from ontime.session import plan_shuffles
from ontime.sinks.outputs import write_json
from ontime.sources.files import conform, normalize, scan_csv
from ontime.sources.tables import Table, new_version, publish, published, read_table, write_table
from ontime.staging import names_in, remove

# Names of the input files.
FLIGHTS_FILE, CAUSES_FILE, AIRPORTS_FILE = "flight_data.csv", "delay_cause.csv", "airports.csv"
TABLES = [*DIMENSION_KEYS, "fact_flights", "delay_reasons"]

# One row per dimension, beside the tables: what it takes in memory.
SIZES, SIZES_SCHEMA = "dimension_sizes", "name string, memory_bytes bigint"


@dataclass(frozen=True)
class Warehouse:
    flights: Table
    tables: dict[str, Table]

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name].frame

    def star(self) -> Star:
        return Star(**{name: table.frame for name, table in self.tables.items() if name != "delay_reasons"})


def store_tables(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str) -> dict[str, Table]:
    """Write tables of a star, with the sizes of dimensions; these decide how each is joined later.

    The tables do not depend on each other, so the short dimension jobs run beside the fact table's.
    """

    def store(name: str, df: DataFrame) -> Table:
        return write_table(df, f"{folder}/{name}", dimension=name in DIMENSION_KEYS)

    in_session = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        jobs = {name: pool.submit(in_session(store), name, df) for name, df in tables.items()}
        return {name: job.result() for name, job in jobs.items()}


def store_star(star: Star, folder: str) -> dict[str, Table]:
    """Write the star and note the sizes of its dimensions."""
    stored = store_tables(star.fact_flights.sparkSession, star.tables(), folder)
    sizes = [(name, table.memory_bytes) for name, table in stored.items() if table.memory_bytes is not None]
    write_json(star.fact_flights.sparkSession.createDataFrame(sizes, SIZES_SCHEMA).coalesce(1), f"{folder}/{SIZES}")
    return stored


def store_delay_reasons(causes: DataFrame, folder: str) -> Table:
    return write_table(delay_reasons(normalize(causes, DELAY_CAUSES)), f"{folder}/delay_reasons")


def load_star(
    flights: DataFrame, airports: DataFrame, folder: str, sep: str = KEY_SEPARATOR, delay_minutes: int = DELAY_MINUTES
) -> Warehouse:
    """The normalized flights and the six tables built from them, stored in ``folder``; no delay reasons."""
    conformed = write_table(normalize(flights, FLIGHTS), f"{folder}/flights")
    return Warehouse(conformed, store_star(build_star(conformed.frame, airports, sep, delay_minutes), folder))


def load_warehouse(
    flights: DataFrame,
    airports: DataFrame,
    causes: DataFrame,
    folder: str,
    sep: str = KEY_SEPARATOR,
    delay_minutes: int = DELAY_MINUTES,
) -> Warehouse:
    """All seven tables from the three inputs.

    The normalized flights are stored first: the six tables built from them then read narrow
    column sets from Parquet rather than the raw files six times over.

    Tables go to a folder of this load inside ``folder``, which becomes the warehouse in one step when all
    are there. A load that fails raises, leaves the former warehouse as it was and removes its own folder.
    """
    spark = flights.sparkSession
    plan_shuffles(spark, flights, airports, causes)
    version = new_version(folder)
    try:
        loaded = load_star(flights, airports, version, sep, delay_minutes)
        loaded.tables["delay_reasons"] = store_delay_reasons(causes, version)
        publish(spark, folder, version)
    except BaseException:
        remove(spark, version)
        raise
    return loaded


def load_files(spark: SparkSession, data: str, folder: str, **options) -> Warehouse:
    """The warehouse from a folder with the three CSV inputs."""
    airports = conform(scan_csv(spark, f"{data}/{AIRPORTS_FILE}"), AIRPORTS)
    flights, causes = (scan_csv(spark, f"{data}/{name}") for name in (FLIGHTS_FILE, CAUSES_FILE))
    return load_warehouse(flights, airports, causes, folder, **options)


def open_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse that the latest finished load left, with the sizes of its dimensions as noted then.

    A load of the star alone has its delay reasons beside it, if they were stored.
    """
    loads = published(spark, folder)
    if not loads:
        raise FileNotFoundError(f"no finished load in {folder}")
    latest = loads[-1]
    sizes = {row["name"]: row["memory_bytes"] for row in spark.read.schema(SIZES_SCHEMA).json(f"{latest}/{SIZES}").collect()}
    stored = {name: f"{latest}/{name}" for name in ["flights", *TABLES]}
    if "delay_reasons" not in names_in(spark, latest):
        del stored["delay_reasons"]
        if "delay_reasons" in names_in(spark, folder):
            stored["delay_reasons"] = f"{folder}/delay_reasons"
    tables = {name: Table(read_table(spark, path), path, sizes.get(name)) for name, path in stored.items()}
    plan_shuffles(spark, *[table.frame for table in tables.values()])
    return Warehouse(tables.pop("flights"), tables)
