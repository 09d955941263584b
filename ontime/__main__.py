"""Jobs for spark-submit: load the warehouse, write reports, train and apply classifiers.

    load   --data DIR --warehouse DIR [--separator SEP] [--delay-minutes N] [--jdbc [--connections N]]
    report --warehouse DIR [--out DIR] [--database NAME] [NAME ...]
    train  --warehouse DIR --out DIR [--partitions N] [--parallelism N] [--split hash|random] [--compact]
           [--ledger DIR]
    score  --model DIR --rows JSON --out DIR
    trees  --model DIR --out DIR    (a saved model's nodes as a table)
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from ontime.operators.features import enrich
from ontime.operators.models import PARALLELISM, score
from ontime.operators.trees import store_nodes
from ontime.plans.load import load_files, open_warehouse
from ontime.plans.reports import REPORTS
from ontime.plans.training import SPLITS, compare_models, store_comparison
from ontime.schemas import DELAY_MINUTES, FEATURE_ROW, KEY_SEPARATOR
from ontime.session import open_session
from ontime.sinks.jdbc import jdbc_options, write_jdbc
from ontime.sinks.outputs import load_model, store_in_catalog
from ontime.staging import owner, release_all


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    target = jdbc_options(os.environ) if args.jdbc else None
    warehouse = load_files(
        spark, args.data, args.warehouse, sep=args.separator, delay_minutes=args.delay_minutes
    )
    if target:
        for name, table in warehouse.tables.items():
            write_jdbc(table.frame, name, target, args.connections)


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    warehouse = open_warehouse(spark, args.warehouse)
    built = {name: REPORTS[name](warehouse) for name in args.names or REPORTS}
    if args.database:
        store_in_catalog(built, args.database)
    if args.out:
        for name, found in built.items():
            found.write.mode("overwrite").parquet(f"{args.out}/{name}")


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = open_warehouse(spark, args.warehouse).tables
    enriched = enrich(
        tables["fact_flights"].frame, tables["dim_date"], tables["dim_route"], tables["dim_time"]
    )
    comparison = compare_models(
        enriched, partitions=args.partitions, parallelism=args.parallelism, one_hot=not args.compact, split=args.split,
        ledger=args.ledger,
    )
    store_comparison(comparison, args.out, args.stamp)


def score_rows(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = spark.read.schema(FEATURE_ROW).json(args.rows)
    score(load_model(args.model), rows).write.mode("overwrite").parquet(args.out)


def trees(spark: SparkSession, args: argparse.Namespace) -> None:
    store_nodes(load_model(args.model).stages[-1], args.out)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="ontime", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    jobs = top.add_subparsers(required=True)

    job = jobs.add_parser("load")
    job.set_defaults(run=load)
    job.add_argument("--data", required=True)
    job.add_argument("--warehouse", required=True)
    job.add_argument("--separator", default=KEY_SEPARATOR)
    job.add_argument("--delay-minutes", type=int, default=DELAY_MINUTES)
    job.add_argument("--jdbc", action="store_true")
    job.add_argument("--connections", type=int, default=16)

    job = jobs.add_parser("report")
    job.set_defaults(run=report)
    job.add_argument("--warehouse", required=True)
    job.add_argument("--out")
    job.add_argument("--database", help="also, or only, keep the reports as tables of this database of the catalog")
    job.add_argument("names", nargs="*", metavar="NAME", choices=[[], *REPORTS])

    job = jobs.add_parser("train")
    job.set_defaults(run=train)
    job.add_argument("--warehouse", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--partitions", type=int)
    job.add_argument("--parallelism", type=int, default=PARALLELISM)
    job.add_argument("--split", choices=SPLITS, default="hash")
    job.add_argument("--ledger", help="folder that keeps the scores of a search; one that was stopped goes on from there")
    job.add_argument("--stamp", help="name of the run in --out; the time by default")
    job.add_argument(
        "--compact", action="store_true",
        help="a slot per category; numbers then get as many split candidates as the widest category has values",
    )

    job = jobs.add_parser("score")
    job.set_defaults(run=score_rows)
    job.add_argument("--model", required=True)
    job.add_argument("--rows", required=True)
    job.add_argument("--out", required=True)

    job = jobs.add_parser("trees")
    job.set_defaults(run=trees)
    job.add_argument("--model", required=True)
    job.add_argument("--out", required=True)
    return top


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = open_session()
    with owner(spark):  # what a job stages goes when it ends, well or not
        args.run(spark, args)


if __name__ == "__main__":
    try:
        main()
    finally:
        if running := SparkSession.getActiveSession():
            release_all(running)
