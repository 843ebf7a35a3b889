"""Command line for ``spark-submit``: build one mart table, or all of them."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from salesmart.functions.times import GRAINS
from salesmart.plans.mart import TABLES, build_mart, build_table
from salesmart.sinks.store import MartStore
from salesmart.sources.catalog import register_external
from salesmart.sources.csv_ingest import CsvOptions, csv_to_parquet
from salesmart.sources.raw import RawFiles

ALL = "all"
INGEST = "ingest"


def parse(arguments: Sequence[str] | None = None) -> argparse.Namespace:
    """Read the command line; an unknown task is an error."""
    parser = argparse.ArgumentParser(description="Build the retail sales mart")
    parser.add_argument("--task", required=True, choices=[*TABLES, ALL, INGEST])
    parser.add_argument("--raw", required=True, help="folder of the raw tables")
    parser.add_argument("--csv", help="for ingest: folder of the CSV files, if not the raw folder")
    parser.add_argument("--register", metavar="DATABASE", help="for ingest: also create external tables here")
    where = parser.add_mutually_exclusive_group()
    where.add_argument("--mart", help="folder of the mart tables")
    where.add_argument("--database", help="catalog database of the mart tables")
    where.add_argument("--dataset", help="dataset of a warehouse connector; needs --format")
    parser.add_argument("--versioned", type=int, metavar="KEEP", help="with --mart: publish tables by commit records and keep this many versions")
    parser.add_argument("--format", default="parquet", help="format of the mart tables, or name of the connector")
    parser.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="connector option")
    parser.add_argument("--day-option", action="append", default=[], metavar="KEY=VALUE", help="connector option of tables by day")
    parser.add_argument("--name-option", default="table", help="connector option that takes the table's name")
    parser.add_argument("--lenient", action="store_true", help="for ingest: count misfits instead of failing")
    parser.add_argument("--multiline", action="store_true", help="for ingest: quoted values may hold line breaks")
    parser.add_argument("--concurrent-tables", type=int, default=4, help="tables built or converted at the same time")
    parser.add_argument("--grain", choices=GRAINS, default="second", help="time grain of the KPI tables")
    parser.add_argument("--top", type=int, help="keep only this many products in kpi_top_products")
    parser.add_argument("--ranks", action="store_true", help="store the order of kpi_top_products as a column rank")
    options = parser.parse_args(arguments)
    if options.task != INGEST and not (options.mart or options.database or options.dataset):
        parser.error("--mart, --database or --dataset is required to build a table")
    for setting in [*options.option, *options.day_option]:
        if "=" not in setting:
            parser.error(f"not KEY=VALUE: {setting}")
    return options


def needs_catalog(spark: SparkSession, options: argparse.Namespace) -> None:
    """Refuse, before any work, to fill a catalog that ends with this session."""
    asked = options.register if options.task == INGEST else options.database
    if asked and spark.conf.get("spark.sql.catalogImplementation", "in-memory") == "in-memory":
        raise SystemExit(
            f"the session's catalog is in memory, so {asked} would be gone with it;"
            " submit with --conf spark.sql.catalogImplementation=hive and a metastore"
        )


def store_of(options: argparse.Namespace) -> MartStore:
    """Where the command line wants the tables."""
    if options.mart and options.versioned:
        return MartStore.versioned(options.mart, options.format, options.versioned)
    if options.mart:
        return MartStore.files(options.mart, options.format)
    if options.database:
        return MartStore.database(options.database, options.format)
    pairs = [dict(s.split("=", 1) for s in given) for given in (options.option, options.day_option)]
    return MartStore.connector(options.format, options.dataset, pairs[0], options.name_option, pairs[1])


def run(spark: SparkSession, options: argparse.Namespace) -> None:
    """Do what the command line asks for."""
    if options.task == INGEST:
        how = CsvOptions(
            strict=not options.lenient, multiline=options.multiline, concurrent_tables=options.concurrent_tables
        )
        for table, counts in csv_to_parquet(spark, options.csv or options.raw, options.raw, how).items():
            print(f"{table}: " + ", ".join(f"{n} {what}" for what, n in counts.items()))
        if options.register:
            register_external(spark, options.raw, options.register)
        return
    store = store_of(options)
    if options.database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {options.database}")
    raw = RawFiles(spark, options.raw)
    if options.task == ALL:
        build_mart(spark, raw, store, options.grain, options.top, options.concurrent_tables, options.ranks)
    else:
        build_table(spark, options.task, raw, store, options.grain, options.top, options.ranks)


def main(arguments: Sequence[str] | None = None) -> None:
    """Entry point."""
    options = parse(arguments)
    spark = SparkSession.builder.appName(f"salesmart {options.task}").getOrCreate()
    try:
        needs_catalog(spark, options)
        run(spark, options)
    finally:
        spark.stop()
