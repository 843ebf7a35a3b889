"""Typed scans of raw Parquet tables, and the time columns derived on read."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from salesmart.functions.times import epoch_seconds, epoch_timestamp
from salesmart.sinks.files import has_data
from salesmart.sources.schemas import RAW_TABLES, raw_schema


def read_raw(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Scan one raw Parquet table with its declared schema.

    Columns match by name in any case, a declared column missing from the file
    reads as null, and undeclared columns are never read. A folder without a data file is an
    error: it is what a failed job leaves, not an empty table.
    """
    if not has_data(spark, path):
        raise FileNotFoundError(f"{path} holds no data file")
    return spark.read.schema(raw_schema(table)).parquet(path)


class RawFiles(Mapping[str, DataFrame]):
    """The raw tables under one folder (``<root>/<table>.parquet``), read on demand.

    A task that needs two tables touches only those two.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark = spark
        self._root = root.rstrip("/")

    def __getitem__(self, table: str) -> DataFrame:
        if table not in RAW_TABLES:
            raise KeyError(table)
        return read_raw(self._spark, table, f"{self._root}/{table}.parquet")

    def __iter__(self) -> Iterator[str]:
        return iter(RAW_TABLES)

    def __len__(self) -> int:
        return len(RAW_TABLES)


def with_sales_times(sales: DataFrame) -> DataFrame:
    """Raw sales plus ``SalesDateSeconds`` and ``SalesTimestamp``."""
    return sales.select(
        "*",
        epoch_seconds("SalesDate").alias("SalesDateSeconds"),
        epoch_timestamp("SalesDate").alias("SalesTimestamp"),
    )


def with_product_times(products: DataFrame) -> DataFrame:
    """Raw products plus ``ModifyDateSeconds`` and ``ModifyTimestamp``."""
    return products.select(
        "*",
        epoch_seconds("ModifyDate").alias("ModifyDateSeconds"),
        epoch_timestamp("ModifyDate").alias("ModifyTimestamp"),
    )
