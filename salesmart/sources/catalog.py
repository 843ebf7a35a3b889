"""External catalog tables over the raw Parquet files."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from salesmart.sources.schemas import RAW_TABLES, raw_schema


def register_external(spark: SparkSession, root: str, database: str = "default") -> list[str]:
    """Create ``<table>_ext`` over ``<root>/<table>.parquet`` for all seven raw tables.

    The database is created if need be. Tables that exist are left as they are if they have this location
    and schema, and are an error otherwise. The schema is declared, as Spark does
    not infer nanosecond timestamps from Parquet. Returns the full table names.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for table in RAW_TABLES:
        name = f"{database}.{table}_ext"
        path = f"{root.rstrip('/')}/{table}.parquet"
        if spark.catalog.tableExists(name):
            _check_same(spark, name, path, raw_schema(table))
        else:
            spark.catalog.createTable(name, path=path, source="parquet", schema=raw_schema(table))
        names.append(name)
    return names


def _check_same(spark: SparkSession, name: str, path: str, schema: StructType) -> None:
    """Raise if the table ``name`` is another one than it would be created as."""
    described = spark.sql(f"DESCRIBE FORMATTED {name}").collect()
    location = next(row["data_type"] for row in described if row["col_name"] == "Location")
    if _plain(location) != _plain(path):
        raise ValueError(f"{name} exists with location {location}, not {path}")
    found = [(field.name, field.dataType) for field in spark.table(name).schema]
    if found != [(field.name, field.dataType) for field in schema]:
        raise ValueError(f"{name} exists with other columns: {found}")


def _plain(location: str) -> str:
    """A location without the spelling differences of local paths."""
    return re.sub(r"^file:/+", "/", location).rstrip("/")
