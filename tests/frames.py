"""Small hand-written raw tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from salesmart.sources.schemas import raw_schema

UTC = dt.timezone.utc


def nanos(text: str) -> int:
    """Epoch nanoseconds of UTC text."""
    moment = dt.datetime.fromisoformat(text).replace(tzinfo=UTC)
    delta = moment - dt.datetime(1970, 1, 1, tzinfo=UTC)
    return (delta.days * 86_400 + delta.seconds) * 1_000_000_000 + delta.microseconds * 1000


def table(spark: SparkSession, name: str, rows: list[dict]) -> DataFrame:
    """A raw table; columns left out are null."""
    schema = raw_schema(name)
    return spark.createDataFrame([tuple(row.get(column) for column in schema.names) for row in rows], schema)


def sales(spark: SparkSession, *rows: dict) -> DataFrame:
    return table(spark, "sales", list(rows))


def products(spark: SparkSession, *ids: int | None) -> DataFrame:
    return table(spark, "products", [{"ProductID": i, "Price": 1.0} for i in ids])


def customers(spark: SparkSession, *ids: int | None) -> DataFrame:
    return table(spark, "customers", [{"CustomerID": i} for i in ids])


def employees(spark: SparkSession, *ids: int | None) -> DataFrame:
    return table(spark, "employees", [{"EmployeeID": i} for i in ids])


def facts(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Facts of (CustomerID, time text or None, TotalPrice)."""
    schema = "CustomerID bigint, at string, TotalPrice double"
    return spark.createDataFrame(rows, schema).selectExpr(
        "CustomerID", "CAST(at AS timestamp) AS SalesTimestamp", "TotalPrice"
    )


def values(df: DataFrame) -> list[tuple]:
    """All rows as tuples, sorted with nulls last."""
    return sorted((tuple(row) for row in df.collect()), key=lambda row: [(v is None, str(v)) for v in row])
