"""Aggregations.

Sums, averages, minima and counts combine inside each map task before the
shuffle, so a hot or null key costs one row per task, not one row per sale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.labels import NEW, REPEAT
from salesmart.functions.times import at_grain


def sum_by(df: DataFrame, keys: list[str | Column], value: str, name: str) -> DataFrame:
    """Sum per key combination. Null keys form a group; nulls are skipped in the sum."""
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def average_by(df: DataFrame, keys: list[str | Column], value: str, name: str) -> DataFrame:
    """Average per key combination, nulls skipped."""
    return df.groupBy(*keys).agg(F.avg(value).alias(name))


def average_of_sums(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Sum per key, then the average of those sums. No input gives one null row."""
    return sum_by(df, [key], value, "total").agg(F.avg("total").alias(name))


def first_purchases(facts: DataFrame) -> DataFrame:
    """Earliest sale time per customer."""
    return facts.groupBy("CustomerID").agg(F.min("SalesTimestamp").alias("FirstPurchaseDate"))


def customers_by_type(facts: DataFrame, grain: str = "second") -> DataFrame:
    """Distinct customers per time bucket and type ("New" or "Repeat").

    The plain recipe joins every sale to its customer's first purchase and counts
    distinct customers per (bucket, type): the sales are shuffled by customer,
    where one customer may hold a third of them, and again for the count. The
    counts below come without that join, from two facts about a customer:

    * a dated bucket other than the first one holds only "Repeat" sales;
    * the first bucket holds a "New" sale, and a "Repeat" one only if the
      customer's last sale in it is later than the first.

    So each dated (customer, bucket) visit is counted as "Repeat", and every
    customer then adds one "New" to the first bucket and takes its "Repeat" back
    unless it was earned. Undated visits compare as null and are "New".

    Visits are shuffled on customer and bucket together, after sales of one visit
    were merged in the map tasks, so no key gathers a customer's whole history.
    At day grain both branches read that same shuffle. At second grain Spark sees
    that a minimum needs no distinct input and takes it from the sales directly.
    """
    visits = _visits(facts, grain)

    # Buckets are ordered and do not overlap, so the smallest "last_at" is the one of the first bucket.
    firsts = (
        visits.groupBy("CustomerID")
        .agg(F.min("first_at").alias("first_at"), F.min("last_at").alias("last_at"))
        .where(F.col("first_at").isNotNull())
    )
    # Reading both columns here keeps the two aggregations alike, so that their shuffle is shared.
    of_visits = visits.select(
        "bucket",
        F.col("first_at").isNull().cast("int").alias(NEW),
        F.col("last_at").isNotNull().cast("int").alias(REPEAT),
    )
    of_firsts = firsts.select(
        at_grain(F.col("first_at"), grain).alias("bucket"),
        F.lit(1).alias(NEW),
        F.when(F.col("last_at") > F.col("first_at"), 0).otherwise(-1).alias(REPEAT),
    )
    return (
        of_visits.unionAll(of_firsts)
        .groupBy(F.col("bucket").alias("SalesTimestamp"))
        .agg(F.sum(NEW).alias(NEW), F.sum(REPEAT).alias(REPEAT))
        .unpivot("SalesTimestamp", [NEW, REPEAT], "CustomerType", "CustomerCount")
        .where(F.col("CustomerCount") > 0)
    )


def _visits(facts: DataFrame, grain: str) -> DataFrame:
    """One row per customer and bucket with the first and last sale time in it."""
    known = facts.where(F.col("CustomerID").isNotNull())
    sold_at = F.col("SalesTimestamp")
    if grain == "second":
        pairs = known.select("CustomerID", sold_at.alias("bucket")).distinct()
        return pairs.select("*", F.col("bucket").alias("first_at"), F.col("bucket").alias("last_at"))
    return known.groupBy("CustomerID", at_grain(sold_at, grain).alias("bucket")).agg(
        F.min(sold_at).alias("first_at"), F.max(sold_at).alias("last_at")
    )
