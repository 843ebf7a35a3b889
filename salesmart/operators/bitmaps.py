"""Distinct customers from stored bitmaps that merge over time.

Counts of distinct customers per day do not add up to those per month. Bitmaps do: a customer is one bit, in the bitmap of its block of
32,768 customer numbers, and a period's bitmap is the union of those of its days. Stored once per day, type and block, they
give exact counts for any period without reading the fact again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.times import at_grain
from salesmart.operators.aggregates import first_purchases
from salesmart.operators.joins import with_first_purchase

#: The keys of a stored row, beside its bitmap.
BITMAP_KEYS = ["SalesTimestamp", "CustomerType", "CustomerBlock"]


def customer_bitmaps(facts: DataFrame, grain: str = "day") -> DataFrame:
    """One row per time bucket, customer type and block of customers: SalesTimestamp, CustomerType, CustomerBlock, Customers.

    The type is decided on the exact time of a sale, so a customer can be in both bitmaps of its first day. Sales without a
    customer drop out; undated ones are "New" ones of the null bucket. The fact is reduced to its first and last sale per customer
    and bucket before customers are labelled, and bits are set in the map tasks before the shuffle.
    """
    sold_at = F.col("SalesTimestamp")
    visits = (
        facts.where(F.col("CustomerID").isNotNull())
        .groupBy("CustomerID", at_grain(sold_at, grain).alias("bucket"))
        .agg(F.min(sold_at).alias("first_at"), F.max(sold_at).alias("last_at"))
    )
    # A bucket's sales are of at most two times that matter here; a time that is both counts once.
    times = visits.select("CustomerID", "bucket", F.explode(F.array_distinct(F.array("first_at", "last_at"))).alias("SalesTimestamp"))
    labelled = with_first_purchase(times, first_purchases(times))
    return (
        labelled.groupBy(
            F.col("bucket").alias("SalesTimestamp"), "CustomerType", F.bitmap_bucket_number("CustomerID").alias("CustomerBlock")
        ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("CustomerID")).alias("Customers"))
    )


def customers_in(bitmaps: DataFrame, *keys: str | Column) -> DataFrame:
    """Distinct customers per combination of ``keys`` (columns of the bitmaps, or of their time), as CustomerCount.

    Bitmaps of a block are united in the map tasks; a union is at most 4 KB, whatever it stands for.
    """
    united = bitmaps.groupBy(*keys, "CustomerBlock").agg(F.bitmap_or_agg("Customers").alias("Customers"))
    names = united.columns[:-2]
    return united.groupBy(*names).agg(F.sum(F.bitmap_count("Customers")).alias("CustomerCount"))
