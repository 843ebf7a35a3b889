"""Joins.

No join here adds a broadcast hint. Without one from the caller, Spark broadcasts
a side only when its size estimate is under
``spark.sql.autoBroadcastJoinThreshold``; past that it plans a sort-merge join,
and adaptive execution splits partitions that a hot (or null) key has made too
large. The splitting needs both sides to be plain shuffles, so no side may arrive
already hashed on the key by an aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.labels import customer_type

# A row is copied in two steps, so that no step makes an array longer than this.
_COPIES_AT_ONCE = 10_000


def left_match(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Left join that keeps no dimension column: only its row count matters.

    A fact row comes out once per dimension row with its key, and once when there
    is none. Just the key is read from the dimension.
    """
    return facts.join(dimension.select(key), key, "left")


def left_match_as(facts: DataFrame, dimension: DataFrame, fact_key: str, key: str) -> DataFrame:
    """Left join on differently named keys; the dimension's key is kept, null when unmatched."""
    keys = dimension.select(key)
    return facts.join(keys, facts[fact_key] == keys[key], "left")


def repeated_keys(dimension: DataFrame, key: str) -> DataFrame:
    """The keys that occur more than once, with ``copies``: how often.

    For ``left_match_copies`` this stands in for the whole dimension: a key held once or
    never leaves a fact row alone either way. It is normally empty, so a
    dimension of billions of rows need not be shuffled against the facts.
    Counts are combined before the shuffle, so a key holding a third of the rows is one counter per task.
    """
    return (
        dimension.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


def left_match_copies(facts: DataFrame, repeated: DataFrame, key: str) -> DataFrame:
    """``left_match`` with the ``repeated_keys`` of a dimension: each fact row as often as its key occurs."""
    at_once = F.lit(_COPIES_AT_ONCE).cast("bigint")
    blocks = F.sequence(F.lit(0).cast("bigint"), F.call_function("div", F.coalesce("copies", F.lit(1)) - 1, at_once))
    in_block = F.least(at_once, F.coalesce("copies", F.lit(1)) - F.col("copy_block") * at_once)
    return (
        facts.join(repeated, key, "left")
        .withColumn("copy_block", F.explode(blocks))
        .withColumn("copy_number", F.explode(F.sequence(F.lit(1).cast("bigint"), in_block)))
        .select(*facts.columns)
    )


def with_first_purchase(facts: DataFrame, first_purchases: DataFrame) -> DataFrame:
    """Each sale with its customer's first purchase time and type.

    Sales without a customer drop out. ``first_purchases`` has one row per
    customer and usually comes straight from an aggregation; rebalancing it
    gives the join a plain shuffle on that side too, which lets adaptive
    execution split a customer who holds a large share of the sales.
    """
    return facts.join(first_purchases.hint("rebalance"), "CustomerID").withColumn(
        "CustomerType", customer_type(F.col("SalesTimestamp"), F.col("FirstPurchaseDate"))
    )
