"""Distinct customers from bitmaps, against counting them."""

import datetime as dt
import random

from pyspark.sql import functions as F

from salesmart.operators.aggregates import customers_by_type
from salesmart.operators.bitmaps import BITMAP_KEYS, customer_bitmaps, customers_in
from tests.frames import facts, values
from tests.test_plans import plan


def made(spark):
    draw = random.Random(9)
    start = dt.datetime(2018, 1, 30)
    rows = []
    for _ in range(900):
        customer = draw.choice([None, -5, 0, 1, 2, 32_768, 32_769, 2**40 + 7, *range(100, 160)])
        at = None if draw.random() < 0.1 else str(start + dt.timedelta(hours=draw.randint(0, 24 * 70), minutes=draw.choice([0, 0, 30])))
        rows.append((customer, at, 1.0))
    return rows, facts(spark, rows)


def test_days_and_months_from_the_same_bitmaps(spark, tmp_path):
    rows, df = made(spark)
    path = str(tmp_path / "bitmaps")
    customer_bitmaps(df.repartition(4)).write.parquet(path)
    stored = spark.read.parquet(path)
    assert stored.columns == [*BITMAP_KEYS, "Customers"]
    by_day = customers_in(stored, "SalesTimestamp", "CustomerType")
    assert values(by_day.select("SalesTimestamp", "CustomerType", "CustomerCount")) == values(customers_by_type(df, "day"))
    first = {}
    for customer, at, _ in rows:
        if customer is not None and at:
            first[customer] = min(first.get(customer, at), at)
    months = {}
    for customer, at, _ in rows:
        if customer is not None:
            kind = "Repeat" if at and at > first[customer] else "New"
            months.setdefault((at and at[:7], kind), set()).add(customer)
    month = F.date_format("SalesTimestamp", "yyyy-MM").alias("month")
    found = {(r["month"], r["CustomerType"]): r["CustomerCount"] for r in customers_in(stored, month, "CustomerType").collect()}
    assert found == {key: len(customers) for key, customers in months.items()}
    assert customers_in(stored).first()["CustomerCount"] == len({c for c, _, _ in rows if c is not None})


def test_counts_read_only_the_bitmaps_and_merge_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "bitmaps")
    customer_bitmaps(made(spark)[1]).write.parquet(path)
    text = plan(customers_in(spark.read.parquet(path), "SalesTimestamp"))
    assert text.count("FileScan") == 1 and "partial_bitmap_or_agg" in text and "CustomerType" not in text.split("FileScan")[1].split("]")[0]


def test_no_facts(spark):
    assert customers_in(customer_bitmaps(facts(spark, [(1, None, 1.0)]).limit(0)), "CustomerType").count() == 0
