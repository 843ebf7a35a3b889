"""The sales fact table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from salesmart.operators.joins import left_match, left_match_as, left_match_copies, repeated_keys
from salesmart.operators.skew import is_broadcast, left_match_skewed
from salesmart.sinks.staging import Stage, stage
from salesmart.sources.raw import with_sales_times

# The columns of the fact table.
FACT_COLUMNS = [
    "SalesID", "SalesPersonID", "CustomerID", "ProductID", "Quantity",
    "Discount", "TotalPrice", "SalesTimestamp", "TransactionNumber", "EmployeeID",
]


def fact_sales(sales: DataFrame, products: DataFrame, customers: DataFrame, employees: DataFrame) -> DataFrame:
    """Sales matched to their product, customer and employee.

    Every sale is kept. The dimensions are the raw tables, so a key that occurs n
    times there gives n fact rows.
    """
    matched = left_match(with_sales_times(sales), products, "ProductID")
    matched = left_match(matched, customers, "CustomerID")
    matched = left_match_as(matched, employees, "SalesPersonID", "EmployeeID")
    return matched.select(*FACT_COLUMNS)


def build_fact_sales(raw: Mapping[str, DataFrame], stage: Stage = stage) -> DataFrame:
    """``fact_sales`` of the raw tables, with two small tables written first.

    Products and customers add no column to the fact; only the number of rows per key matters. So each is
    reduced to the keys that repeat, normally none, with their counts, and written to the shared folder. Where no key repeats the
    sales stay as they are. Else the planner sees how small the table is and broadcasts it or not by its own threshold; the sales are not shuffled for it.
    Employees are joined whole: broadcast where the planner's estimate is under its threshold, else with null and
    heavy sales persons kept out of the shuffle.
    """
    sales = with_sales_times(raw["sales"])
    for table, key in (("products", "ProductID"), ("customers", "CustomerID")):
        repeated = stage(repeated_keys(raw[table], key), f"{table}-keys")
        if not repeated.isEmpty():
            sales = left_match_copies(sales, repeated, key)
    employees = raw["employees"].select("EmployeeID")
    if is_broadcast(employees):
        matched = left_match_as(sales, employees, "SalesPersonID", "EmployeeID")
    else:
        matched = left_match_skewed(sales, employees, "SalesPersonID", "EmployeeID", keep_key=True)
    return matched.select(*FACT_COLUMNS)
