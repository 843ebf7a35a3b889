"""KPI tables, from the stored fact table and product dimension.

``grain`` is "second" (the resolution of ``SalesTimestamp``) or "day". Sums of doubles depend on the order of the rows in
their last bits; with ``exact`` they do not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.times import at_grain
from salesmart.operators.aggregates import average_by, average_of_sums, customers_by_type, sum_by
from salesmart.operators.exact import exact_sum_by
from salesmart.operators.lattice import Keep, Lattice
from salesmart.operators.ordering import ranked

_EMPLOYEE_TIME = ("EmployeeID", "SalesTimestamp")


def _sold_at(grain: str):
    return at_grain(F.col("SalesTimestamp"), grain).alias("SalesTimestamp")


def _summed(exact: bool):
    return exact_sum_by if exact else sum_by


def total_sales_by_date(fact: DataFrame, grain: str = "second", exact: bool = False) -> DataFrame:
    """Revenue over time."""
    return _summed(exact)(fact, [_sold_at(grain)], "TotalPrice", "TotalSales")


def top_products(fact: DataFrame, k: int | None = None, exact: bool = False) -> DataFrame:
    """Revenue per product, largest first; all products unless ``k`` is given."""
    return ranked(_summed(exact)(fact, ["ProductID"], "TotalPrice", "Revenue"), "Revenue", "ProductID", k)


def avg_order_value(fact: DataFrame) -> DataFrame:
    """Average order total."""
    return average_of_sums(fact, "SalesID", "TotalPrice", "avg_order_value")


def customer_type_counts(fact: DataFrame, grain: str = "second") -> DataFrame:
    """New and repeat customers over time.

    The type is decided on the exact time at either grain, so at day grain a
    customer can count under both types on the first day.
    """
    return customers_by_type(fact, grain)


def price_trends(products: DataFrame) -> DataFrame:
    """Average product price per category and month number, years taken together."""
    return average_by(products, ["CategoryID", F.month("ModifyTimestamp").alias("month")], "Price", "avg_price")


def sales_by_employee(fact: DataFrame, exact: bool = False) -> DataFrame:
    """Revenue per employee; sales without one form the null group."""
    return _summed(exact)(fact, ["EmployeeID"], "TotalPrice", "employee_sales")


def employee_daily_sales(fact: DataFrame, grain: str = "second", exact: bool = False) -> DataFrame:
    """Revenue per employee over time."""
    return _summed(exact)(fact, ["EmployeeID", _sold_at(grain)], "TotalPrice", "daily_revenue")


def sales_lattice(fact: DataFrame, keep: Keep, grain: str = "second") -> Lattice:
    """Stored revenue by employee, product and time, from one scan of the fact.

    By day, one base aggregate of all three is stored, and employee and time from it. By second hardly two sales share all three, so that such a
    base would be as long as the fact; employee and time, and product, then come straight from the one scan.
    """
    rows = fact.select("EmployeeID", "ProductID", _sold_at(grain), "TotalPrice")
    first = [("EmployeeID", "ProductID", "SalesTimestamp")] if grain == "day" else [_EMPLOYEE_TIME, ("ProductID",)]
    return Lattice.build(rows, "TotalPrice", first, [_EMPLOYEE_TIME], keep)


#: KPI tables that the lattice gives.
FROM_LATTICE = {
    "kpi_total_sales_by_date": lambda lattice, k: lattice.sums(["SalesTimestamp"], "TotalSales"),
    "kpi_top_products": lambda lattice, k: ranked(lattice.sums(["ProductID"], "Revenue"), "Revenue", "ProductID", k),
    "kpi_sales_by_employee": lambda lattice, k: lattice.sums(["EmployeeID"], "employee_sales"),
    "kpi_employee_daily_sales": lambda lattice, k: lattice.sums(_EMPLOYEE_TIME, "daily_revenue"),
}
