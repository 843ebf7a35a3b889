"""Dimension tables. Each is a raw table without its exact duplicate rows.

Deduplication merges equal rows in the map tasks first, so a row that was sent
many times reaches the shuffle once per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from salesmart.functions.times import calendar_parts
from salesmart.sources.raw import with_product_times, with_sales_times
from salesmart.sources.schemas import raw_schema


def _distinct_rows(raw: DataFrame, table: str) -> DataFrame:
    return raw.select(*raw_schema(table).names).dropDuplicates()


def dim_products(products: DataFrame) -> DataFrame:
    """Distinct products with their time columns.

    The time columns follow from ``ModifyDate``, so they are added after the
    deduplication instead of travelling through its shuffle.
    """
    columns = [
        "ProductID", "ProductName", "Price", "CategoryID", "Class", "ModifyDate",
        "Resistant", "IsAllergic", "VitalityDays", "ModifyDateSeconds", "ModifyTimestamp",
    ]
    return with_product_times(_distinct_rows(products, "products")).select(*columns)


def dim_customers(customers: DataFrame) -> DataFrame:
    """Distinct customers."""
    return _distinct_rows(customers, "customers")


def dim_employees(employees: DataFrame) -> DataFrame:
    """Distinct employees."""
    return _distinct_rows(employees, "employees")


def dim_categories(categories: DataFrame) -> DataFrame:
    """Distinct categories."""
    return _distinct_rows(categories, "categories")


def dim_dates(sales: DataFrame) -> DataFrame:
    """One row per distinct second with a sale, plus a null row if a sale has no date."""
    moments = with_sales_times(sales).select("SalesTimestamp").dropDuplicates()
    return moments.select("SalesTimestamp", *calendar_parts("SalesTimestamp"))


def dim_locations(cities: DataFrame, countries: DataFrame) -> DataFrame:
    """Distinct cities with their country, null where the country is unknown.

    Both sides are deduplicated before the join. As every column of both is kept,
    the joined rows are then distinct already, and copies of one country on both
    sides never multiply.
    """
    joined = _distinct_rows(cities, "cities").join(_distinct_rows(countries, "countries"), "CountryID", "left")
    return joined.select("CityID", "CityName", "Zipcode", "CountryID", "CountryName", "CountryCode")
