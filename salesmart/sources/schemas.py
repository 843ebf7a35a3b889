"""Declared schemas of the seven raw tables.

Dates are 64-bit epoch nanoseconds at this layer; ``salesmart.functions.times``
turns them into timestamps. Every field is nullable.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# Table and column names, and their types.
RAW_DDL = {
    "sales": (
        "SalesID bigint, SalesPersonID bigint, CustomerID bigint, ProductID bigint, Quantity bigint, "
        "Discount double, TotalPrice double, SalesDate bigint, TransactionNumber string"
    ),
    "products": (
        "ProductID bigint, ProductName string, Price double, CategoryID bigint, Class string, "
        "ModifyDate bigint, Resistant string, IsAllergic string, VitalityDays double"
    ),
    "employees": (
        "EmployeeID bigint, FirstName string, MiddleInitial string, LastName string, Gender string, CityID bigint"
    ),
    "customers": (
        "CustomerID bigint, FirstName string, MiddleInitial string, LastName string, CityID bigint, Address string"
    ),
    "categories": "CategoryID bigint, CategoryName string",
    "cities": "CityID bigint, CityName string, Zipcode bigint, CountryID bigint",
    "countries": "CountryID bigint, CountryName string, CountryCode string",
}

# The bigint columns that hold epoch nanoseconds.
NANO_COLUMNS = {"sales": {"SalesDate"}, "products": {"ModifyDate"}}

RAW_TABLES = tuple(RAW_DDL)


def raw_schema(table: str) -> StructType:
    """The declared schema of one raw table."""
    if table not in RAW_DDL:
        raise ValueError(f"unknown raw table {table!r}; known: {', '.join(RAW_TABLES)}")
    return StructType.fromDDL(RAW_DDL[table])
