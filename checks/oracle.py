"""For each registered query, SQL with the same result on the same test tables."""

from __future__ import annotations

# Raw tables, as the testbed maps them; sales carry their timestamp at second resolution.
SALES = """
  SELECT l_orderkey AS "SalesID",
         CASE WHEN l_returnflag <> 'R' THEN l_suppkey + 1 END AS "SalesPersonID",
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_custkey END AS "CustomerID",
         l_partkey AS "ProductID",
         CAST(l_quantity AS BIGINT) AS "Quantity",
         l_discount AS "Discount",
         l_extendedprice AS "TotalPrice",
         epoch_us(o_orderdate) * 1000 AS "SalesDate",
         CAST(l_orderkey AS VARCHAR) AS "TransactionNumber",
         epoch_us(o_orderdate) * 1000 / CAST(1000000000 AS DOUBLE) AS "SalesDateSeconds",
         CAST(date_trunc('second', o_orderdate) AS TIMESTAMP) AS "SalesTimestamp"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

SKEWED_SALES = f"""
  SELECT * REPLACE (CASE WHEN "SalesPersonID" IS NOT NULL AND "SalesID" % 3 = 1 THEN 2 ELSE "SalesPersonID" END AS "SalesPersonID")
  FROM ({SALES})"""

EVENT_SALES = """
  SELECT event_id AS "SalesID",
         user_id AS "SalesPersonID",
         user_id AS "CustomerID",
         event_id AS "ProductID",
         CAST(1 AS BIGINT) AS "Quantity",
         CAST(NULL AS DOUBLE) AS "Discount",
         value AS "TotalPrice",
         epoch_us(ts) * 1000 AS "SalesDate",
         CAST(NULL AS VARCHAR) AS "TransactionNumber",
         epoch_us(ts) * 1000 / CAST(1000000000 AS DOUBLE) AS "SalesDateSeconds",
         CAST(date_trunc('second', ts) AS TIMESTAMP) AS "SalesTimestamp"
  FROM events"""

UNDATED_SALES = f"""
  SELECT * REPLACE (
    CASE WHEN "SalesID" % 10 <> 3 THEN "SalesDate" END AS "SalesDate",
    CASE WHEN "SalesID" % 10 <> 3 THEN "SalesDateSeconds" END AS "SalesDateSeconds",
    CASE WHEN "SalesID" % 10 <> 3 THEN "SalesTimestamp" END AS "SalesTimestamp")
  FROM ({EVENT_SALES})"""

PRODUCTS = """
  SELECT p_partkey AS "ProductID",
         p_name AS "ProductName",
         p_retailprice AS "Price",
         CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS BIGINT) AS "CategoryID",
         p_type AS "Class",
         (788918400 + p_partkey % 730 * 86400) * 1000000000 AS "ModifyDate",
         'Unknown' AS "Resistant",
         'FALSE' AS "IsAllergic",
         CAST(p_size AS DOUBLE) AS "VitalityDays",
         CAST(788918400 + p_partkey % 730 * 86400 AS DOUBLE) AS "ModifyDateSeconds",
         TIMESTAMP '1995-01-01 00:00:00' + INTERVAL 1 DAY * CAST(p_partkey % 730 AS INTEGER) AS "ModifyTimestamp"
  FROM part"""

PRODUCTS_RESENT = f"""
  SELECT * FROM ({PRODUCTS}) UNION ALL SELECT * FROM ({PRODUCTS}) WHERE "Class" = 'ECONOMY'"""

EMPLOYEES = """
  SELECT s_suppkey AS "EmployeeID", s_name AS "FirstName", 'M' AS "MiddleInitial", 'Staff' AS "LastName",
         'X' AS "Gender", CAST(s_nationkey AS BIGINT) AS "CityID"
  FROM supplier"""

CUSTOMERS = """
  SELECT c_custkey AS "CustomerID", c_name AS "FirstName", 'M' AS "MiddleInitial", c_mktsegment AS "LastName",
         CAST(c_nationkey AS BIGINT) AS "CityID", '1 Main St' AS "Address"
  FROM customer"""

CATEGORIES = """
  SELECT CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS BIGINT) AS "CategoryID", p_brand AS "CategoryName"
  FROM part"""

CITIES = """
  SELECT CAST(n_nationkey AS BIGINT) AS "CityID", n_name AS "CityName",
         CAST(10000 + n_nationkey AS BIGINT) AS "Zipcode", CAST(n_regionkey AS BIGINT) AS "CountryID"
  FROM nation"""

COUNTRIES = """
  SELECT CAST(r_regionkey + 1 AS BIGINT) AS "CountryID", r_name AS "CountryName",
         substring(r_name, 1, 2) AS "CountryCode"
  FROM region"""

DATES = """
  SELECT "SalesTimestamp",
         CAST(year("SalesTimestamp") AS INTEGER) AS "year",
         CAST(month("SalesTimestamp") AS INTEGER) AS "month",
         CAST(weekofyear("SalesTimestamp") AS INTEGER) AS "week",
         CAST(dayofmonth("SalesTimestamp") AS INTEGER) AS "day_of_month",
         CAST(dayofweek("SalesTimestamp") + 1 AS INTEGER) AS "day_of_week",
         CAST(quarter("SalesTimestamp") AS INTEGER) AS "quarter"
  FROM (SELECT DISTINCT "SalesTimestamp" FROM ({sales}))"""

LOCATIONS = f"""
  SELECT DISTINCT "CityID", "CityName", "Zipcode", c."CountryID", "CountryName", "CountryCode"
  FROM ({CITIES}) c LEFT JOIN ({COUNTRIES}) n ON c."CountryID" = n."CountryID" """

FACT = """
  SELECT s."SalesID", s."SalesPersonID", s."CustomerID", s."ProductID", s."Quantity", s."Discount",
         s."TotalPrice", s."SalesTimestamp", s."TransactionNumber", e."EmployeeID"
  FROM ({sales}) s
  LEFT JOIN ({products}) p ON s."ProductID" = p."ProductID"
  LEFT JOIN ({customers}) c ON s."CustomerID" = c."CustomerID"
  LEFT JOIN ({employees}) e ON s."SalesPersonID" = e."EmployeeID" """


def fact(sales: str = SALES, products: str = PRODUCTS) -> str:
    return FACT.format(sales=sales, products=products, customers=CUSTOMERS, employees=EMPLOYEES)


def sold_at(grain: str) -> str:
    if grain == "day":
        return """CAST(date_trunc('day', "SalesTimestamp") AS TIMESTAMP)"""
    return '"SalesTimestamp"'


def money(name: str) -> str:
    """An exact sum of amounts with two decimals."""
    return f'CAST(sum(CAST("TotalPrice" AS DECIMAL(18,2))) AS DOUBLE) AS "{name}"'


def exact_money(name: str) -> str:
    """The double nearest to the exact sum of doubles: whole multiples of 2^-70, which every amount here is."""
    whole = 'sum(CAST("TotalPrice" * 1180591620717411303424.0::DOUBLE AS HUGEINT))'
    return f'CAST(CAST({whole} AS VARCHAR) AS DOUBLE) / 1180591620717411303424.0::DOUBLE AS "{name}"'


def exact(keys: dict[str, str], name: str, sales: str = SALES) -> str:
    """An exact sum of the fact per combination of keys."""
    named = ", ".join(f'{sql} AS "{key}"' for key, sql in keys.items())
    numbers = ", ".join(str(i + 1) for i in range(len(keys)))
    return f"SELECT {named}, {exact_money(name)} FROM ({fact(sales)}) GROUP BY {numbers}"


def average(amount: str, name: str) -> str:
    """An average of amounts with two decimals, rounded half up to six places in whole numbers."""
    hundredths = f"CAST(sum(CAST({amount} AS DECIMAL(18,2)) * 100) AS HUGEINT)"
    count = f"CAST(count({amount}) AS HUGEINT)"
    return f'CAST((20000 * {hundredths} + {count}) // (2 * {count}) AS DOUBLE) / 1000000 AS "{name}"'


def total_sales(sales: str = SALES, grain: str = "second") -> str:
    return f"""
  SELECT {sold_at(grain)} AS "SalesTimestamp", {money("TotalSales")} FROM ({fact(sales)}) GROUP BY 1"""


def employee_sales(sales: str = SALES, grain: str = "second") -> str:
    return f"""
  SELECT "EmployeeID", {sold_at(grain)} AS "SalesTimestamp", {money("daily_revenue")}
  FROM ({fact(sales)}) GROUP BY 1, 2"""


def first_purchases(sales: str = SALES) -> str:
    return f"""
  SELECT "CustomerID", min("SalesTimestamp") AS "FirstPurchaseDate" FROM ({fact(sales)}) GROUP BY 1"""


def labelled(sales: str = SALES) -> str:
    return f"""
  SELECT f.*, p."FirstPurchaseDate",
         CASE WHEN f."SalesTimestamp" > p."FirstPurchaseDate" THEN 'Repeat' ELSE 'New' END AS "CustomerType"
  FROM ({fact(sales)}) f JOIN ({first_purchases(sales)}) p ON f."CustomerID" = p."CustomerID" """


def customer_types(sales: str = SALES, grain: str = "second") -> str:
    return f"""
  SELECT {sold_at(grain)} AS "SalesTimestamp", "CustomerType", count(DISTINCT "CustomerID") AS "CustomerCount"
  FROM ({labelled(sales)}) GROUP BY 1, 2"""


def matched(dimension: str, key: str) -> str:
    return f'SELECT s.* FROM ({SALES}) s LEFT JOIN ({dimension}) d ON s."{key}" = d."{key}"'


def top_products(sales: str = SALES) -> str:
    return f"""
  SELECT "ProductID", {money("Revenue")} FROM ({fact(sales)}) GROUP BY 1"""


def avg_order_value(sales: str = SALES) -> str:
    return f"""
  SELECT {average("order_total", "avg_order_value")}
  FROM (SELECT "SalesID", {money("order_total")} FROM ({fact(sales)}) GROUP BY 1)"""


def sales_by_employee(sales: str = SALES) -> str:
    return f"""
  SELECT "EmployeeID", {money("employee_sales")} FROM ({fact(sales)}) GROUP BY 1"""


PRICE_TRENDS = f"""
  SELECT "CategoryID", CAST(month("ModifyTimestamp") AS INTEGER) AS "month", {average('"Price"', "avg_price")}
  FROM (SELECT DISTINCT * FROM ({PRODUCTS})) GROUP BY 1, 2"""


def dimensions(sales: str = SALES) -> dict[str, str]:
    return {
        "dim_products": f"SELECT DISTINCT * FROM ({PRODUCTS})",
        "dim_customers": f"SELECT DISTINCT * FROM ({CUSTOMERS})",
        "dim_employees": f"SELECT DISTINCT * FROM ({EMPLOYEES})",
        "dim_categories": f"SELECT DISTINCT * FROM ({CATEGORIES})",
        "dim_locations": LOCATIONS,
        "dim_dates": DATES.format(sales=sales),
    }


def kpis(sales: str = SALES) -> dict[str, str]:
    return {
        "kpi_total_sales_by_date": total_sales(sales),
        "kpi_top_products": top_products(sales),
        "kpi_avg_order_value": avg_order_value(sales),
        "kpi_customer_type_counts": customer_types(sales),
        "kpi_price_trends": PRICE_TRENDS,
        "kpi_sales_by_employee": sales_by_employee(sales),
        "kpi_employee_daily_sales": employee_sales(sales),
    }


RAW = {
    "categories": CATEGORIES,
    "cities": CITIES,
    "countries": COUNTRIES,
    "customers": CUSTOMERS,
    "employees": EMPLOYEES,
    "products": PRODUCTS,
    "sales": SALES,
}


def row_counts(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"table_name\", count(*) AS \"row_count\" FROM ({sql})" for name, sql in tables.items()
    )


ORACLE = {
    "scan_sales": SALES,
    "scan_products": PRODUCTS,
    "scan_employees": EMPLOYEES,
    "scan_customers": CUSTOMERS,
    "scan_categories": CATEGORIES,
    "scan_cities": CITIES,
    "scan_countries": COUNTRIES,
    "csv_ingest_sales": SALES,
    # Text columns have no null in CSV: an empty field is an empty string.
    "csv_ingest_events": f"""SELECT * REPLACE ('' AS "TransactionNumber") FROM ({EVENT_SALES})""",
    "csv_ingest_untidy": f"""
  SELECT * REPLACE (
    CASE WHEN "SalesID" % 5 <> 0 THEN "CustomerID" END AS "CustomerID",
    'said "' || "SalesID" || '", twice' AS "TransactionNumber",
    CASE WHEN "SalesID" % 50 <> 7 THEN "SalesDate" END AS "SalesDate",
    CASE WHEN "SalesID" % 50 <> 7 THEN "SalesDateSeconds" END AS "SalesDateSeconds",
    CASE WHEN "SalesID" % 50 <> 7 THEN "SalesTimestamp" END AS "SalesTimestamp")
  FROM ({EVENT_SALES})""",
    "csv_ingest_line_breaks": f"""
  SELECT * REPLACE (
    'order "' || "SalesID" || '",' || chr(10) || chr(10) || 'line ' || "ProductID" || chr(10) AS "TransactionNumber")
  FROM ({SALES})""",
    "external_tables": row_counts({f"{name}_ext": sql for name, sql in RAW.items()}),
    "external_sales": SALES,
    "external_products": PRODUCTS,
    "stored_kpi_total_sales_by_date": total_sales(UNDATED_SALES),
    "stored_kpi_customer_type_counts": customer_types(UNDATED_SALES),
    "stored_kpi_employee_daily_sales": employee_sales(UNDATED_SALES),
    "stored_dim_dates": DATES.format(sales=UNDATED_SALES),
    "stored_fact_sales_undated": fact(UNDATED_SALES),
    "stored_overwrite": f"""SELECT * FROM ({fact()}) WHERE "SalesTimestamp" >= TIMESTAMP '1997-01-01'""",
    "stored_kpi_top_products_versioned": exact({"ProductID": '"ProductID"'}, "Revenue", EVENT_SALES),
    "stored_kpi_top_products_rank": f"""
  SELECT *, row_number() OVER (ORDER BY "Revenue" DESC NULLS LAST, "ProductID" NULLS LAST) AS "rank"
  FROM ({exact({"ProductID": '"CustomerID"'}, "Revenue", EVENT_SALES)})""",
    "ranked_sales": f"""
  SELECT *, row_number() OVER (ORDER BY "TotalPrice" DESC NULLS LAST, "SalesID", "ProductID") AS "rank"
  FROM (SELECT "SalesID", "ProductID", "TotalPrice", CAST(sum("Quantity") AS BIGINT) AS "Quantity" FROM ({SALES}) GROUP BY 1, 2, 3)""",
    "dim_dates_undated": DATES.format(sales=UNDATED_SALES),
    "kpi_customer_type_counts_undated": customer_types(UNDATED_SALES),
    "kpi_customer_type_counts_undated_day": customer_types(UNDATED_SALES, "day"),
    "kpi_top_products_ranked": f"""
  SELECT *, CAST(row_number() OVER (ORDER BY "Revenue" DESC NULLS LAST, "ProductID" NULLS LAST) AS INTEGER) AS "place"
  FROM ({top_products()}) ORDER BY "Revenue" DESC NULLS LAST, "ProductID" NULLS LAST LIMIT 100""",
    "stored_fact_sales": fact(),
    "stored_price_trends": PRICE_TRENDS,
    "mart_table_counts": row_counts(
        {**dimensions(EVENT_SALES), "fact_sales": fact(EVENT_SALES), **kpis(EVENT_SALES)}
    ),
    "sales_left_products": matched(PRODUCTS, "ProductID"),
    "sales_left_products_resent": matched(PRODUCTS_RESENT, "ProductID"),
    "sales_left_repeated_products": matched(PRODUCTS_RESENT, "ProductID"),
    "sales_left_customers": matched(CUSTOMERS, "CustomerID"),
    "sales_left_employees": f"""
  SELECT s.*, e."EmployeeID" FROM ({SALES}) s LEFT JOIN ({EMPLOYEES}) e ON s."SalesPersonID" = e."EmployeeID" """,
    "sales_left_employees_skewed": f"""
  SELECT s.*, e."EmployeeID" FROM ({SKEWED_SALES}) s LEFT JOIN ({EMPLOYEES}) e ON s."SalesPersonID" = e."EmployeeID" """,
    "sales_left_employees_resent_skewed": f"""
  SELECT s.*, e."EmployeeID" FROM ({SKEWED_SALES}) s
  LEFT JOIN ({EMPLOYEES} UNION ALL {EMPLOYEES}) e ON s."SalesPersonID" = e."EmployeeID" """,
    "sales_left_customers_skewed": matched(CUSTOMERS, "CustomerID"),
    "sales_first_purchase": labelled(),
    "sales_first_purchase_events": f"""
  SELECT "SalesID", "CustomerID", "SalesTimestamp", "FirstPurchaseDate", "CustomerType"
  FROM ({labelled(EVENT_SALES)})""",
    "first_purchase_per_customer": first_purchases(),
    **dimensions(),
    "dim_products_resent": f"SELECT DISTINCT * FROM ({PRODUCTS_RESENT})",
    "dim_dates_events": DATES.format(sales=EVENT_SALES),
    "fact_sales_rows": fact(),
    "fact_sales_resent_products": fact(products=PRODUCTS_RESENT),
    **kpis(),
    "kpi_total_sales_by_date_events": total_sales(EVENT_SALES),
    "kpi_total_sales_by_date_events_day": total_sales(EVENT_SALES, "day"),
    "kpi_top_products_first_10": f"""
  SELECT * FROM ({top_products()}) ORDER BY "Revenue" DESC NULLS LAST, "ProductID" NULLS LAST LIMIT 10""",
    "kpi_customer_type_counts_day": customer_types(grain="day"),
    "kpi_customer_type_counts_events": customer_types(EVENT_SALES),
    "kpi_customer_type_counts_events_day": customer_types(EVENT_SALES, "day"),
    "kpi_employee_daily_sales_day": employee_sales(grain="day"),
    "kpi_employee_daily_sales_events_day": employee_sales(EVENT_SALES, "day"),
    "exact_total_sales_by_date": exact({"SalesTimestamp": sold_at("second")}, "TotalSales"),
    "exact_top_products": exact({"ProductID": '"ProductID"'}, "Revenue"),
    "exact_sales_by_employee": exact({"EmployeeID": '"EmployeeID"'}, "employee_sales"),
    "exact_employee_daily_sales_events_day": exact(
        {"EmployeeID": '"EmployeeID"', "SalesTimestamp": sold_at("day")}, "daily_revenue", EVENT_SALES
    ),
    "lattice_total_sales_by_date_day": exact({"SalesTimestamp": sold_at("day")}, "TotalSales"),
    "lattice_top_products": exact({"ProductID": '"ProductID"'}, "Revenue"),
    "lattice_sales_by_employee": exact({"EmployeeID": '"EmployeeID"'}, "employee_sales"),
    "lattice_employee_daily_sales_day": exact(
        {"EmployeeID": '"EmployeeID"', "SalesTimestamp": sold_at("day")}, "daily_revenue"
    ),
    "lattice_employee_daily_sales_undated": exact(
        {"EmployeeID": '"EmployeeID"', "SalesTimestamp": sold_at("second")}, "daily_revenue", UNDATED_SALES
    ),
    "lattice_top_products_events": exact({"ProductID": '"ProductID"'}, "Revenue", EVENT_SALES),
    "stored_kpi_sales_by_employee_exact": exact({"EmployeeID": '"EmployeeID"'}, "employee_sales", UNDATED_SALES),
    "bitmap_customer_type_counts_day": customer_types(grain="day"),
    "bitmap_customer_type_counts_month": f"""
  SELECT CAST(date_trunc('month', "SalesTimestamp") AS TIMESTAMP) AS "SalesMonth", "CustomerType",
         count(DISTINCT "CustomerID") AS "CustomerCount"
  FROM ({labelled()}) GROUP BY 1, 2""",
    "bitmap_customer_counts_undated_month": f"""
  SELECT CAST(date_trunc('month', "SalesTimestamp") AS TIMESTAMP) AS "SalesMonth", count(DISTINCT "CustomerID") AS "CustomerCount"
  FROM ({fact(UNDATED_SALES)}) WHERE "CustomerID" IS NOT NULL GROUP BY 1""",
}
