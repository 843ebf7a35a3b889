"""Queries over the test tables, one or more per operator and table of the mart.

Timestamps are returned without a time zone, as the test tables hold them. The
last bits of a sum of doubles depend on the order of the rows, so sums of money
are rounded to cents. Averages can fall halfway between two roundings; they are
taken over exact decimals and so come out rounded half up to six places.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.operators.aggregates import first_purchases
from salesmart.operators.bitmaps import customer_bitmaps, customers_in
from salesmart.operators.joins import left_match, left_match_as, left_match_copies, repeated_keys, with_first_purchase
from salesmart.operators.ordering import with_rank
from salesmart.operators.skew import left_match_skewed
from salesmart.plans import dimensions, kpis
from salesmart.plans.fact import build_fact_sales
from salesmart.plans.mart import TABLES, build_mart, build_table
from salesmart.sinks.staging import Area, new_folder, stage
from salesmart.sinks.store import MartStore
from checks import testbed
from salesmart.sources.catalog import register_external
from salesmart.sources.csv_ingest import CsvOptions, csv_to_parquet
from salesmart.sources.raw import RawFiles, with_product_times, with_sales_times

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

#: Sales that one task groups or sorts where nearly every sale is a group of its own.
ROWS_A_TASK = 250_000


def query(function: Query) -> Query:
    """Register a query under its name. It runs in UTC and returns zone-less timestamps."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        df = function(spark, sf_dir)
        zoned = [name for name, kind in df.dtypes if kind == "timestamp"]
        return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})

    QUERIES[function.__name__] = run
    return run


def mart_store(spark: SparkSession) -> MartStore:
    """A fresh place for mart tables."""
    return MartStore.files(new_folder(spark, "mart"))


def cents(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.round(column, 2))


def exact(df: DataFrame, column: str) -> DataFrame:
    """Amounts as decimals, which add up and average without error."""
    return df.withColumn(column, F.col(column).cast("decimal(18,2)"))


def as_double(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("double"))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_fact_sales(testbed.RawTables(spark, sf_dir))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testbed.raw_sales_of_events(spark, sf_dir)


def fact_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_fact_sales(testbed.RawTables(spark, sf_dir, sales=events(spark, sf_dir)))


def fact_of_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_fact_sales(testbed.RawTables(spark, sf_dir, sales=testbed.undated(events(spark, sf_dir))))


def written_raw(spark: SparkSession, raw: Mapping[str, DataFrame]) -> str:
    """A folder with raw tables as Parquet, to scan them as a user would."""
    folder = new_folder(spark, "raw")
    for table, df in raw.items():
        df.write.parquet(f"{folder}/{table}.parquet")
    return folder


def scanned(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    raw = testbed.RawTables(spark, sf_dir)
    return RawFiles(spark, written_raw(spark, {table: raw[table]}))[table]


# ---- typed scans


@query
def scan_sales(spark, sf_dir):
    return with_sales_times(scanned(spark, sf_dir, "sales"))


@query
def scan_products(spark, sf_dir):
    return with_product_times(scanned(spark, sf_dir, "products"))


@query
def scan_employees(spark, sf_dir):
    return scanned(spark, sf_dir, "employees")


@query
def scan_customers(spark, sf_dir):
    return scanned(spark, sf_dir, "customers")


@query
def scan_categories(spark, sf_dir):
    return scanned(spark, sf_dir, "categories")


@query
def scan_cities(spark, sf_dir):
    return scanned(spark, sf_dir, "cities")


@query
def scan_countries(spark, sf_dir):
    return scanned(spark, sf_dir, "countries")


# ---- CSV ingestion, external tables, stored tables


def ingested(spark: SparkSession, sales: DataFrame) -> DataFrame:
    """Sales written as CSV with dates as text, converted to Parquet and scanned."""
    folder = new_folder(spark, "csv")
    sold_at = F.timestamp_micros(F.call_function("div", F.col("SalesDate"), F.lit(1000)))
    as_text = sales.withColumn("SalesDate", F.date_format(sold_at, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    as_text.write.option("header", True).csv(f"{folder}/sales.csv")
    csv_to_parquet(spark, folder)
    return with_sales_times(RawFiles(spark, folder)["sales"])


@query
def csv_ingest_sales(spark, sf_dir):
    return ingested(spark, testbed.raw_sales(spark, sf_dir))


@query
def csv_ingest_events(spark, sf_dir):
    return ingested(spark, events(spark, sf_dir))


@query
def external_tables(spark, sf_dir):
    root = written_raw(spark, testbed.RawTables(spark, sf_dir))
    database = root.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/database'")
    counts = [
        spark.table(name).agg(F.lit(name.split(".")[1]).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name in register_external(spark, root, database)
    ]
    return reduce(DataFrame.unionAll, counts)


@query
def csv_ingest_untidy(spark, sf_dir):
    """Null spellings, quotes and commas in text, zone offsets, and dates too far for nanoseconds, which become null."""
    sold_at = F.timestamp_micros(F.call_function("div", F.col("SalesDate"), F.lit(1000)))
    written = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    number = F.col("SalesID")
    untidy = events(spark, sf_dir).withColumns(
        {
            "SalesDate": F.when(number % 50 == 7, "9999-12-31")
            .when(number % 3 == 1, F.concat(F.date_format(sold_at + F.expr("INTERVAL 2 HOURS"), written), F.lit("+02:00")))
            .when(number % 3 == 2, F.concat(F.date_format(sold_at, written), F.lit("Z")))
            .otherwise(F.date_format(sold_at, written)),
            "CustomerID": F.when(number % 5 == 0, F.element_at(F.array(*map(F.lit, ("NA", "NULL", "n/a"))), (number % 3 + 1).cast("int")))
            .otherwise(F.col("CustomerID").cast("string")),
            "TransactionNumber": F.concat(F.lit('said "'), number.cast("string"), F.lit('", twice')),
        }
    )
    folder = new_folder(spark, "csv")
    untidy.write.option("header", True).option("escape", '"').csv(f"{folder}/sales.csv")
    csv_to_parquet(spark, folder, options=CsvOptions(strict=False))
    return with_sales_times(RawFiles(spark, folder)["sales"])


@query
def csv_ingest_line_breaks(spark, sf_dir):
    """Line breaks, quotes and commas in quoted text, in files that are split."""
    sold_at = F.timestamp_micros(F.call_function("div", F.col("SalesDate"), F.lit(1000)))
    number = F.col("SalesID").cast("string")
    text = F.concat(F.lit('order "'), number, F.lit('",\n\nline '), F.col("ProductID").cast("string"), F.lit("\n"))
    broken = testbed.raw_sales(spark, sf_dir).withColumns(
        {"SalesDate": F.date_format(sold_at, "yyyy-MM-dd HH:mm:ss.SSSSSS"), "TransactionNumber": text}
    )
    folder = new_folder(spark, "csv")
    as_written = {"header": True, "escape": '"', "ignoreTrailingWhiteSpace": False}
    broken.write.options(**as_written).csv(f"{folder}/sales.csv")
    csv_to_parquet(spark, folder, options=CsvOptions(multiline=True))
    return with_sales_times(RawFiles(spark, folder)["sales"])


def external(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the external tables over written raw tables."""
    root = written_raw(spark, testbed.RawTables(spark, sf_dir))
    database = root.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/database'")
    register_external(spark, root, database)
    return spark.table(f"{database}.{table}_ext")


@query
def external_sales(spark, sf_dir):
    return with_sales_times(external(spark, sf_dir, "sales"))


@query
def external_products(spark, sf_dir):
    return with_product_times(external(spark, sf_dir, "products"))


@query
def stored_fact_sales(spark, sf_dir):
    """Fact partitioned by day, read back."""
    store = mart_store(spark)
    store.write(fact(spark, sf_dir), "fact_sales", by_day=True)
    return store.read(spark, "fact_sales")


@query
def stored_price_trends(spark, sf_dir):
    """Two tables built by name; the second reads the first back."""
    store = mart_store(spark)
    raw = testbed.RawTables(spark, sf_dir, products=exact(testbed.raw_products(spark, sf_dir), "Price"))
    for table in ("dim_products", "kpi_price_trends"):
        build_table(spark, table, raw, store)
    return as_double(store.read(spark, "kpi_price_trends"), "avg_price")


def whole_mart(spark: SparkSession, sf_dir: str) -> MartStore:
    """The mart with events as sales, a tenth of them undated, built from written raw tables."""
    raw = testbed.RawTables(spark, sf_dir, sales=testbed.undated(events(spark, sf_dir)))
    store = mart_store(spark)
    build_mart(spark, RawFiles(spark, written_raw(spark, raw)), store)
    return store


@query
def stored_kpi_total_sales_by_date(spark, sf_dir):
    return cents(whole_mart(spark, sf_dir).read(spark, "kpi_total_sales_by_date"), "TotalSales")


@query
def stored_kpi_customer_type_counts(spark, sf_dir):
    return whole_mart(spark, sf_dir).read(spark, "kpi_customer_type_counts")


@query
def stored_kpi_employee_daily_sales(spark, sf_dir):
    return cents(whole_mart(spark, sf_dir).read(spark, "kpi_employee_daily_sales"), "daily_revenue")


@query
def stored_dim_dates(spark, sf_dir):
    return whole_mart(spark, sf_dir).read(spark, "dim_dates")


@query
def stored_fact_sales_undated(spark, sf_dir):
    """A fact with a null day partition, read back."""
    store = mart_store(spark)
    store.write(fact_of_undated(spark, sf_dir), "fact_sales", by_day=True)
    return store.read(spark, "fact_sales")


def overwritten(spark: SparkSession, sf_dir: str, store: MartStore) -> DataFrame:
    """The fact, then only its sales of 1997 on: no earlier day is left."""
    rows = fact(spark, sf_dir)
    store.write(rows, "fact_sales", by_day=True)
    store.write(rows.where("SalesTimestamp >= '1997-01-01'"), "fact_sales", by_day=True)
    return store.read(spark, "fact_sales")


@query
def stored_overwrite(spark, sf_dir):
    """Published by commit records."""
    return overwritten(spark, sf_dir, MartStore.versioned(new_folder(spark, "mart")))


@query
def stored_kpi_top_products_versioned(spark, sf_dir):
    """A whole build, twice, into versioned folders."""
    raw = RawFiles(spark, written_raw(spark, testbed.RawTables(spark, sf_dir, sales=events(spark, sf_dir))))
    store = MartStore.versioned(new_folder(spark, "mart"), keep=1)
    for grain in ("day", "second"):
        build_mart(spark, raw, store, grain)
    return store.read(spark, "kpi_top_products")


@query
def stored_kpi_top_products_rank(spark, sf_dir):
    """A stored order, from a whole build with events as sales and users as products."""
    sold = events(spark, sf_dir).withColumn("ProductID", F.col("CustomerID"))
    raw = RawFiles(spark, written_raw(spark, testbed.RawTables(spark, sf_dir, sales=sold)))
    store = mart_store(spark)
    build_mart(spark, raw, store, ranks=True)
    return store.read(spark, "kpi_top_products")


@query
def ranked_sales(spark, sf_dir):
    """Every sale's place by amount, ties by number and then by all other columns."""
    parts = testbed.line_count(spark, sf_dir) // ROWS_A_TASK + 1
    key = ["SalesID", "ProductID", "TotalPrice"]
    sales = testbed.raw_sales(spark, sf_dir, parts).select(*key, "Quantity").repartition(parts, *key)
    lines = sales.groupBy(*key).agg(F.sum("Quantity").alias("Quantity"))
    tied = lines.withColumn("line", F.struct("SalesID", "ProductID"))
    return with_rank(tied, "TotalPrice", "line", partitions=parts).drop("line")


@query
def mart_table_counts(spark, sf_dir):
    """The whole mart with events as sales, built from written raw tables; rows per table."""
    raw = RawFiles(spark, written_raw(spark, testbed.RawTables(spark, sf_dir, sales=events(spark, sf_dir))))
    store = mart_store(spark)
    build_mart(spark, raw, store)
    counts = [
        store.read(spark, name).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name in TABLES
    ]
    return reduce(DataFrame.unionAll, counts)


# ---- joins


@query
def sales_left_products(spark, sf_dir):
    sales = with_sales_times(testbed.raw_sales(spark, sf_dir))
    return left_match(sales, testbed.raw_products(spark, sf_dir), "ProductID")


@query
def sales_left_products_resent(spark, sf_dir):
    """Products that occur twice give two rows per sale."""
    sales = with_sales_times(testbed.raw_sales(spark, sf_dir))
    return left_match(sales, testbed.raw_products_resent(spark, sf_dir), "ProductID")


@query
def sales_left_repeated_products(spark, sf_dir):
    """As before, through the repeated keys only."""
    sales = with_sales_times(testbed.raw_sales(spark, sf_dir))
    repeated = repeated_keys(testbed.raw_products_resent(spark, sf_dir), "ProductID")
    return left_match_copies(sales, stage(repeated, "product-keys"), "ProductID")


@query
def sales_left_customers(spark, sf_dir):
    sales = with_sales_times(testbed.raw_sales(spark, sf_dir))
    return left_match(sales, testbed.raw_customers(spark, sf_dir), "CustomerID")


@query
def sales_left_employees(spark, sf_dir):
    sales = with_sales_times(testbed.raw_sales(spark, sf_dir))
    return left_match_as(sales, testbed.raw_employees(spark, sf_dir), "SalesPersonID", "EmployeeID")


@query
def sales_left_employees_skewed(spark, sf_dir):
    """A third of the sales without sales person and a third of one: neither is shuffled."""
    sales = with_sales_times(testbed.skewed(testbed.raw_sales(spark, sf_dir)))
    return left_match_skewed(sales, testbed.raw_employees(spark, sf_dir), "SalesPersonID", "EmployeeID", keep_key=True)


@query
def sales_left_employees_resent_skewed(spark, sf_dir):
    """As before, with every employee sent twice, so that the heavy one has copies too."""
    sales = with_sales_times(testbed.skewed(testbed.raw_sales(spark, sf_dir)))
    employees = testbed.raw_employees(spark, sf_dir)
    return left_match_skewed(sales, employees.unionAll(employees), "SalesPersonID", "EmployeeID", keep_key=True)


@query
def sales_left_customers_skewed(spark, sf_dir):
    """Null customers bypass the shuffle; no column of the customers is kept."""
    sales = with_sales_times(testbed.raw_sales(spark, sf_dir))
    return left_match_skewed(sales, testbed.raw_customers(spark, sf_dir), "CustomerID", "CustomerID")


@query
def sales_first_purchase(spark, sf_dir):
    sales = fact(spark, sf_dir)
    return with_first_purchase(sales, first_purchases(sales))


@query
def sales_first_purchase_events(spark, sf_dir):
    sales = fact_of_events(spark, sf_dir)
    return with_first_purchase(sales, first_purchases(sales)).select(
        "SalesID", "CustomerID", "SalesTimestamp", "FirstPurchaseDate", "CustomerType"
    )


@query
def first_purchase_per_customer(spark, sf_dir):
    return first_purchases(fact(spark, sf_dir))


# ---- dimensions


@query
def dim_products(spark, sf_dir):
    return dimensions.dim_products(testbed.raw_products(spark, sf_dir))


@query
def dim_products_resent(spark, sf_dir):
    """Products sent twice come out once."""
    return dimensions.dim_products(testbed.raw_products_resent(spark, sf_dir))


@query
def dim_customers(spark, sf_dir):
    return dimensions.dim_customers(testbed.raw_customers(spark, sf_dir))


@query
def dim_employees(spark, sf_dir):
    return dimensions.dim_employees(testbed.raw_employees(spark, sf_dir))


@query
def dim_categories(spark, sf_dir):
    return dimensions.dim_categories(testbed.raw_categories(spark, sf_dir))


@query
def dim_locations(spark, sf_dir):
    return dimensions.dim_locations(testbed.raw_cities(spark, sf_dir), testbed.raw_countries(spark, sf_dir))


@query
def dim_dates(spark, sf_dir):
    return dimensions.dim_dates(testbed.raw_sales(spark, sf_dir))


@query
def dim_dates_events(spark, sf_dir):
    return dimensions.dim_dates(events(spark, sf_dir))


@query
def dim_dates_undated(spark, sf_dir):
    return dimensions.dim_dates(testbed.undated(events(spark, sf_dir)))


# ---- fact


@query
def fact_sales_rows(spark, sf_dir):
    return fact(spark, sf_dir)


@query
def fact_sales_resent_products(spark, sf_dir):
    products = testbed.raw_products_resent(spark, sf_dir)
    return build_fact_sales(testbed.RawTables(spark, sf_dir, products=products))


# ---- KPI tables


@query
def kpi_total_sales_by_date(spark, sf_dir):
    return cents(kpis.total_sales_by_date(fact(spark, sf_dir)), "TotalSales")


@query
def kpi_total_sales_by_date_events(spark, sf_dir):
    return cents(kpis.total_sales_by_date(fact_of_events(spark, sf_dir)), "TotalSales")


@query
def kpi_total_sales_by_date_events_day(spark, sf_dir):
    return cents(kpis.total_sales_by_date(fact_of_events(spark, sf_dir), "day"), "TotalSales")


@query
def kpi_top_products(spark, sf_dir):
    return cents(kpis.top_products(fact(spark, sf_dir)), "Revenue")


@query
def kpi_top_products_first_10(spark, sf_dir):
    """Over exact decimals, so that equal revenues tie."""
    return as_double(kpis.top_products(exact(fact(spark, sf_dir), "TotalPrice"), 10), "Revenue")


@query
def kpi_top_products_ranked(spark, sf_dir):
    """The first hundred in their order, made visible as a rank over the rows kept."""
    top = kpis.top_products(exact(fact(spark, sf_dir), "TotalPrice"), 100)
    ranked = top.withColumn("place", F.row_number().over(Window.orderBy(F.desc_nulls_last("Revenue"), F.asc_nulls_last("ProductID"))))
    return as_double(ranked, "Revenue")


@query
def kpi_avg_order_value(spark, sf_dir):
    return as_double(kpis.avg_order_value(exact(fact(spark, sf_dir), "TotalPrice")), "avg_order_value")


@query
def kpi_customer_type_counts(spark, sf_dir):
    return kpis.customer_type_counts(fact(spark, sf_dir))


@query
def kpi_customer_type_counts_day(spark, sf_dir):
    return kpis.customer_type_counts(fact(spark, sf_dir), "day")


@query
def kpi_customer_type_counts_events(spark, sf_dir):
    return kpis.customer_type_counts(fact_of_events(spark, sf_dir))


@query
def kpi_customer_type_counts_events_day(spark, sf_dir):
    return kpis.customer_type_counts(fact_of_events(spark, sf_dir), "day")


@query
def kpi_price_trends(spark, sf_dir):
    products = exact(dimensions.dim_products(testbed.raw_products(spark, sf_dir)), "Price")
    return as_double(kpis.price_trends(products), "avg_price")


@query
def kpi_sales_by_employee(spark, sf_dir):
    return cents(kpis.sales_by_employee(fact(spark, sf_dir)), "employee_sales")


@query
def kpi_employee_daily_sales(spark, sf_dir):
    return cents(kpis.employee_daily_sales(fact(spark, sf_dir)), "daily_revenue")


@query
def kpi_employee_daily_sales_day(spark, sf_dir):
    return cents(kpis.employee_daily_sales(fact(spark, sf_dir), "day"), "daily_revenue")


@query
def kpi_employee_daily_sales_events_day(spark, sf_dir):
    return cents(kpis.employee_daily_sales(fact_of_events(spark, sf_dir), "day"), "daily_revenue")


@query
def kpi_customer_type_counts_undated(spark, sf_dir):
    """Undated sales are "New" ones without a time."""
    return kpis.customer_type_counts(fact_of_undated(spark, sf_dir))


@query
def kpi_customer_type_counts_undated_day(spark, sf_dir):
    return kpis.customer_type_counts(fact_of_undated(spark, sf_dir), "day")


# ---- exact sums: no rounding, the same bits whatever the order of the rows


@query
def exact_total_sales_by_date(spark, sf_dir):
    return kpis.total_sales_by_date(fact(spark, sf_dir), exact=True)


@query
def exact_top_products(spark, sf_dir):
    return kpis.top_products(fact(spark, sf_dir), exact=True)


@query
def exact_sales_by_employee(spark, sf_dir):
    return kpis.sales_by_employee(fact(spark, sf_dir), exact=True)


@query
def exact_employee_daily_sales_events_day(spark, sf_dir):
    return kpis.employee_daily_sales(fact_of_events(spark, sf_dir), "day", exact=True)


# ---- the lattice: four revenue tables from one scan of the fact


def from_lattice(spark: SparkSession, facts: DataFrame, name: str, grain: str) -> DataFrame:
    lattice = kpis.sales_lattice(stage(facts, "fact"), Area(spark).stage_by, grain)
    return kpis.FROM_LATTICE[name](lattice, None)


@query
def lattice_total_sales_by_date_day(spark, sf_dir):
    return from_lattice(spark, fact(spark, sf_dir), "kpi_total_sales_by_date", "day")


@query
def lattice_top_products(spark, sf_dir):
    return from_lattice(spark, fact(spark, sf_dir), "kpi_top_products", "day")


@query
def lattice_sales_by_employee(spark, sf_dir):
    return from_lattice(spark, fact(spark, sf_dir), "kpi_sales_by_employee", "day")


@query
def lattice_employee_daily_sales_day(spark, sf_dir):
    return from_lattice(spark, fact(spark, sf_dir), "kpi_employee_daily_sales", "day")


@query
def lattice_employee_daily_sales_undated(spark, sf_dir):
    return from_lattice(spark, fact_of_undated(spark, sf_dir), "kpi_employee_daily_sales", "second")


@query
def lattice_top_products_events(spark, sf_dir):
    return from_lattice(spark, fact_of_events(spark, sf_dir), "kpi_top_products", "second")


@query
def stored_kpi_sales_by_employee_exact(spark, sf_dir):
    """From a whole build, without rounding."""
    return whole_mart(spark, sf_dir).read(spark, "kpi_sales_by_employee")


# ---- distinct customers from stored bitmaps


def stored_bitmaps(spark: SparkSession, facts: DataFrame) -> DataFrame:
    store = mart_store(spark)
    store.write(customer_bitmaps(facts), "customer_bitmaps")
    return store.read(spark, "customer_bitmaps")


@query
def bitmap_customer_type_counts_day(spark, sf_dir):
    return customers_in(stored_bitmaps(spark, fact(spark, sf_dir)), "SalesTimestamp", "CustomerType")


@query
def bitmap_customer_type_counts_month(spark, sf_dir):
    month = F.date_trunc("month", "SalesTimestamp").alias("SalesMonth")
    return customers_in(stored_bitmaps(spark, fact(spark, sf_dir)), month, "CustomerType")


@query
def bitmap_customer_counts_undated_month(spark, sf_dir):
    """Both types together, with undated sales, at times finer than a second."""
    month = F.date_trunc("month", "SalesTimestamp").alias("SalesMonth")
    return customers_in(stored_bitmaps(spark, fact_of_undated(spark, sf_dir)), month)
