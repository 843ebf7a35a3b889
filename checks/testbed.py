"""The seven raw tables, derived from TPC-H-like order tables.

Whole tables are mapped. Two keys are shifted by one so that some sales have no
employee and some cities no country, and two are null for some rows: sales of
returned goods have no sales person (a third of all), and orders of unspecified
priority have no customer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns used of each test table. Declaring them saves a job per table that infers them.
TEST_DDL = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double, "
        "l_extendedprice double, l_discount double, l_returnflag string"
    ),
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, value double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def _test_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(TEST_DDL[table]).parquet(f"{sf_dir}/{table}.parquet")


def _nanos(timestamp: str) -> Column:
    return F.unix_micros(F.col(timestamp).cast("timestamp")) * F.lit(1000)


def _brand_number() -> Column:
    return F.regexp_extract("p_brand", "([0-9]+)$", 1).cast("bigint")


def undated(sales: DataFrame) -> DataFrame:
    """Sales of which those whose number ends with 3 have no date."""
    return sales.withColumn("SalesDate", F.when(F.col("SalesID") % 10 != 3, F.col("SalesDate")))


def line_count(spark: SparkSession, sf_dir: str) -> int:
    """Order lines, counted from the files' footers."""
    return _test_table(spark, sf_dir, "lineitem").count()


def raw_sales(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Order lines with their order, joined in that many partitions if given."""
    lines = _test_table(spark, sf_dir, "lineitem")
    if partitions:
        lines = lines.repartition(partitions, "l_orderkey")
    orders = _test_table(spark, sf_dir, "orders")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("l_orderkey").alias("SalesID"),
        F.when(F.col("l_returnflag") != "R", F.col("l_suppkey") + 1).alias("SalesPersonID"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_custkey")).alias("CustomerID"),
        F.col("l_partkey").alias("ProductID"),
        F.col("l_quantity").cast("bigint").alias("Quantity"),
        F.col("l_discount").alias("Discount"),
        F.col("l_extendedprice").alias("TotalPrice"),
        _nanos("o_orderdate").alias("SalesDate"),
        F.col("l_orderkey").cast("string").alias("TransactionNumber"),
    )


def skewed(sales: DataFrame) -> DataFrame:
    """Sales of which a third more, those whose order number leaves 1 by 3, are of sales person 2, besides the third without one."""
    return sales.withColumn(
        "SalesPersonID", F.when(F.col("SalesPersonID").isNull() | (F.col("SalesID") % 3 != 1), F.col("SalesPersonID")).otherwise(2)
    )


def raw_sales_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as sales, which have times finer than a second.

    Users stand for both customers and sales people, and every event is its own
    product, so that many sales match no employee or product.
    """
    events = _test_table(spark, sf_dir, "events")
    return events.select(
        F.col("event_id").alias("SalesID"),
        F.col("user_id").alias("SalesPersonID"),
        F.col("user_id").alias("CustomerID"),
        F.col("event_id").alias("ProductID"),
        F.lit(1).cast("bigint").alias("Quantity"),
        F.lit(None).cast("double").alias("Discount"),
        F.col("value").alias("TotalPrice"),
        _nanos("ts").alias("SalesDate"),
        F.lit(None).cast("string").alias("TransactionNumber"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts, with a made-up modification date within two years."""
    modified = F.lit(788_918_400) + F.col("p_partkey") % 730 * 86_400  # from 1995-01-01
    return _test_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ProductID"),
        F.col("p_name").alias("ProductName"),
        F.col("p_retailprice").alias("Price"),
        _brand_number().alias("CategoryID"),
        F.col("p_type").alias("Class"),
        (modified * F.lit(1_000_000_000)).alias("ModifyDate"),
        F.lit("Unknown").alias("Resistant"),
        F.lit("FALSE").alias("IsAllergic"),
        F.col("p_size").cast("double").alias("VitalityDays"),
    )


def raw_products_resent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All products, with those of the ECONOMY class sent a second time."""
    products = raw_products(spark, sf_dir)
    return products.unionAll(products.where(F.col("Class") == "ECONOMY"))


def raw_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers."""
    return _test_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("EmployeeID"),
        F.col("s_name").alias("FirstName"),
        F.lit("M").alias("MiddleInitial"),
        F.lit("Staff").alias("LastName"),
        F.lit("X").alias("Gender"),
        F.col("s_nationkey").cast("bigint").alias("CityID"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers."""
    return _test_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("CustomerID"),
        F.col("c_name").alias("FirstName"),
        F.lit("M").alias("MiddleInitial"),
        F.col("c_mktsegment").alias("LastName"),
        F.col("c_nationkey").cast("bigint").alias("CityID"),
        F.lit("1 Main St").alias("Address"),
    )


def raw_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The brand of every part, one row per part: the dimension removes the copies."""
    return _test_table(spark, sf_dir, "part").select(
        _brand_number().alias("CategoryID"), F.col("p_brand").alias("CategoryName")
    )


def raw_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations."""
    return _test_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("CityID"),
        F.col("n_name").alias("CityName"),
        (F.col("n_nationkey") + 10_000).cast("bigint").alias("Zipcode"),
        F.col("n_regionkey").cast("bigint").alias("CountryID"),
    )


def raw_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions, keyed one higher than the cities refer to them."""
    return _test_table(spark, sf_dir, "region").select(
        (F.col("r_regionkey") + 1).cast("bigint").alias("CountryID"),
        F.col("r_name").alias("CountryName"),
        F.substring("r_name", 1, 2).alias("CountryCode"),
    )


RAW_BUILDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "sales": raw_sales,
    "products": raw_products,
    "employees": raw_employees,
    "customers": raw_customers,
    "categories": raw_categories,
    "cities": raw_cities,
    "countries": raw_countries,
}


class RawTables(Mapping[str, DataFrame]):
    """All seven raw tables, each opened on demand; ``others`` replace some of them."""

    def __init__(self, spark: SparkSession, sf_dir: str, **others: DataFrame) -> None:
        self._spark = spark
        self._sf_dir = sf_dir
        self._others = others

    def __getitem__(self, table: str) -> DataFrame:
        if table in self._others:
            return self._others[table]
        return RAW_BUILDERS[table](self._spark, self._sf_dir)

    def __iter__(self) -> Iterator[str]:
        return iter(RAW_BUILDERS)

    def __len__(self) -> int:
        return len(RAW_BUILDERS)
