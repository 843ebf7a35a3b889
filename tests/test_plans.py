"""What the physical plans look like, and that hot keys are split."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from salesmart.operators.aggregates import first_purchases
from salesmart.operators.joins import left_match_copies, repeated_keys, with_first_purchase
from salesmart.plans import dimensions, kpis
from salesmart.plans.fact import build_fact_sales, fact_sales
from salesmart.plans.mart import build_table
from salesmart.sinks.store import MartStore, partitioned_by_day
from checks import testbed
from tests.frames import values

SF = "/root/testdata/sf0.001"


def plan(df, after_run=False):
    """The physical plan's text; with ``after_run`` the one adaptive execution ended with."""
    if after_run:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "", text.split("== Initial Plan ==")[0])


@pytest.fixture(scope="module")
def hot_facts(spark, tmp_path_factory):
    """20,000 stored facts, half of them of one customer and one day, from eight tasks."""
    path = str(tmp_path_factory.mktemp("facts") / "facts")
    rows = spark.range(0, 20_000, 1, 8).selectExpr(
        "id AS SalesID",
        "IF(id % 2 = 0, 1, id) AS CustomerID",
        "timestamp_seconds(IF(id % 2 = 0, id, id * 864)) AS SalesTimestamp",
        "1 AS EmployeeID", "1 AS ProductID", "uuid() AS TransactionNumber", "1.0D AS TotalPrice",
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def large(settings):
    """Session settings under which small test tables are treated as large ones."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20k",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )


def sf_fact(spark, **others):
    raw = testbed.RawTables(spark, SF, **others)
    return fact_sales(raw["sales"], raw["products"], raw["customers"], raw["employees"])


def test_no_plan_runs_python_or_a_cross_join(spark):
    fact = sf_fact(spark)
    products = dimensions.dim_products(testbed.raw_products(spark, SF))
    frames = [
        fact, products, kpis.total_sales_by_date(fact, "day"), kpis.top_products(fact), kpis.avg_order_value(fact),
        kpis.customer_type_counts(fact), kpis.customer_type_counts(fact, "day"), kpis.price_trends(products),
        kpis.sales_by_employee(fact), kpis.employee_daily_sales(fact),
        repeated_keys(testbed.raw_products_resent(spark, SF), "ProductID"),
        dimensions.dim_dates(testbed.raw_sales(spark, SF)),
        dimensions.dim_locations(testbed.raw_cities(spark, SF), testbed.raw_countries(spark, SF)),
    ]
    for df in frames:
        assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop|Window", plan(df))


@pytest.mark.parametrize(
    ("kpi", "columns", "shuffles"),
    [
        (kpis.total_sales_by_date, "SalesTimestamp,TotalPrice", 1),
        (kpis.avg_order_value, "SalesID,TotalPrice", 2),
        (kpis.sales_by_employee, "EmployeeID,TotalPrice", 1),
        (kpis.top_products, "ProductID,TotalPrice", 2),
        (kpis.employee_daily_sales, "SalesTimestamp,EmployeeID,TotalPrice", 1),
    ],
)
def test_kpis_scan_their_columns_and_combine_before_the_shuffle(hot_facts, kpi, columns, shuffles):
    text = plan(kpi(hot_facts))
    assert f"FileScan parquet [{columns}]" in text
    assert text.count("Exchange") == shuffles
    assert "partial_sum(TotalPrice)" in text


def test_top_k_is_not_a_full_sort(hot_facts):
    assert "TakeOrderedAndProject(limit=3" in plan(kpis.top_products(hot_facts, 3))


def test_day_level_customer_counts_share_one_shuffle(spark, hot_facts, large):
    text = plan(kpis.customer_type_counts(hot_facts, "day"), after_run=True)
    assert text.count("FileScan") == 1 and text.count("ReusedExchange") == 1
    assert "Join" not in text


def test_fact_joins_read_only_keys_and_split_hot_ones(spark, large):
    """A third of the sales have a null sales person, a fifth a null customer."""
    text = plan(sf_fact(spark), after_run=True)
    for key in ("p_partkey", "c_custkey", "s_suppkey"):
        assert f"FileScan parquet [{key}]" in text
    assert text.count("SortMergeJoin(skew=true)") >= 1


def test_small_dimensions_are_broadcast_without_a_hint(spark):
    text = plan(sf_fact(spark), after_run=True)
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") >= 3


def test_repeated_keys_spare_the_sales_a_shuffle(spark, settings, tmp_path):
    """A customer table too large to broadcast as a whole does not move the sales."""
    settings(spark__sql__autoBroadcastJoinThreshold="100k", spark__sql__adaptive__autoBroadcastJoinThreshold="100k")
    customers = str(tmp_path / "customers")
    spark.range(0, 200_000, 1, 4).selectExpr("id AS CustomerID").write.parquet(customers)
    customers = spark.read.parquet(customers)
    sales = str(tmp_path / "sales")
    testbed.raw_sales(spark, SF).write.parquet(sales)
    sales = spark.read.parquet(sales)
    whole = sf_fact(spark, sales=sales, customers=customers)
    spared = build_fact_sales(testbed.RawTables(spark, SF, sales=sales, customers=customers))
    assert "SortMergeJoin" in plan(whole, after_run=True)
    assert "SortMergeJoin" not in plan(spared, after_run=True) and "hashpartitioning" not in plan(spared)
    assert values(spared) == values(whole)


def test_hot_customers_are_split_in_the_first_purchase_join(spark, hot_facts, large):
    firsts = first_purchases(hot_facts)
    labelled = with_first_purchase(hot_facts, firsts)
    assert "SortMergeJoin(skew=true)" in plan(labelled, after_run=True)
    plain = hot_facts.join(firsts, "CustomerID")
    assert "skew=true" not in plan(plain, after_run=True)
    assert labelled.count() == 20_000


def test_a_hot_day_is_split_on_write(spark, hot_facts, large, tmp_path):
    store = MartStore.files(str(tmp_path))
    store.write(hot_facts, "fact_sales", by_day=True)
    files = store.read(spark, "fact_sales", keep_day=True).select("SalesDay", F.input_file_name().alias("file"))
    per_day = files.distinct().groupBy("SalesDay").count().collect()
    hot = {str(row["SalesDay"]): row["count"] for row in per_day}
    assert hot.pop("1970-01-01") > 3
    assert max(hot.values()) == 1
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(partitioned_by_day(hot_facts))
    assert store.read(spark, "fact_sales").count() == 20_000


def test_stored_days_are_pruned(spark, tmp_path):
    facts = spark.range(10).selectExpr("id AS SalesID", "timestamp_seconds(id * 86400) AS SalesTimestamp")
    store = MartStore.files(str(tmp_path))
    store.write(facts, "fact_sales", by_day=True)
    days = store.read(spark, "fact_sales", keep_day=True).where("SalesDay = DATE '1970-01-03'")
    assert re.search(r"PartitionFilters: \[isnotnull\(SalesDay\), \(SalesDay = 1970-01-03\)\]", plan(days))
    assert [row["SalesID"] for row in days.collect()] == [2]


def test_repeated_keys_are_one_row_each(spark):
    """Also a key that holds a third of 900,000 rows; the copies come back in the join."""
    dimension = spark.range(0, 900_000, 1, 8).selectExpr("IF(id % 3 = 0, 7, id) AS ProductID")
    repeated = repeated_keys(dimension, "ProductID")
    assert values(repeated) == [(7, 300_001)]
    facts = spark.createDataFrame([(7, 1), (8, 2), (None, 3)], "ProductID bigint, SalesID bigint")
    copied = left_match_copies(facts, repeated, "ProductID")
    assert values(copied.groupBy("SalesID").count()) == [(1, 300_001), (2, 1), (3, 1)]


def test_staged_tables_of_a_build_are_removed(spark, tmp_path):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    build_table(spark, "fact_sales", testbed.RawTables(spark, SF), MartStore.files(str(tmp_path / "mart")))
    assert set(shared.iterdir()) == before
