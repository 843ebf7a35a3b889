import datetime as dt
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from salesmart.cli import parse, run
from salesmart.plans.mart import KPI_TABLES, TABLES, build_mart, build_table
from salesmart.sinks import staging
from salesmart.sinks.store import MartStore
from checks import testbed
from tests.frames import employees, facts, nanos, products, sales, table, customers, values

FACTS = [(1, "2018-01-01 10:00:00", 1.0), (1, "2018-01-01 23:59:59", 2.0), (2, None, 3.0), (None, "2018-01-02", 4.0)]


@pytest.fixture(scope="module")
def raw(spark):
    at = nanos("2018-01-01 10:00:00")
    rows = [
        {"SalesID": i // 2, "SalesPersonID": i % 4, "CustomerID": i % 5 or None, "ProductID": i % 7,
         "Quantity": 1, "Discount": 0.0, "TotalPrice": i / 4, "SalesDate": at + i % 11 * 50_000_500_000_000,
         "TransactionNumber": f"T{i}"}
        for i in range(60)
    ]
    return {
        "sales": sales(spark, *rows, {"SalesID": 99, "TotalPrice": 1.5, "CustomerID": 1}),
        "products": products(spark, 1, 2, 2, 3, 4),
        "customers": customers(spark, 1, 2, 3, 3, 4),
        "employees": employees(spark, 1, 2),
        "categories": table(spark, "categories", [{"CategoryID": 1, "CategoryName": "a"}]),
        "cities": table(spark, "cities", [{"CityID": 1, "CountryID": 2}]),
        "countries": table(spark, "countries", [{"CountryID": 2, "CountryName": "b"}]),
    }


def stores(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS mart_store")
    return {
        "files": MartStore.files(f"{tmp_path}/files/"),
        "orc files": MartStore.files(f"{tmp_path}/orc", "orc"),
        "database": MartStore.database("mart_store"),
        # Parquet by path option stands in for a connector that takes a table name.
        "connector": MartStore.connector("parquet", f"{tmp_path}/warehouse", {"compression": "gzip"}, "path"),
    }


@pytest.mark.parametrize("kind", ["files", "orc files", "database", "connector"])
def test_tables_come_back_as_written_and_are_replaced(spark, tmp_path, kind):
    store = stores(spark, tmp_path)[kind]
    df = facts(spark, FACTS)
    for rows in (df, df.where("CustomerID = 1")):
        store.write(rows, "fact_sales", by_day=True)
        store.write(rows, "flat")
        for name in ("fact_sales", "flat"):
            stored = store.read(spark, name)
            assert stored.dtypes == df.dtypes
            assert values(stored) == values(rows)


def test_day_partitions(spark, tmp_path):
    store = MartStore.files(str(tmp_path))
    store.write(facts(spark, FACTS), "fact_sales", by_day=True)
    days = store.read(spark, "fact_sales", keep_day=True).groupBy("SalesDay").count()
    assert values(days) == [(dt.date(2018, 1, 1), 2), (dt.date(2018, 1, 2), 1), (None, 1)]
    assert {path.name for path in (tmp_path / "fact_sales").glob("SalesDay=*")} == {
        "SalesDay=2018-01-01", "SalesDay=2018-01-02", "SalesDay=__HIVE_DEFAULT_PARTITION__",
    }


def test_catalog_tables_are_partitioned_by_day(spark):
    store = MartStore.database("mart_days")
    spark.sql("CREATE DATABASE mart_days")
    store.write(facts(spark, FACTS), "fact_sales", by_day=True)
    columns = {column.name: column.isPartition for column in spark.catalog.listColumns("mart_days.fact_sales")}
    assert [name for name, partition in columns.items() if partition] == ["SalesDay"]


def contents(spark, store):
    return {name: values(store.read(spark, name)) for name in TABLES}


def test_mart_is_complete_consistent_and_repeatable(spark, raw, tmp_path):
    store = MartStore.files(str(tmp_path))
    build_mart(spark, raw, store)
    first = contents(spark, store)
    assert len(first) == 14 and len(KPI_TABLES) == 7
    fact = store.read(spark, "fact_sales")
    total = fact.agg(F.sum("TotalPrice")).first()[0]
    for name, column in {
        "kpi_total_sales_by_date": "TotalSales", "kpi_top_products": "Revenue",
        "kpi_sales_by_employee": "employee_sales", "kpi_employee_daily_sales": "daily_revenue",
    }.items():
        assert store.read(spark, name).agg(F.sum(column)).first()[0] == pytest.approx(total)
    new = store.read(spark, "kpi_customer_type_counts").where("CustomerType = 'New' AND SalesTimestamp IS NOT NULL")
    dated = fact.where("CustomerID IS NOT NULL AND SalesTimestamp IS NOT NULL")
    assert new.agg(F.sum("CustomerCount")).first()[0] == dated.select("CustomerID").distinct().count()
    # Product 2 and customer 3 occur twice in their dimensions.
    copies = {2: 2}, {3: 2}
    expected = sum(copies[0].get(r["ProductID"], 1) * copies[1].get(r["CustomerID"], 1) for r in raw["sales"].collect())
    assert fact.count() == expected > 61

    build_mart(spark, raw, store)
    assert contents(spark, store) == first

    one_by_one = MartStore.files(str(tmp_path / "again"))
    for name in TABLES:
        build_table(spark, name, raw, one_by_one)
    assert contents(spark, one_by_one) == first


def test_mart_in_a_database(spark, raw):
    spark.sql("CREATE DATABASE whole_mart")
    build_mart(spark, raw, MartStore.database("whole_mart"), grain="day", k=2)
    assert {table.name for table in spark.catalog.listTables("whole_mart")} == set(TABLES)
    assert spark.table("whole_mart.kpi_top_products").count() == 2
    assert spark.table("whole_mart.fact_sales").count() > 61


def test_grain_and_k_reach_the_tables(spark, raw, tmp_path):
    store = MartStore.files(str(tmp_path))
    for name in ("fact_sales", "kpi_total_sales_by_date", "kpi_top_products", "kpi_employee_daily_sales"):
        build_table(spark, name, raw, store, grain="day", k=3)
    partitioned = {path.parent.name for path in tmp_path.glob("*/SalesDay=*")}
    assert partitioned == {"fact_sales", "kpi_employee_daily_sales"}
    times = store.read(spark, "kpi_total_sales_by_date").select("SalesTimestamp")
    assert times.where("SalesTimestamp != date_trunc('day', SalesTimestamp)").count() == 0
    assert store.read(spark, "kpi_top_products").count() == 3


def test_unknown_table(spark, raw, tmp_path):
    with pytest.raises(ValueError, match="noop_step_1"):
        build_table(spark, "noop_step_1", raw, MartStore.files(str(tmp_path)))


def test_command_line(spark, tmp_path, capsys):
    raw_folder, mart = f"{tmp_path}/raw", f"{tmp_path}/mart"
    for name, df in testbed.RawTables(spark, "/root/testdata/sf0.001").items():
        if name in ("products", "categories"):
            df.write.parquet(f"{raw_folder}/{name}.parquet")
    for task in ("dim_products", "kpi_price_trends"):
        run(spark, parse(["--task", task, "--raw", raw_folder, "--mart", mart]))
    assert MartStore.files(mart).read(spark, "kpi_price_trends").count() > 20

    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "countries.csv").write_text("CountryID,CountryName,CountryCode\n47,Norway,NO\n")
    run(spark, parse(["--task", "ingest", "--csv", f"{tmp_path}/csv", "--raw", raw_folder]))
    assert "countries: 1 rows" in capsys.readouterr().out

    for bad in (["--task", "noop_step_1", "--raw", "r", "--mart", "m"], ["--task", "dim_dates", "--raw", "r"]):
        with pytest.raises(SystemExit) as stopped:
            parse(bad)
        assert stopped.value.code == 2


def test_staged_tables_go_to_the_checkpoint_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    staged = staging.stage(spark.range(5), "numbers")
    assert values(staged) == [(i,) for i in range(5)]
    assert staged.inputFiles()[0].startswith(f"file://{folder}/numbers-")


class _Session:
    """A session of some master and settings, as far as the shared folder looks at it."""

    def __init__(self, master, checkpoints=None, **conf):
        self.conf = {key.replace("__", "."): value for key, value in conf.items()}
        self.sparkContext = type("Context", (), {"master": master, "getCheckpointDir": lambda _: checkpoints})()


def test_only_a_local_session_may_use_a_temporary_folder():
    cluster = "spark://host:7077"
    assert staging.shared_folder(_Session(cluster, spark__checkpoint__dir="hdfs://a/b/")) == "hdfs://a/b"
    assert staging.shared_folder(_Session("local[2]")) == staging.shared_folder(_Session("local[2]"))
    assert staging.shared_folder(_Session(cluster, "hdfs://set/")) == "hdfs://set"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_folder(_Session(cluster))


def test_dynamic_overwrite_mode_still_replaces_all_days(spark, tmp_path, settings):
    settings(spark__sql__sources__partitionOverwriteMode="dynamic")
    spark.sql("CREATE DATABASE IF NOT EXISTS mart_dynamic")
    df = facts(spark, FACTS)
    for store in (MartStore.files(str(tmp_path)), MartStore.database("mart_dynamic")):
        for rows in (df, df.where("SalesTimestamp IS NULL")):
            store.write(rows, "fact_sales", by_day=True)
            assert values(store.read(spark, "fact_sales")) == values(rows)


def test_a_failed_build_keeps_the_old_table(spark, raw, tmp_path):
    store = MartStore.files(str(tmp_path))
    build_table(spark, "dim_categories", raw, store)
    bad = raw["categories"].withColumn("CategoryName", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        build_table(spark, "dim_categories", {**raw, "categories": bad}, store)
    assert store.read(spark, "dim_categories").count() == 1
    assert [path.name for path in tmp_path.iterdir()] == ["dim_categories"]


def test_a_failed_table_cancels_the_waiting_ones(spark, raw, tmp_path):
    bad = raw["sales"].withColumn("TransactionNumber", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        build_mart(spark, {**raw, "sales": bad}, MartStore.files(str(tmp_path)), concurrent_tables=1)
    assert len(list(tmp_path.glob("dim_*"))) < 6


def test_an_in_memory_catalog_is_refused_before_any_work(tmp_path):
    for arguments in (["--task", "ingest", "--register", "x"], ["--task", "all", "--database", "x"]):
        done = subprocess.run(
            [sys.executable, "-m", "salesmart", *arguments, "--raw", str(tmp_path / "none")],
            capture_output=True, text=True, timeout=120,
        )
        assert done.returncode != 0 and "catalog is in memory" in done.stderr


def test_connector_from_the_command_line(spark, raw, tmp_path):
    raw["categories"].write.parquet(f"{tmp_path}/raw/categories.parquet")
    options = parse([
        "--task", "dim_categories", "--raw", f"{tmp_path}/raw", "--format", "parquet", "--dataset", f"{tmp_path}/set",
        "--option", "compression=gzip", "--name-option", "path",
    ])
    run(spark, options)
    assert list(tmp_path.glob("set.dim_categories/*.gz.parquet"))
