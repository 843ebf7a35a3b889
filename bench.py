"""Times the mart's tables and prints one line of JSON.

Environment: ``BENCH_SF_DIR`` (test tables), ``BENCH_CPUS`` (local cores), ``BENCH_RUNS``.
Per query: one warm-up, then the median of the runs, each planned anew and
written to Spark's "noop" sink. ``build_mart`` is timed once, into a new folder.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import SparkSession

from checks import testbed
from checks.queries import QUERIES, fact, mart_store
from salesmart.plans import kpis
from salesmart.plans.mart import build_mart
from salesmart.sources.raw import RawFiles

HEADLINE = [
    "dim_products", "dim_customers", "dim_employees", "dim_dates", "dim_categories", "dim_locations",
    "fact_sales_rows",
    "kpi_total_sales_by_date", "kpi_top_products", "kpi_avg_order_value", "kpi_customer_type_counts",
    "kpi_price_trends", "kpi_sales_by_employee", "kpi_employee_daily_sales",
    "kpi_total_sales_by_date_events_day", "kpi_customer_type_counts_day", "kpi_employee_daily_sales_day",
    "sales_first_purchase",
]


# KPI tables from a stored fact, as the mart builds them.
STORED = {
    "stored_total_sales_by_date": kpis.total_sales_by_date,
    "stored_top_products": kpis.top_products,
    "stored_avg_order_value": kpis.avg_order_value,
    "stored_customer_type_counts": kpis.customer_type_counts,
    "stored_sales_by_employee": kpis.sales_by_employee,
    "stored_employee_daily_sales": kpis.employee_daily_sales,
}


def seconds(job: Callable[[], None]) -> float:
    start = time.perf_counter()
    job()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("salesmart bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call-site lookup per column expression
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    store = mart_store(spark)
    store.write(fact(spark, sf_dir), "fact_sales")  # in one folder, as most days hold few kilobytes here

    def run(name: str) -> None:
        df = STORED[name](store.read(spark, "fact_sales")) if name in STORED else QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()

    times = {}
    for name in [*HEADLINE, *STORED]:
        run(name)
        times[name] = round(statistics.median(seconds(lambda: run(name)) for _ in range(runs)), 3)

    raw = f"{tempfile.mkdtemp(prefix='bench-')}/raw"
    tables = testbed.RawTables(spark, sf_dir, sales=testbed.raw_sales_of_events(spark, sf_dir))
    for table, df in tables.items():
        df.write.parquet(f"{raw}/{table}.parquet")
    store = mart_store(spark)
    times["build_mart_events"] = round(seconds(lambda: build_mart(spark, RawFiles(spark, raw), store)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf_dir.rsplit("sf", 1)[-1]) if "sf" in sf_dir else None,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
