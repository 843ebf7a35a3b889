"""Builds mart tables by name, one at a time or all in one application."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from dataclasses import dataclass, field, replace
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType

from salesmart.operators.lattice import Lattice
from salesmart.operators.ordering import with_rank
from salesmart.plans import dimensions, kpis
from salesmart.plans.fact import build_fact_sales
from salesmart.sinks import staging
from salesmart.sinks.store import MartStore

Raw = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Inputs:
    """What a table is built from."""

    spark: SparkSession
    raw: Raw
    store: MartStore
    grain: str = "second"
    k: int | None = None
    opened: Mapping[str, DataFrame] = field(default_factory=dict)
    stage: staging.Stage = staging.stage
    lattice: Lattice | None = None
    ranks: bool = False

    def stored(self, table: str) -> DataFrame:
        """A mart table built earlier; one that is already open is not listed again."""
        return self.opened[table] if table in self.opened else self.store.read(self.spark, table)


@dataclass(frozen=True)
class MartTable:
    """One mart table: its recipe, and whether it is partitioned by day.

    A table with a row or two per time is not worth partitioning at day grain,
    where every partition would be a file of two rows. ``order``: the column that
    rows are in descending order of, and the one that decides ties.
    """

    build: Callable[[Inputs], DataFrame]
    by_day: bool = False
    few_rows_per_time: bool = False
    order: tuple[str, str] | None = None

    def partitioned(self, grain: str) -> bool:
        return self.by_day and not (self.few_rows_per_time and grain == "day")


DIMENSION_TABLES = {
    "dim_products": MartTable(lambda i: dimensions.dim_products(i.raw["products"])),
    "dim_customers": MartTable(lambda i: dimensions.dim_customers(i.raw["customers"])),
    "dim_employees": MartTable(lambda i: dimensions.dim_employees(i.raw["employees"])),
    "dim_dates": MartTable(lambda i: dimensions.dim_dates(i.raw["sales"])),
    "dim_categories": MartTable(lambda i: dimensions.dim_categories(i.raw["categories"])),
    "dim_locations": MartTable(lambda i: dimensions.dim_locations(i.raw["cities"], i.raw["countries"])),
}

FACT_TABLES = {"fact_sales": MartTable(lambda i: build_fact_sales(i.raw, i.stage), by_day=True)}

KPI_TABLES = {
    "kpi_total_sales_by_date": MartTable(
        lambda i: kpis.total_sales_by_date(i.stored("fact_sales"), i.grain), by_day=True, few_rows_per_time=True
    ),
    "kpi_top_products": MartTable(lambda i: kpis.top_products(i.stored("fact_sales"), i.k), order=("Revenue", "ProductID")),
    "kpi_avg_order_value": MartTable(lambda i: kpis.avg_order_value(i.stored("fact_sales"))),
    "kpi_customer_type_counts": MartTable(
        lambda i: kpis.customer_type_counts(i.stored("fact_sales"), i.grain), by_day=True, few_rows_per_time=True
    ),
    "kpi_price_trends": MartTable(lambda i: kpis.price_trends(i.stored("dim_products"))),
    "kpi_sales_by_employee": MartTable(lambda i: kpis.sales_by_employee(i.stored("fact_sales"))),
    "kpi_employee_daily_sales": MartTable(
        lambda i: kpis.employee_daily_sales(i.stored("fact_sales"), i.grain), by_day=True
    ),
}

TABLES = {**DIMENSION_TABLES, **FACT_TABLES, **KPI_TABLES}


def build_table(
    spark: SparkSession,
    name: str,
    raw: Raw,
    store: MartStore,
    grain: str = "second",
    k: int | None = None,
    ranks: bool = False,
) -> None:
    """Build one table and replace the stored one.

    KPI tables read ``fact_sales`` or ``dim_products`` back from the store, so that
    has to be built first. ``ranks``: a table with an order gets a column ``rank``,
    as the order itself is lost in storage.
    """
    _build(name, Inputs(spark, raw, store, grain, k, ranks=ranks))


def build_mart(
    spark: SparkSession,
    raw: Raw,
    store: MartStore,
    grain: str = "second",
    k: int | None = None,
    concurrent_tables: int = 4,
    ranks: bool = False,
) -> None:
    """Build all 14 tables in one application: dimensions and fact, then KPIs.

    Neither the dimensions nor the fact depend on another mart table, so they are
    submitted together, and the many small tables run in the gaps the large ones
    leave. The fact is stored once. The four revenue tables come from a lattice of
    exact sums, which scans it once for all of them; the other KPIs scan the two or
    three columns they need of it. ``ranks`` as in ``build_table``.
    """
    inputs = Inputs(spark, raw, store, grain, k, ranks=ranks)
    _build_together([*FACT_TABLES, *DIMENSION_TABLES], inputs, concurrent_tables)
    opened = {table: store.read(spark, table) for table in ("fact_sales", "dim_products")}
    inputs = replace(inputs, opened=opened)
    if not isinstance(opened["fact_sales"].schema["TotalPrice"].dataType, DoubleType):
        _build_together(KPI_TABLES, inputs, concurrent_tables)
        return
    area = staging.Area(spark)
    try:
        rest = [name for name in KPI_TABLES if name not in kpis.FROM_LATTICE]
        revenue = partial(_build_from_lattice, inputs, area, concurrent_tables)
        _run_together([revenue, *[partial(_build, name, inputs) for name in rest]], inputs, concurrent_tables)
    finally:
        area.remove()


def _build_from_lattice(inputs: Inputs, area: staging.Area, concurrent_tables: int) -> None:
    """The lattice, then its tables, while the other KPIs are built."""
    lattice = kpis.sales_lattice(inputs.stored("fact_sales"), area.stage_by, inputs.grain)
    _build_together(kpis.FROM_LATTICE, replace(inputs, lattice=lattice), concurrent_tables)


def _build(name: str, inputs: Inputs) -> None:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}; known: {', '.join(TABLES)}")
    table = TABLES[name]
    area = staging.Area(inputs.spark)
    try:
        if inputs.lattice and name in kpis.FROM_LATTICE:
            df = kpis.FROM_LATTICE[name](inputs.lattice, inputs.k)
        else:
            df = table.build(replace(inputs, stage=area.stage))
        if inputs.ranks and table.order:
            df = with_rank(df, *table.order, area.stage)
        inputs.store.write(df, name, table.partitioned(inputs.grain))
    finally:
        area.remove()


def _build_together(names: Iterable[str], inputs: Inputs, concurrent_tables: int) -> None:
    _run_together([partial(_build, name, inputs) for name in names], inputs, concurrent_tables)


def _run_together(jobs: Iterable[Callable[[], None]], inputs: Inputs, concurrent_tables: int) -> None:
    with ThreadPoolExecutor(max_workers=concurrent_tables) as pool:
        jobs = [pool.submit(inheritable_thread_target(inputs.spark)(job)) for job in jobs]
        for done in wait(jobs, return_when=FIRST_EXCEPTION).done:
            if done.exception():
                pool.shutdown(wait=False, cancel_futures=True)
                raise done.exception()
