"""Sums from a lattice of stored aggregates, and how often the fact is scanned for them."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from salesmart.operators.lattice import Lattice, nodes_of
from salesmart.plans import kpis, mart
from salesmart.sinks.staging import Area
from salesmart.sinks.store import MartStore
from checks import testbed
from tests.test_plans import plan

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    draw = random.Random(3)
    rows = [
        (draw.choice([None, 1, 2, 3]), draw.choice([None, 7, 8]), draw.randint(0, 400_000), draw.choice([None, round(draw.uniform(-9e4, 9e4), 2)]))
        for _ in range(3000)
    ]
    path = str(tmp_path_factory.mktemp("lattice") / "fact")
    df = spark.createDataFrame(rows, "EmployeeID int, ProductID int, at int, TotalPrice double")
    df.withColumn("SalesTimestamp", F.timestamp_seconds(F.when(F.col("at") > 999, F.col("at")))).repartition(5).write.parquet(path)
    return spark.read.parquet(path)


def brute(stored, keys, grain):
    out = {}
    for r in stored.collect():
        at = r["SalesTimestamp"]
        at = at and (at.replace(hour=0, minute=0, second=0) if grain == "day" else at)
        found = out.setdefault(tuple(at if k == "SalesTimestamp" else r[k] for k in keys), [])
        if r["TotalPrice"] is not None:
            found.append(r["TotalPrice"])
    return {k: math.fsum(v) if v else None for k, v in out.items()}


@pytest.mark.parametrize("grain", ["second", "day"])
def test_every_sum_is_exact(spark, stored, grain):
    lattice = kpis.sales_lattice(stored, Area(spark).stage_by, grain)
    for keys in (["SalesTimestamp"], ["ProductID"], ["EmployeeID"], ["EmployeeID", "SalesTimestamp"]):
        found = {tuple(r)[:-1]: r["s"] for r in lattice.sums(keys, "s").collect()}
        assert found == brute(stored, keys, grain)


@pytest.mark.parametrize("grain", ["second", "day"])
def test_one_scan_of_the_fact_feeds_all_four(spark, stored, grain):
    scans = []

    def keep(df, name, column):
        scans.append(plan(df).count("FileScan parquet [EmployeeID,ProductID,TotalPrice,SalesTimestamp]"))
        return area.stage_by(df, name, column)

    area = Area(spark)
    lattice = kpis.sales_lattice(stored, keep, grain)
    assert sum(scans) == 1
    for name, build in kpis.FROM_LATTICE.items():
        text = plan(build(lattice, None))
        assert "fact" not in re.sub(r"PushedFilters.*", "", text).replace("functions", "") and text.count("FileScan") == 1, name
        assert "PartitionFilters: [isnotnull(node)" in text


def test_the_smallest_parent_is_taken(spark, stored):
    area = Area(spark)
    rows = stored.select("EmployeeID", "ProductID", "SalesTimestamp", "TotalPrice")
    lattice = Lattice.build(rows, "TotalPrice", [("EmployeeID", "ProductID", "SalesTimestamp")], [("EmployeeID", "ProductID")], area.stage_by)
    assert lattice.parent(("EmployeeID",)) == ("EmployeeID", "ProductID")
    assert lattice.parent(("SalesTimestamp",)) == ("EmployeeID", "ProductID", "SalesTimestamp")
    with pytest.raises(ValueError, match="no stored node"):
        lattice.parent(("CustomerID",))
    area.remove()


def test_nodes_of_several_sets_share_one_shuffle(stored):
    text = plan(nodes_of(stored, [("EmployeeID",), ("ProductID",)], "TotalPrice"))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and "Expand" in text


@pytest.mark.parametrize("grain", ["second", "day"])
def test_a_build_takes_the_four_tables_from_the_lattice(spark, tmp_path, monkeypatch, grain):
    """None of the four reads the fact, and what the lattice stored is gone after the build."""

    def refuse(*_):
        raise AssertionError("the fact was read for this table")

    for name in kpis.FROM_LATTICE:
        monkeypatch.setitem(mart.KPI_TABLES, name, mart.MartTable(refuse, by_day=mart.TABLES[name].by_day, few_rows_per_time=True))
        monkeypatch.setitem(mart.TABLES, name, mart.KPI_TABLES[name])
    shared = __import__("pathlib").Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    store = MartStore.files(str(tmp_path))
    mart.build_mart(spark, testbed.RawTables(spark, SF), store, grain)
    assert set(shared.iterdir()) == before
    fact = store.read(spark, "fact_sales")
    direct = kpis.employee_daily_sales(fact, grain, exact=True)
    assert sorted(map(str, store.read(spark, "kpi_employee_daily_sales").collect())) == sorted(map(str, direct.collect()))
