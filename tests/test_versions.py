"""Publishing by commit records: readers beside writers, failed and competing writers, collection of old versions."""

import os
import threading
import time

import pytest
from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from salesmart.cli import parse, store_of
from salesmart.sinks import versions
from salesmart.sinks.store import MartStore
from salesmart.sinks.versions import NoVersionError, Versions, put_if_absent
from tests.frames import facts, values

ROWS = [(1, "2018-01-01 10:00:00", 1.0), (2, None, 3.0), (None, "2018-01-02", 4.0)]


@pytest.fixture(params=["plain", "store"])
def folder(request, spark, tmp_path):
    """A local folder, and the same through a file system that is not the local one."""
    if request.param == "plain":
        return str(tmp_path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    name = f"v{abs(hash(str(tmp_path)))}"
    conf.set(f"fs.viewfs.mounttable.{name}.link./in", f"file://{tmp_path}")
    return f"viewfs://{name}/in"


@pytest.mark.parametrize("by_day", [False, True])
def test_tables_come_back_as_written_and_are_replaced(spark, folder, by_day):
    store = MartStore.versioned(folder)
    df = facts(spark, ROWS)
    for rows in (df, df.where("CustomerID = 1"), df.limit(0)):
        store.write(rows, "fact_sales", by_day=by_day)
        assert values(store.read(spark, "fact_sales")) == values(rows)


def test_a_put_creates_once(spark, folder):
    assert put_if_absent(spark, f"{folder}/record", "first")
    assert not put_if_absent(spark, f"{folder}/record", "second")
    text = spark.read.text(f"{folder}/record").first()[0]
    assert text == "first"


def test_a_failed_write_leaves_the_former_version(spark, tmp_path):
    store = MartStore.versioned(str(tmp_path))
    store.write(facts(spark, ROWS), "t")
    bad = facts(spark, ROWS).withColumn("TotalPrice", F.raise_error(F.lit("broken")).cast("double"))
    with pytest.raises(Exception, match="broken"):
        store.write(bad, "t")
    assert store.read(spark, "t").count() == 3
    assert len(list((tmp_path / "t").glob("data-*"))) == 1
    with pytest.raises(NoVersionError):
        store.read(spark, "never")


def test_a_writer_that_died_in_the_act_is_passed_over(spark, tmp_path):
    store = MartStore.versioned(str(tmp_path))
    store.write(facts(spark, ROWS), "t")
    (tmp_path / "t" / "_commits" / f"{2:012d}").touch()
    assert store.read(spark, "t").count() == 3
    store.write(facts(spark, ROWS[:1]), "t")
    assert store.read(spark, "t").count() == 1
    assert Versions(spark, str(tmp_path / "t")).published(5)[0][0] == 3


def test_a_writer_that_comes_second_takes_the_next_number(spark, tmp_path, monkeypatch):
    """Another commit arrives between listing the records and putting one."""
    table = Versions(spark, str(tmp_path / "t"))
    table.publish(facts(spark, ROWS).write.parquet)
    put, calls = versions.put_if_absent, []

    def late(spark_, path, content):
        if not calls:
            facts(spark, ROWS[:2]).write.parquet(str(tmp_path / "t" / "data-other"))
            put(spark_, path, "data-other")
        calls.append(path)
        return put(spark_, path, content)

    monkeypatch.setattr(versions, "put_if_absent", late)
    assert table.publish(facts(spark, ROWS[:1]).write.parquet, keep=3) == 3
    assert len(calls) == 2 and spark.read.parquet(table.current()[0]).count() == 1
    assert [n for n, _ in table.published(9)] == [3, 2, 1]


def test_old_versions_are_collected(spark, tmp_path):
    store = MartStore.versioned(str(tmp_path), keep=2)
    opened = []
    for i in range(4):
        store.write(facts(spark, ROWS[:1] * (i + 1)), "t")
        opened.append(store.read(spark, "t"))
    assert len(list((tmp_path / "t").glob("data-*"))) == 2 and len(list((tmp_path / "t" / "_commits").glob("0*"))) == 2
    assert [df.count() for df in opened[2:]] == [3, 4]
    orphan, fresh = tmp_path / "t" / "data-dead", tmp_path / "t" / "data-inwork"
    orphan.mkdir()
    fresh.mkdir()
    os.utime(orphan, (time.time() - 90_000,) * 2)
    Versions(spark, str(tmp_path / "t")).collect()
    assert not orphan.exists() and fresh.exists() and store.read(spark, "t").count() == 4


def test_a_reader_beside_a_writer_sees_whole_versions(spark, tmp_path):
    """Version i has i + 1 times 500 rows, all with the value i."""
    store = MartStore.versioned(str(tmp_path), keep=3)

    def version(i):
        return spark.range(500 * (i + 1)).select(F.lit(i).alias("value"))

    store.write(version(0), "t")
    done, failures, seen = threading.Event(), [], set()

    def read():
        while not done.is_set():
            try:
                rows = store.read(spark, "t").groupBy("value").count().collect()
                assert len(rows) == 1 and rows[0]["count"] == 500 * (rows[0]["value"] + 1)
                seen.add(rows[0]["value"])
            except Exception as error:
                failures.append(error)
                return

    reader = threading.Thread(target=inheritable_thread_target(spark)(read))
    reader.start()
    for i in range(1, 7):
        store.write(version(i), "t")
    done.set()
    reader.join()
    assert not failures and seen


def test_competing_writers_all_commit(spark, tmp_path):
    store = MartStore.versioned(str(tmp_path), keep=20)
    threads = [
        threading.Thread(target=inheritable_thread_target(spark)(lambda i=i: store.write(spark.range(i + 1), "t"))) for i in range(6)
    ]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    found = Versions(spark, str(tmp_path / "t")).published(20)
    assert sorted(n for n, _ in found) == list(range(1, 7))
    assert sorted(spark.read.parquet(f).count() for _, f in found) == list(range(1, 7))


def test_the_command_line_makes_a_versioned_store():
    options = parse(["--task", "all", "--raw", "r", "--mart", "m", "--versioned", "4"])
    assert store_of(options) == MartStore.versioned("m", keep=4)
