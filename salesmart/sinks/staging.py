"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from salesmart.sinks.files import remove_folder

#: What ``stage`` and ``Area.stage`` are: a table and a name to a scan of the written table.
Stage = Callable[[DataFrame, str], DataFrame]


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.

    Where it is unset, the folder given to ``SparkContext.setCheckpointDir`` is used. Without either, a local
    session gets one temporary folder; on a cluster that would be private to one machine, so it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="salesmart-")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


class Area:
    """Intermediate tables of one job, removed together."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._folder = new_folder(spark, "area")
        self._used = False

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """As the function ``stage``, within this area."""
        self._used = True
        return _written(df, f"{self._folder}/{name}")

    def stage_by(self, df: DataFrame, name: str, column: str) -> DataFrame:
        """As ``stage``, in one folder per value of ``column``, so that a filter on it reads only what it needs."""
        self._used = True
        path = f"{self._folder}/{name}"
        df.write.partitionBy(column).parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        if self._used:
            remove_folder(self._spark, self._folder)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of it.

    Later stages no longer depend on how ``df`` was made, and the planner sees its
    real size, so that a small result is broadcast and a large one is not.
    """
    return _written(df, new_folder(df.sparkSession, name))


#: Spark's setting that a query's shuffle files are removed as it ends.
_REMOVES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffle_files_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a query, such as ``stage`` runs, go as it ends.

    Otherwise they stay until the driver happens to collect its garbage, and those of many steps may lie on the disks together. The
    session's setting is put back afterwards. Nothing in it should run one DataFrame object twice: it would be shuffled again.
    """
    with _set_to(spark, _REMOVES, "true"):
        yield


#: Spark's limit of the bytes that a Python function gets at once.
_AT_ONCE = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, most: int = 4 << 20) -> Iterator[None]:
    """Within it, a query passes about ``most`` bytes, or one row, to a Python function at once, unless the session sets a limit itself.

    Otherwise it passes 10,000 rows; with whole texts these are many megabytes, held by the JVM and several times over by Python. The
    session's setting is put back afterwards.
    """
    with _set_to(spark, _AT_ONCE, spark.conf.getAll.get(_AT_ONCE, str(most))):
        yield


@contextmanager
def _set_to(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.getAll.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
