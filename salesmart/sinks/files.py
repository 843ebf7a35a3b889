"""Whole-folder replacement and removal on any file system that Spark writes to."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    """The path's file system and the path, as Hadoop knows them."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it, if it exists."""
    system, found = _file_system(spark, path)
    system.delete(found, True)


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a file, or any file under a folder that is not hidden, exists. Stops at the first."""
    system, found = _file_system(spark, path)
    if not system.exists(found):
        return False
    files = system.listFiles(found, True)
    while files.hasNext():
        if files.next().getPath().getName()[:1] not in ("_", "."):
            return True
    return False


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a new folder beside ``path``, then put it in the place of ``path``.

    Until the write has succeeded the old folder is untouched, and after a failure it is still there. The
    change itself is two renames, which are cheap on a file system; an object store copies files to
    rename them, and needs a table format instead.
    """
    parent, _, name = path.rstrip("/").rpartition("/")
    tag = uuid.uuid4().hex
    fresh, aside = f"{parent}/_new-{name}-{tag}", f"{parent}/_old-{name}-{tag}"
    try:
        write(fresh)
        system, target = _file_system(spark, path)
        kept = _file_system(spark, aside)[1]
        had_old = system.exists(target)
        if had_old and not system.rename(target, kept):
            raise OSError(f"cannot move {path} aside")
        if not system.rename(_file_system(spark, fresh)[1], target):
            if had_old:
                system.rename(kept, target)
            raise OSError(f"cannot move the new files to {path}")
    except BaseException:
        remove_folder(spark, fresh)
        raise
    remove_folder(spark, aside)
