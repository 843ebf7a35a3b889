"""Tables as versioned folders with commit records, for stores on which renaming is not atomic.

Layout of a table: ``data-<id>/`` per write and ``_commits/<number>`` per published version, whose content names the data folder and has the schema, so that
a table without rows can be read too. A
writer fills a new folder and then puts the next record, only if no record of that number exists. That one put publishes the
whole table, or nothing. A reader takes the record with the highest number and scans the folder it names, so it never sees a table
half replaced, nor none. No file is renamed or changed after it was written.

Two writers may want the same number; the one that comes second takes the next, so the last to commit wins and neither is lost. An empty record belongs
to a writer that has not finished or died in the act; readers pass it over.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from salesmart.sinks.files import _file_system, remove_folder

_DIGITS = 12
_DATA = "data-"


class NoVersionError(LookupError):
    """A table that was never published."""


def put_if_absent(spark: SparkSession, path: str, content: str) -> bool:
    """Create a small file unless it exists; whether it was created.

    Hadoop's file systems create without overwriting in one step, but for the local one, which looks first; there the
    operating system does.
    """
    system, target = _file_system(spark, path)
    if system.getUri().getScheme() == "file":
        try:
            with open(target.toUri().getPath(), "x") as file:
                file.write(content)
        except FileExistsError:
            return False
        return True
    try:
        stream = system.create(target, False)
    except Exception as error:  # whichever class the store's client raises
        if system.exists(target):
            return False
        raise error
    try:
        stream.write(bytearray(content.encode()))
    finally:
        stream.close()
    return True


class Versions:
    """The published versions of one table under ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark, self._root = spark, root.rstrip("/")

    def _path(self, number: int) -> str:
        return f"{self._root}/_commits/{number:0{_DIGITS}d}"

    def _numbers(self) -> list[int]:
        """All record numbers, the highest first."""
        system, folder = _file_system(self._spark, f"{self._root}/_commits")
        if not system.exists(folder):
            return []
        names = [status.getPath().getName() for status in system.listStatus(folder)]
        return sorted((int(name) for name in names if name.isdigit()), reverse=True)

    def _named(self, number: int) -> str | None:
        """The data folder that a record names."""
        record = self._record(number)
        return record and record[0]

    def _record(self, number: int) -> tuple[str, str] | None:
        """Data folder and schema of a record; None for an empty one, or one collected meanwhile."""
        system, path = _file_system(self._spark, self._path(number))
        if not system.exists(path):
            return None
        size = system.getFileStatus(path).getLen()
        if not size:
            return None
        stream = system.open(path)
        try:
            content = self._spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        name, _, schema = content.partition("\n")
        return (name, schema) if name.startswith(_DATA) else None

    def published(self, keep: int = 1) -> list[tuple[int, str]]:
        """(number, data folder) of the last ``keep`` published versions, the latest first."""
        found: list[tuple[int, str]] = []
        for number in self._numbers():
            name = self._named(number)
            if name:
                found.append((number, f"{self._root}/{name}"))
            if len(found) == keep:
                break
        return found

    def current(self) -> tuple[str, str]:
        """Data folder and schema (JSON, or empty) of the latest version. A collector may take a version between listing and reading;
        then it is looked up again."""
        for _ in range(5):
            numbers = self._numbers()
            for record in map(self._record, numbers):
                if record:
                    return f"{self._root}/{record[0]}", record[1]
            if not numbers:
                break
        raise NoVersionError(f"no published version of {self._root}")

    def publish(self, write: Callable[[str], None], schema: str = "", keep: int = 2, orphan_hours: float = 24.0) -> int:
        """Let ``write`` fill a new data folder, make it the current version, and collect old ones; its number.

        If the write fails the folder is removed and the former version stays. ``keep`` versions stay readable, so a query that began
        before ``keep`` further writes still finds its files.
        """
        name = f"{_DATA}{uuid.uuid4().hex}"
        folder = f"{self._root}/{name}"
        try:
            write(folder)
            system, commits = _file_system(self._spark, f"{self._root}/_commits")
            system.mkdirs(commits)
            number = next(iter(self._numbers()), 0) + 1
            while not put_if_absent(self._spark, self._path(number), f"{name}\n{schema}"):
                number += 1
        except BaseException:
            remove_folder(self._spark, folder)
            raise
        self.collect(keep, orphan_hours)
        return number

    def collect(self, keep: int = 2, orphan_hours: float = 24.0) -> None:
        """Remove all but the last ``keep`` versions, and folders that no record names if they are older than ``orphan_hours``.

        Records go before the folders they name, so no record ever points to a folder that is being removed.
        """
        kept = self.published(max(1, keep))
        if not kept:
            return
        oldest = kept[-1][0]
        dropped = set()
        for number in self._numbers():
            if number < oldest:
                name = self._named(number)
                if name:
                    dropped.add(f"{self._root}/{name}")
                remove_folder(self._spark, self._path(number))
        for folder in dropped:
            remove_folder(self._spark, folder)
        named = {os.path.basename(folder) for _, folder in kept}
        system, root = _file_system(self._spark, self._root)
        for status in system.listStatus(root):
            name = status.getPath().getName()
            age = time.time() - status.getModificationTime() / 1000
            if name.startswith(_DATA) and name not in named and age > orphan_hours * 3600:
                still = {os.path.basename(f) for _, f in self.published(keep + 1000)}
                if name not in still:
                    system.delete(status.getPath(), True)
