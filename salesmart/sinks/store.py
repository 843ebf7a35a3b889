"""Where mart tables are written to and read back from."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from salesmart.sinks.files import replace_folder
from salesmart.sinks.versions import Versions

DAY_COLUMN = "SalesDay"


@dataclass(frozen=True)
class MartStore:
    """Full-overwrite storage for mart tables.

    Use one of the constructors. Partitioned tables get a ``SalesDay``
    column, as partitioning on the timestamp itself would make one directory per
    second; ``read`` drops it again unless asked to keep it for pruning.
    """

    root: str
    catalog: bool = False
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    name_option: str | None = None
    day_options: Mapping[str, str] = field(default_factory=dict)
    keep_versions: int = 0

    @classmethod
    def files(cls, folder: str, format: str = "parquet") -> MartStore:
        """One directory per table under ``folder``."""
        return cls(root=folder.rstrip("/"), format=format)

    @classmethod
    def versioned(cls, folder: str, format: str = "parquet", keep: int = 2) -> MartStore:
        """As ``files``, for object stores: each write is a new folder that one commit record publishes, and the last ``keep`` stay."""
        return cls(root=folder.rstrip("/"), format=format, keep_versions=max(1, keep))

    @classmethod
    def database(cls, database: str, format: str = "parquet") -> MartStore:
        """Managed tables of a catalog database."""
        return cls(root=database, catalog=True, format=format)

    @classmethod
    def connector(
        cls,
        format: str,
        dataset: str,
        options: Mapping[str, str] | None = None,
        name_option: str = "table",
        day_options: Mapping[str, str] | None = None,
    ) -> MartStore:
        """A connector that takes the table's full name as an option.

        ``day_options`` are added for tables partitioned by day, for a warehouse
        that partitions on its own side (no ``SalesDay`` column is written then).
        """
        return cls(dataset, False, format, dict(options or {}), name_option, dict(day_options or {}))

    def write(self, df: DataFrame, table: str, by_day: bool = False) -> None:
        """Replace ``table`` with ``df``, all days of it whatever the session's overwrite mode.

        A folder is replaced after the write has succeeded, so that a failed job keeps the old table.
        """
        own_partitions = by_day and self.name_option is None
        if own_partitions:
            df = partitioned_by_day(df)
        elif by_day:
            df = df.hint("rebalance")
        writer = df.write.mode("overwrite").format(self.format).options(**self.options)
        if own_partitions:
            writer = writer.partitionBy(DAY_COLUMN).option("partitionOverwriteMode", "static")
        if self.catalog:
            writer.saveAsTable(self._name(table))
        elif self.name_option:
            day_options = self.day_options if by_day else {}
            writer.options(**day_options).option(self.name_option, self._name(table)).save()
        elif self.keep_versions:
            Versions(df.sparkSession, self._name(table)).publish(writer.save, df.schema.json(), self.keep_versions)
        else:
            replace_folder(df.sparkSession, self._name(table), writer.save)

    def read(self, spark: SparkSession, table: str, keep_day: bool = False) -> DataFrame:
        """The stored table."""
        if self.catalog:
            df = spark.table(self._name(table))
        else:
            reader = spark.read.format(self.format).options(**self.options)
            if self.name_option:
                df = reader.option(self.name_option, self._name(table)).load()
            elif self.keep_versions:
                folder, schema = Versions(spark, self._name(table)).current()
                df = reader.schema(StructType.fromJson(json.loads(schema))).load(folder)
            else:
                df = reader.load(self._name(table))
        return df if keep_day else df.drop(DAY_COLUMN)

    def _name(self, table: str) -> str:
        return f"{self.root}.{table}" if self.catalog or self.name_option else f"{self.root}/{table}"


def partitioned_by_day(df: DataFrame) -> DataFrame:
    """Add ``SalesDay`` and gather each day's rows for a partitioned write.

    The rebalance hint hashes rows on the day, so a normal day ends up in few
    files. Adaptive execution then merges small days' partitions and splits a day
    that outgrows ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` over several
    tasks, which a plain ``repartition`` on the day cannot do.
    """
    return df.withColumn(DAY_COLUMN, F.to_date("SalesTimestamp")).hint("rebalance", DAY_COLUMN)
