"""Compares registered queries with their SQL: ``python -m checks.compare [scale] [query …]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES

TESTDATA = "/root/testdata"

# Spark type names by the SQL type they correspond to.
SPARK_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """A connection with every test table as a view."""
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def rows_of(rows: list[tuple], order: list[int]) -> list[tuple]:
    """Rows with columns in the given order, sorted."""
    picked = (tuple(row[i] for i in order) for row in rows)
    return sorted(picked, key=lambda row: [(value is None, str(value)) for value in row])


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs in columns, types, row count or values."""
    cursor = connection.cursor()
    described = cursor.execute(f"DESCRIBE {sql}").fetchall()
    wanted_types = {row[0]: SPARK_TYPES.get(row[1], row[1]) for row in described}
    found_types = dict(df.dtypes)
    if wanted_types != found_types:
        return [f"columns: expected {wanted_types}, found {found_types}"]
    names = sorted(wanted_types)
    wanted = cursor.execute(sql).fetchall()
    found = [tuple(row) for row in df.collect()]
    wanted = rows_of(wanted, [list(wanted_types).index(name) for name in names])
    found = rows_of(found, [df.columns.index(name) for name in names])
    if len(wanted) != len(found):
        return [f"rows: expected {len(wanted)}, found {len(found)}"]
    return [f"expected {w}, found {f}" for w, f in zip(wanted, found, strict=True) if w != f][:3]


def main() -> None:
    scale = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    names = sys.argv[2:] or list(QUERIES)
    sf_dir = f"{TESTDATA}/sf{scale}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        df = QUERIES[name](spark, sf_dir)
        found = differences(df, connection, ORACLE[name]) if name in ORACLE else []
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok':4} {time.time() - start:6.2f}s {name}", *found, sep="\n     ", flush=True)
    print(f"{len(names) - failed} of {len(names)} match; without SQL: {sorted(set(QUERIES) - set(ORACLE))}")
    spark.stop()


if __name__ == "__main__":
    main()
