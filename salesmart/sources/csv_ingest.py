"""CSV files to typed Parquet tables, as Spark jobs.

Every CSV file is split over the cluster and converted in one pass. Columns of
the seven raw tables get their declared types; any other column is kept too, with
a type inferred from all its values.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from salesmart.sinks.files import replace_folder
from salesmart.sinks.staging import Area
from salesmart.sources.csv_records import csv_records
from salesmart.sources.schemas import NANO_COLUMNS, RAW_DDL, raw_schema

# Spellings that stand for null in columns that are not text.
NULL_SPELLINGS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
]

# SQL that turns text into a value, or into null where it does not fit.
# "nanos" is a bigint of epoch nanoseconds: a number, or a date or timestamp, which
# is read as UTC unless it names a zone. Spark timestamps end at microseconds, so
# digits seven to nine of the fraction are added back.
PARSERS = {
    "bigint": "try_cast({text} AS bigint)",
    "boolean": "IF(lower({text}) IN ('true', 'false'), try_cast({text} AS boolean), NULL)",
    "date": "IF({text} RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$', try_cast({text} AS date), NULL)",
    "timestamp_ntz": "IF({text} RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}', try_cast({text} AS timestamp_ntz), NULL)",
    # The cast alone would also take Java's type suffixes, as in "10d".
    "double": "IF({text} RLIKE '[0-9.][dDfF]$', NULL, try_cast({text} AS double))",
    # A cast that fails costs some 20 times one that fits, so each spelling goes straight to the cast that takes it.
    "nanos": (
        "IF({text} RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}',"
        " try_add(try_multiply(unix_micros(CASE WHEN length({text}) = 10 THEN try_cast({text} || ' 00:00:00Z' AS timestamp)"
        " WHEN {text} RLIKE '(Z|[+-][0-9]{{2}}:?[0-9]{{2}})$' THEN try_cast({text} AS timestamp)"
        " ELSE coalesce(try_cast({text} || 'Z' AS timestamp), try_cast({text} || ' 00:00:00Z' AS timestamp)) END), 1000),"
        " CAST(rpad(regexp_extract({text}, '[.][0-9]{{6}}([0-9]{{1,3}})', 1), 3, '0') AS bigint)),"
        " try_cast({text} AS bigint))"
    ),
}

# Candidate types of an undeclared column, in order of preference; text if none fits.
INFERRED_TYPES = ("bigint", "boolean", "date", "timestamp_ntz", "double")

_MALFORMED = "_malformed_row"


def csv_tables(spark: SparkSession, folder: str) -> dict[str, str]:
    """Table name to path of every ``*.csv`` directly in ``folder``.

    An entry may be one file or a directory of part files. Only names are listed.
    """
    folder = folder.rstrip("/")
    names = (
        spark.read.format("binaryFile")
        .load(f"{folder}/*.csv")
        .select(F.regexp_extract("path", r"/([^/]+)\.csv(?:/[^/]*)?$", 1).alias("name"))
        .distinct()
    )
    return {row["name"]: f"{folder}/{row['name']}.csv" for row in names.orderBy("name").collect()}


@dataclass(frozen=True)
class CsvOptions:
    """``strict``: the first misfit or malformed row fails the job, and so does a declared column that the header lacks.
    Without it misfits become null and are counted. ``allow_absent``: such columns read as null, also when strict.
    ``multiline``: quoted values may hold line breaks. Files are split all the same (see ``csv_records``), for one more scan of their text, two where pieces are long.
    ``types``: per table, types of columns that are not declared (``bigint``, ``boolean``, ``date``, ``timestamp_ntz``,
    ``double``, ``nanos`` or ``string``), which saves the pass that infers them."""

    strict: bool = True
    allow_absent: bool = False
    multiline: bool = False
    types: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    concurrent_tables: int = 4


def csv_to_parquet(
    spark: SparkSession, folder: str, target: str | None = None, options: CsvOptions = CsvOptions()
) -> dict[str, dict[str, int]]:
    """Convert every ``<table>.csv`` in ``folder`` to ``<table>.parquet`` beside it or in ``target``.

    Returns, per table, the rows written and the values that did not fit, counted
    during the write: without ``strict`` a misfit is counted under its column name, a row with too few or too
    many fields as ``malformed``, and declared columns that the header lacks as ``absent``. A table that fails
    keeps its former Parquet folder. All part files of a table must have the same header.
    """
    target = (target or folder).rstrip("/")
    tables = csv_tables(spark, folder)
    run = inheritable_thread_target(spark)(convert_csv)
    with ThreadPoolExecutor(max_workers=options.concurrent_tables) as pool:
        jobs = [
            pool.submit(run, spark, table, path, f"{target}/{table}.parquet", options) for table, path in tables.items()
        ]
        return {table: job.result() for table, job in zip(tables, jobs, strict=True)}


def convert_csv(
    spark: SparkSession, table: str, path: str, target: str, options: CsvOptions = CsvOptions()
) -> dict[str, int]:
    """Convert one CSV table. See ``csv_to_parquet``."""
    area = Area(spark)
    try:
        return _convert(spark, table, path, target, options, area)
    finally:
        area.remove()


def _convert(
    spark: SparkSession, table: str, path: str, target: str, options: CsvOptions, area: Area
) -> dict[str, int]:
    strict = options.strict
    header, text = _read_text(spark, path, options, area)
    absent = _absent(table, header)
    if absent and strict and not options.allow_absent:
        raise ValueError(f"{table}: the header lacks {', '.join(absent)}")
    columns = _columns(table, header, text, options.types.get(table, {}))
    typed = {i: name for i, (name, kind) in enumerate(columns) if kind != "string"}

    # Each value is parsed once, beside its text; a misfit has text but no value.
    blanked = text.selectExpr(_MALFORMED, *[_column_text(i, kind) for i, (_, kind) in enumerate(columns)])
    parsed = blanked.selectExpr("*", *[f"{_parser(f'c{i}', columns[i][1])} AS v{i}" for i in typed])
    counts = Observation()
    counted = parsed.observe(
        counts,
        F.expr("count(1)").alias("rows"),
        F.expr(f"count({_MALFORMED})").alias("malformed"),
        *[F.expr(f"count_if(c{i} IS NOT NULL AND v{i} IS NULL)").alias(f"bad{i}") for i in typed],
    )
    made = counted.selectExpr(*[_output(table, i, name, i in typed, strict) for i, (name, _) in enumerate(columns)])
    replace_folder(spark, target, made.write.parquet)

    found = counts.get
    if strict:
        return {"rows": found["rows"]}
    return {
        "rows": found["rows"],
        "malformed": found["malformed"],
        **({"absent": len(absent)} if absent else {}),
        **{name: found[f"bad{i}"] for i, name in typed.items()},
    }


def _absent(table: str, header: list[str]) -> list[str]:
    """Declared columns of the table that are not in the header."""
    given = {name.lower() for name in header}
    return [f.name for f in raw_schema(table) if f.name.lower() not in given] if table in RAW_DDL else []


def _read_text(spark: SparkSession, path: str, options: CsvOptions, area: Area) -> tuple[list[str], DataFrame]:
    """The header, and all columns as text named c0, c1, …; empty fields are null."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", options.multiline)
    header = reader.csv(path).columns
    parsing = {
        "emptyValue": "",
        "mode": "FAILFAST" if options.strict else "PERMISSIVE",
        "columnNameOfCorruptRecord": _MALFORMED,
    }
    fields = [StructField(name, StringType()) for name in [*header, _MALFORMED]]
    if options.multiline:
        return header, _parsed_records(csv_records(spark, path, area), header, parsing)
    text = (
        reader.option("enforceSchema", False)  # compares every file's header
        .options(**parsing)
        .schema(StructType(fields))
        .csv(path)
    )
    return header, text.toDF(*[f"c{i}" for i in range(len(header))], _MALFORMED)


def _parsed_records(records: DataFrame, header: list[str], parsing: Mapping[str, str]) -> DataFrame:
    """The columns of records that were put together before; every file's first record must be the header."""
    names = [*[f"c{i}" for i in range(len(header))], _MALFORMED]
    options = {**parsing, "escape": '"', "multiLine": "true", "lineSep": "\n"}
    fields = F.from_csv("text", ", ".join(f"{name} STRING" for name in names), options)
    parsed = records.select("first", fields.alias("fields")).select("first", "fields.*")
    other = F.lit(False)
    for i, name in enumerate(header):
        other = other | ~F.lower(f"c{i}").eqNullSafe(F.lit(name.lower()))
    failed = F.raise_error(F.lit("CSV header does not conform to that of the first file")).cast("boolean")
    is_row = F.when(F.col("first"), F.when(other | F.col(_MALFORMED).isNotNull(), failed).otherwise(False)).otherwise(True)
    return parsed.where(is_row).drop("first")


def _columns(table: str, header: list[str], text: DataFrame, given: Mapping[str, str]) -> list[tuple[str, str]]:
    """Name and type of every column. Declared names win over the header's case."""
    known = {name.lower(): (name, kind) for name, kind in given.items()}
    if table in RAW_DDL:
        nanos = NANO_COLUMNS.get(table, set())
        known |= {
            field.name.lower(): (field.name, "nanos" if field.name in nanos else field.dataType.simpleString())
            for field in raw_schema(table)
        }
    inferred = _infer(text, [i for i, name in enumerate(header) if name.lower() not in known])
    return [known.get(name.lower()) or (name, inferred[i]) for i, name in enumerate(header)]


def _infer(text: DataFrame, positions: list[int]) -> dict[int, str]:
    """The first candidate type that fits every value of a column, in one aggregation to one row."""
    if not positions:
        return {}
    blanked = text.selectExpr(*[_column_text(i, "any") for i in positions])
    fits = [f"count({_parser(f'c{i}', kind)}) AS {kind}_{i}" for i in positions for kind in INFERRED_TYPES]
    found = blanked.selectExpr(*[f"count(c{i}) AS present_{i}" for i in positions], *fits).first()
    return {
        i: next((kind for kind in INFERRED_TYPES if 0 < found[f"present_{i}"] == found[f"{kind}_{i}"]), "string")
        for i in positions
    }


def _column_text(position: int, kind: str) -> str:
    """A column's text. Null spellings count as null, except in text, where an empty field is empty text."""
    column = f"c{position}"
    if kind == "string":
        return f"coalesce({column}, '') AS {column}"
    spellings = ", ".join(f"'{spelling}'" for spelling in NULL_SPELLINGS)
    return f"IF({column} IN ({spellings}), NULL, {column}) AS {column}"


def _parser(text: str, kind: str) -> str:
    return PARSERS[kind].format(text=text)


def _output(table: str, position: int, name: str, typed: bool, strict: bool) -> str:
    text, value = f"c{position}", f"v{position}" if typed else f"c{position}"
    if typed and strict:
        message = f"{table}.{name}: bad value ".replace("'", "")
        value = f"IF({text} IS NOT NULL AND {value} IS NULL, raise_error('{message}' || {text}), {value})"
    return f"{value} AS `{name.replace('`', '``')}`"
