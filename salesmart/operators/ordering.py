"""Sorts, and ranks that outlive them."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.sinks.staging import Stage, stage

# monotonically_increasing_id counts rows in its lower 33 bits and partitions above them.
_ROW_BITS = 33


def ranked(df: DataFrame, by: str, tie: str, k: int | None = None) -> DataFrame:
    """Rows from the largest ``by`` down, nulls last, ties in ``tie`` order.

    Without ``k`` this is a range-partitioned sort. With ``k`` each task keeps its
    own first k rows, and only those are merged.
    """
    ordered = df.orderBy(F.desc_nulls_last(by), F.asc_nulls_last(tie))
    return ordered if k is None else ordered.limit(k)


def with_rank(
    df: DataFrame, by: str, tie: str, stage: Stage = stage, name: str = "rank", partitions: int | None = None
) -> DataFrame:
    """Adds the place of each row in the order of ``ranked``, from 1, without gaps and each once.

    Rows are sorted by range, and each takes the number of rows in the partitions before its own, plus its place there.
    The sorted rows are staged, so that partitions and their counts belong together whatever is computed again; only
    one count per partition goes to the driver. Rows equal in both columns are ranked in any order.
    ``partitions`` is the number of ranges, which bounds the rows that one task sorts; without it the session decides.
    """
    place = F.monotonically_increasing_id()
    order = [F.desc_nulls_last(by), F.asc_nulls_last(tie)]
    sorted_rows = df.repartitionByRange(partitions, *order).sortWithinPartitions(*order) if partitions else ranked(df, by, tie)
    ordered = stage(sorted_rows.withColumn(name, place), "ranked")
    part = F.shiftright(name, _ROW_BITS)
    counts = ordered.groupBy(part.alias("part")).count().orderBy("part").collect()
    before = accumulate((row["count"] for row in counts), initial=0)
    offsets = [(row["part"], rows) for row, rows in zip(counts, before, strict=False)]
    offset = F.broadcast(df.sparkSession.createDataFrame(offsets, "_part bigint, _before bigint"))
    within = F.col(name).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    placed = ordered.join(offset, part == F.col("_part"))
    return placed.withColumn(name, F.col("_before") + within + 1).drop("_part", "_before")
