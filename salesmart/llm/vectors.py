"""Vectors as numpy arrays, and copies of vectors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not zero, all components finite."""
    values = vector.cast("array<double>")
    finite = F.forall(values, lambda x: F.coalesce((F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x), F.lit(False)))
    return F.coalesce(finite & F.exists(values, lambda x: x != 0), F.lit(False))


def vector_key(vector: Column) -> Column:
    """A digest of the exact components."""
    return F.sha2(F.concat_ws(",", vector.cast("array<string>")), 256)


def matrix(column) -> np.ndarray:
    """A pandas column of arrays as one float64 matrix."""
    return np.array([np.asarray(v, dtype=np.float64) for v in column])


def dimension_of(df: DataFrame, column: str) -> int | None:
    """The length of the vectors; None for an empty table. Vectors of different lengths are an error."""
    row = df.agg(F.min(F.size(column)).alias("low"), F.max(F.size(column)).alias("high")).first()
    if row["low"] != row["high"]:
        raise ValueError(f"vectors of {row['low']} to {row['high']} components in one table")
    return row["low"]
