"""Bounded samples to fit models on."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_STEPS = 1_000_000_007


def hash_sample(df: DataFrame, key: str, size: int, seed: int = 1) -> DataFrame:
    """About ``size`` rows, chosen by a hash of ``key``, which should be near unique; all rows if there are fewer.

    Each row decides by itself, so nothing is sorted or gathered to choose.
    """
    share = min(1.0, size / max(1, df.count()))
    return df.where(F.pmod(F.xxhash64(F.lit(seed), key), F.lit(_STEPS)) < math.ceil(share * _STEPS))


def hash_sample_per(df: DataFrame, key: str, group: str, size: int, seed: int = 1) -> DataFrame:
    """About ``size`` rows in all, as ``hash_sample``, with the same number of each group as far as it has them; what small
    groups leave over goes to the others. ``group`` is text without nulls, of few values."""
    counts = {r[group]: r["count"] for r in df.groupBy(group).count().collect()}
    shares, left = {}, size
    for i, (name, count) in enumerate(sorted(counts.items(), key=lambda c: (c[1], c[0]))):
        part = min(count, left / (len(counts) - i))
        shares[name], left = part / count, left - part
    if not shares:
        return df
    limits = F.create_map(*[F.lit(v) for name, share in shares.items() for v in (name, math.ceil(share * _STEPS))])
    return df.where(F.pmod(F.xxhash64(F.lit(seed), key), F.lit(_STEPS)) < F.element_at(limits, F.col(group)))


def capped_sample(df: DataFrame, key: str, size: int, seed: int = 1) -> DataFrame:
    """As ``hash_sample``, and never more than twice ``size`` rows, whatever the keys: for what goes to the driver."""
    return hash_sample(df, key, size, seed).limit(2 * size)
