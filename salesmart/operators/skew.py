"""Left joins on keys of which few hold many rows, planned from a sketch of the keys.

A frequent-items sketch (counters as in Misra and Gries, built per map task and merged) finds the heavy keys of the facts in one pass over
one column. Facts with a null key match nothing and facts with a heavy key meet at most one row per key of a table with a fixed bound,
which is broadcast, so neither is shuffled. The rest has no large key left and is sort-merge joined. None of this relies on adaptive execution.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.operators.joins import left_match, left_match_as, left_match_copies


@dataclass(frozen=True)
class SkewSettings:
    """``heavy``: share of the rows from which a key is heavy; at most ``keys`` keys are, and ``tracked`` counters find them. ``worth``: share
    of null and heavy rows from which it pays to read the facts twice. A heavy key with more than ``copies`` dimension rows is not
    broadcast, as its output would then be made by the tasks that read the facts."""

    heavy: float = 0.001
    keys: int = 1000
    tracked: int = 10_000
    worth: float = 0.1
    copies: int = 100


@dataclass(frozen=True)
class KeyProfile:
    """What a column of keys holds: ``heavy`` maps keys to about how many rows they have."""

    rows: int
    nulls: int
    heavy: dict[Any, int]

    @property
    def spared(self) -> float:
        """The share of rows that need not be shuffled."""
        return (self.nulls + sum(self.heavy.values())) / self.rows if self.rows else 0.0


def key_profile(facts: DataFrame, key: str, settings: SkewSettings = SkewSettings()) -> KeyProfile:
    """One aggregation to one row; its state is bounded by ``tracked``, whatever the table's size."""
    top = F.call_function("approx_top_k", F.col(key), F.lit(settings.keys), F.lit(settings.tracked))
    row = facts.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(key).isNull()).alias("nulls"), top.alias("top")).first()
    least = max(2, settings.heavy * row["rows"])
    heavy = {r["item"]: r["count"] for r in row["top"] or () if r["item"] is not None and r["count"] >= least}
    return KeyProfile(row["rows"], row["nulls"], heavy)


def is_broadcast(side: DataFrame) -> bool:
    """Whether the planner's size estimate is under its broadcast threshold."""
    threshold = side.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    estimate = side._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(estimate)) <= threshold


def _copies(dimension: DataFrame, key: str, heavy: list, settings: SkewSettings) -> dict[Any, int]:
    """How often each of the heavy keys occurs, 0 where it does not; at most one row per heavy key goes to the driver."""
    found = dimension.where(F.col(key).isin(heavy)).groupBy(key).agg(F.count(F.lit(1)).alias("copies")).collect()
    return dict.fromkeys(heavy, 0) | {r[key]: r["copies"] for r in found}


def left_match_skewed(
    facts: DataFrame, dimension: DataFrame, fact_key: str, key: str, keep_key: bool = False, settings: SkewSettings = SkewSettings()
) -> DataFrame:
    """``left_match``, or with ``keep_key`` ``left_match_as``, that shuffles neither null nor heavy keys.

    Where these are less than ``worth`` of the rows, it is the plain join. Equal keys of both sides must have one type.
    """
    profile = key_profile(facts, fact_key, settings)
    copies = _copies(dimension, key, list(profile.heavy), settings) if profile.heavy else {}
    copies = {k: n for k, n in copies.items() if n <= settings.copies}
    spared = profile.nulls + sum(profile.heavy[k] for k in copies)
    if not profile.rows or spared < settings.worth * profile.rows:
        return _plain(facts, dimension, fact_key, key, keep_key)
    column, heavy = F.col(fact_key), list(copies)
    is_heavy: Column = F.coalesce(column.isin(heavy), F.lit(False)) if heavy else F.lit(False)
    aside, rest = facts.where(column.isNull() | is_heavy), facts.where(column.isNotNull() & ~is_heavy)
    others = dimension.where(~F.col(key).isin(heavy)) if heavy else dimension
    kind = facts.schema[fact_key].dataType.simpleString()
    held = facts.sparkSession.createDataFrame([(k, n) for k, n in copies.items() if n], f"`{fact_key}` {kind}, copies bigint")
    if keep_key:
        matched = held.select(F.col(fact_key), F.col(fact_key).alias(key))
        aside = aside.join(F.broadcast(matched), fact_key, "left").select(*facts.columns, key)
    if any(n > 1 for n in copies.values()):
        aside = left_match_copies(aside, F.broadcast(held.where("copies > 1")), fact_key)
    return aside.unionAll(_plain(rest, others, fact_key, key, keep_key).select(*aside.columns))


def _plain(facts: DataFrame, dimension: DataFrame, fact_key: str, key: str, keep_key: bool) -> DataFrame:
    if keep_key:
        return left_match_as(facts, dimension, fact_key, key)
    return left_match(facts, dimension.withColumnRenamed(key, fact_key), fact_key).select(*facts.columns)
