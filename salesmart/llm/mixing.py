"""Mixing sources to target weights by capped water-filling.

A mix gives every source a share of a word budget in proportion to its weight. No
source may be repeated more than ``max_epochs`` times: a source that would be is
clamped there, and what it leaves over is shared among the others by weight, until
none is above its limit. That ends in one water level: each source gets
``weight * level`` or its limit, whichever is less.

Documents are then taken as whole repetitions of the source, plus a seeded part of
it for the fraction. The part is the front of the source in the order of a seeded
hash. Only the hash bucket in which the part ends is ever sorted; a source that
holds a third of the corpus is summed by bucket first. The document in which the
part ends is taken up to the word that meets the target.

Everything here is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.words import word_count
from salesmart.sinks.staging import stage

# Names of working columns, which must not clash with columns of the documents.
_ID, _SOURCE, _ORDER, _BUCKET, _ROW = "mix_id", "mix_source", "mix_order", "mix_bucket", "mix_row"


@dataclass(frozen=True)
class MixSettings:
    """``budget``: words to take as a share of all words. ``weights``: given to the sources in
    the order of their names by code point, null last, and repeating. ``buckets``: parts of a
    source whose sizes are summed before one of them is sorted."""

    budget: float = 1.5
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    max_epochs: float = 2.0
    seed: int = 42
    buckets: int = 4096


def water_levels(sizes: DataFrame, settings: MixSettings) -> DataFrame:
    """Target per source. ``sizes`` has one row per source: mix_source, source_size.

    The source that fills up first is the one with the smallest limit per weight. With the
    sources in that order, the level that holds after the first j are full is what is left of
    the budget over the weights of the rest; the first level that fills no further source is
    the answer. The windows run over one row per source.
    """
    named = Window.orderBy(F.col(_SOURCE).asc_nulls_last())
    filling = Window.orderBy("fills_at", F.col(_SOURCE).asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weights = F.array(*[F.lit(float(w)) for w in settings.weights])
    turn = ((F.row_number().over(named) - 1) % len(settings.weights)) + 1
    levels = (
        sizes.withColumn("weight", F.element_at(weights, turn))
        .withColumn("limit", F.col("source_size") * F.lit(float(settings.max_epochs)))
        .withColumn("fills_at", F.col("limit") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(settings.budget)))
        .withColumn("full", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn(
            "open_weight",
            F.sum("weight").over(filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
        )
        .withColumn("level", (F.col("budget") - F.col("full")) / F.col("open_weight"))
        .withColumn("place", F.row_number().over(filling))
        .withColumn(
            "level",
            F.min_by("level", F.when(F.col("level") <= F.col("fills_at"), F.col("place"))).over(everything),
        )
    )
    target = F.least(F.col("limit"), F.col("weight") * F.coalesce("level", "fills_at"))
    return levels.select(_SOURCE, "source_size", "weight", target.alias("target"))


def mix_plan(
    docs: DataFrame, settings: MixSettings = MixSettings(), id_column: str = "doc_id", source_column: str = "source"
) -> DataFrame:
    """How many words the mix takes of each document.

    Returns one row per input row: the id under its own name, ``source``, ``size`` (words),
    ``source_size``, ``target`` (of the source), ``whole`` (times the whole document is taken)
    and ``part`` (words of one further, unfinished repetition); words taken are
    ``whole * size + part``. Reruns agree: the order is a hash of id and text.

    Null or empty texts have size 0 and nothing is taken of them. A null source is a source
    of its own. Repeated rows are separate rows, taken one after another. An empty table gives
    an empty plan. Columns of ``docs`` other than id, source and text are not looked at.
    """
    measured = stage(docs.select(*_measures(settings, id_column, source_column)), "mix-sizes")
    columns = [
        F.col(_ID).alias(id_column), F.col(_SOURCE).alias(source_column), "size", "source_size", "target", "whole", "part"
    ]
    return _with_parts(measured, measured, settings).select(*columns)


def _measures(settings: MixSettings, id_column: str, source_column: str) -> list[Column]:
    """What the plan needs of a document."""
    order = F.xxhash64(F.lit(settings.seed), F.col(id_column), F.col("text"))
    return [
        F.col(id_column).alias(_ID),
        F.col(source_column).alias(_SOURCE),
        word_count(F.col("text")).alias("size"),
        order.alias(_ORDER),
        F.pmod(F.shiftrightunsigned(order, 20), F.lit(settings.buckets)).alias(_BUCKET),
    ]


def _with_parts(rows: DataFrame, measured: DataFrame, settings: MixSettings) -> DataFrame:
    """``rows``, which hold the columns of ``measured`` for the same documents, with source_size, target, whole and part."""
    buckets = stage(measured.groupBy(_SOURCE, _BUCKET).agg(F.sum("size").alias("bucket_size")), "mix-buckets")
    targets = water_levels(buckets.groupBy(_SOURCE).agg(F.sum("bucket_size").alias("source_size")), settings)
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = targets.withColumn("whole", F.floor(epochs)).withColumn(
        "wanted", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("bigint")
    )

    # What is wanted of each bucket: all, nothing, or in one bucket per source a part.
    earlier = Window.partitionBy(_SOURCE).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.withColumn("start", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)))
    shares = stage(
        starts.join(targets, starts[_SOURCE].eqNullSafe(targets[_SOURCE]))
        .drop(targets[_SOURCE])
        .withColumn("wanted", F.greatest(F.lit(0), F.least(F.col("wanted") - F.col("start"), F.col("bucket_size"))))
        .select(_SOURCE, _BUCKET, "source_size", "target", "whole", "wanted", "bucket_size"),
        "mix-shares",
    )
    cut = (F.col("wanted") > 0) & (F.col("wanted") < F.col("bucket_size"))
    joined = _with_shares(rows, shares.where(~cut))
    settled = joined.withColumn("part", F.when(F.col("wanted") > 0, F.col("size")).otherwise(F.lit(0)))
    in_order = Window.partitionBy(_SOURCE, _BUCKET).orderBy(_ORDER, _ID, "size").rowsBetween(Window.unboundedPreceding, -1)
    split = _with_shares(rows, shares.where(cut)).withColumn(
        "part",
        F.greatest(
            F.lit(0), F.least(F.col("size"), F.col("wanted") - F.coalesce(F.sum("size").over(in_order), F.lit(0)))
        ),
    )
    return settled.unionByName(split)


def _with_shares(rows: DataFrame, shares: DataFrame) -> DataFrame:
    same = rows[_SOURCE].eqNullSafe(shares[_SOURCE]) & (rows[_BUCKET] == shares[_BUCKET])
    return rows.join(shares, same).drop(shares[_SOURCE], shares[_BUCKET])


def taken_words(whole: Column, part: Column, size: Column) -> Column:
    """Words taken of a document, repetitions counted."""
    return (whole * size + part).cast("bigint")


def mix_documents(docs: DataFrame, settings: MixSettings = MixSettings(), id_column: str = "doc_id") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the plan takes it whole, all columns kept.

    The one document per source of which only a part is wanted comes out whole if at least
    half of it is. The plan is made on the rows themselves, so null and repeated ids are rows like others.
    """
    measures = _measures(settings, id_column, "source")
    measured = stage(docs.select(*measures), "mix-sizes")
    planned = _with_parts(docs.select(F.struct("*").alias(_ROW), *measures), measured, settings)
    times = F.col("whole") + F.when((F.col("part") > 0) & (F.col("part") * 2 >= F.col("size")), 1).otherwise(0)
    return (
        planned.select(_ROW, times.cast("int").alias("times"))
        .where("times > 0")
        .select(_ROW, F.explode(F.sequence(F.lit(1), F.col("times"))))
        .select(f"{_ROW}.*")
    )
