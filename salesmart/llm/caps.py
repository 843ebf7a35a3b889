"""Near copies among vectors by spherical-cap filters with structured random product codes.

After a random rotation a vector is cut into blocks, and each block has a small random code of unit
vectors. A filter is one code word per block; its direction is their concatenation. A vector is in all filters whose direction
it exceeds a threshold on. These are list-decoded block by block: a prefix of code words is dropped
as soon as the best completion cannot reach the threshold. Vectors with a cosine over the limit are likely to share a
filter, as they pass the same caps; they are compared exactly within each filter they share.

The larger the table, the smaller the caps, and the more pairs share none. So several codes are used, each with a rotation and
words of its own: a pair is missed if it is in all. How many are needed is measured on random pairs at the limit, for the
table's dimension and size; a random rotation makes every pair of one cosine equally likely to be missed.

Equal vectors are compared once. A filter's members are compared in blocks of bounded size, and a filter
with many members (a third of the rows, say) becomes many pairs of blocks, each a group of its own. No pairs leave a
block: it returns, per vector, how many others it links with and one link towards the
block's components. A pair that shares several filters is counted in the first of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.components import connected_components
from salesmart.llm.vectors import dimension_of, matrix, usable, vector_key
from salesmart.sinks.staging import stage


@dataclass(frozen=True)
class CapSettings:
    """``passes``: filters of a code a vector would pass on average if scores were normal, fewer in large codes; ``least``:
    filters of a code it is put in at least, its best ones. ``members``: vectors per filter to aim for, by which the codes grow
    with the table; ``block``: vectors compared at once. ``missed``: bound on the share of pairs at the threshold that share no
    filter, by which the number of codes grows; ``trials``: random pairs it is measured on."""

    threshold: float = 0.95
    blocks: int = 2
    passes: float = 16.0
    least: int = 10
    members: int = 256
    block: int = 512
    seed: int = 5
    missed: float = 0.001
    trials: int = 4096


class ProductCode:
    def __init__(self, dimension: int, size: int, settings: CapSettings, number: int = 0):
        random = np.random.default_rng([settings.seed, number])
        count = min(settings.blocks, dimension)
        self.rotation = np.linalg.qr(random.standard_normal((dimension, dimension)))[0]
        self.cuts = np.array_split(np.arange(dimension), count)
        self.size, self.least, self.first = size, settings.least, number * size**count
        self.words = []
        for cut in self.cuts:
            words = random.standard_normal((size, len(cut)))
            self.words.append(words / np.linalg.norm(words, axis=1, keepdims=True) / np.sqrt(count))
        share = min(0.5, settings.passes / size**count)
        self.threshold = NormalDist().inv_cdf(1 - share) / np.sqrt(dimension)

    def decode(self, scores: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, filters and scores of all filters over the threshold."""
        best = [s.max(axis=1) for s in scores]
        rows = np.arange(len(scores[0]))
        filters, sums = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows))
        for i, block in enumerate(scores):
            rest = sum(best[i + 1 :], np.zeros(len(block)))
            reach = sums[:, None] + block[rows]
            prefix, word = np.nonzero(reach + rest[rows][:, None] >= threshold)
            filters, sums, rows = filters[prefix] * self.size + word, reach[prefix, word], rows[prefix]
        return rows, filters, sums

    def filters(self, units: np.ndarray) -> list[np.ndarray]:
        """Sorted filters of each row: all over the threshold, and the best ``least``; counted from ``first``."""
        turned = units @ self.rotation
        scores = [turned[:, cut] @ words.T for cut, words in zip(self.cuts, self.words, strict=True)]
        found: list[np.ndarray | None] = [None] * len(units)
        pending, threshold = np.arange(len(units)), self.threshold
        wanted = min(self.least, self.size ** len(self.cuts))
        while len(pending):
            rows, filters, sums = self.decode([s[pending] for s in scores], threshold)
            order = np.lexsort((-sums, rows))
            rows, filters, sums = rows[order], filters[order], sums[order]
            ends = np.searchsorted(rows, np.arange(len(pending) + 1))
            short = []
            for i, row in enumerate(pending):
                mine = slice(ends[i], ends[i + 1])
                if ends[i + 1] - ends[i] < wanted:
                    short.append(row)
                    continue
                over = max(wanted, int((sums[mine] >= self.threshold).sum()))
                found[row] = np.sort(filters[mine][:over]) + self.first
            pending, threshold = np.array(short, dtype=np.int64), threshold - 0.04
        return found


def code_size(rows: int, dimension: int, settings: CapSettings) -> int:
    """Words per block of a code."""
    filters = max(64.0, rows * settings.passes / settings.members)
    return max(8, int(np.ceil(filters ** (1 / min(settings.blocks, dimension or 1)))))


def missed_share(codes: list[ProductCode], dimension: int, cosine: float, trials: int, seed: int) -> float:
    """The share of random pairs of this cosine that have no filter in common."""
    random, missed = np.random.default_rng(seed), 0
    for at in range(0, trials, 512):
        one, other = random.standard_normal((2, min(512, trials - at), dimension))
        one /= np.linalg.norm(one, axis=1, keepdims=True)
        other -= (other * one).sum(axis=1, keepdims=True) * one
        other /= np.linalg.norm(other, axis=1, keepdims=True)
        other = cosine * one + np.sqrt(1 - cosine**2) * other
        apart = np.ones(len(one), dtype=bool)
        for code in codes:
            apart &= [not np.isin(a, b).any() for a, b in zip(code.filters(one), code.filters(other), strict=True)]
        missed += int(apart.sum())
    return missed / trials


def codes_needed(rows: int, dimension: int, settings: CapSettings) -> int:
    """Codes that keep the share of missed pairs at the threshold below ``missed``; codes miss independently."""
    if dimension < 2 or settings.threshold >= 1:
        return 1
    code = ProductCode(dimension, code_size(rows, dimension, settings), settings)
    share = missed_share([code], dimension, settings.threshold, settings.trials, settings.seed + 1)
    likely = share + 3 * max(share, 1 / settings.trials) ** 0.5 / settings.trials**0.5  # three deviations above
    return max(1, int(np.ceil(np.log(settings.missed) / np.log(min(likely, 0.999)))))


def _classes(vectors: DataFrame) -> DataFrame:
    """One row per distinct usable vector: key, vec_id (the smallest), copies, embedding."""
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    return stage(
        rows.groupBy(vector_key(F.col("embedding")).alias("key")).agg(
            F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("embedding")
        ),
        "vector-classes",
    )


def with_filters(classes: DataFrame, settings: CapSettings) -> DataFrame:
    """``classes`` with ``filters``, staged."""
    rows, dimension = classes.count(), dimension_of(classes, "embedding")
    size = code_size(rows, dimension, settings)
    numbers = range(codes_needed(rows, dimension, settings) if dimension else 0)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = [ProductCode(dimension, size, settings, number) for number in numbers]
        for batch in batches:
            for at in range(0, len(batch), 2048):
                part = batch.iloc[at : at + 2048].copy()
                values = matrix(part["embedding"])
                units = values / np.linalg.norm(values, axis=1, keepdims=True)
                found = [code.filters(units) for code in codes]
                part["filters"] = [np.concatenate(of_row) for of_row in zip(*found, strict=True)]
                yield part

    kind = classes.schema["embedding"].dataType.simpleString()
    schema = f"vec_id bigint, copies bigint, embedding {kind}, filters array<bigint>"
    return stage(classes.select("vec_id", "copies", "embedding").mapInPandas(work, schema), "vector-filters")


def _compare(settings: CapSettings):
    """Links within one pair of blocks: for each vector that has any, how many are counted here and one link."""

    def work(group: pd.DataFrame) -> pd.DataFrame:
        here = int(group["filter"].iloc[0])
        values = matrix(group["embedding"])
        units = values / np.linalg.norm(values, axis=1, keepdims=True)
        linked = units @ units.T >= settings.threshold
        np.fill_diagonal(linked, False)
        side = group["side"].to_numpy()
        across = group["low"].iloc[0] != group["high"].iloc[0]
        if across:
            linked &= side[:, None] != side[None, :]
        busy = np.nonzero(linked.any(axis=1))[0]
        linked, group = linked[np.ix_(busy, busy)], group.iloc[busy]

        # A pair counts in the smallest filter it shares: not here if both are in a smaller one.
        earlier = [f[f < here] for f in group["filters"]]
        seen, times = np.unique(np.concatenate([*earlier, np.zeros(0, dtype=np.int64)]), return_counts=True)
        shared = seen[times > 1]
        member = np.zeros((len(group), max(1, len(shared))), dtype=np.float32)
        for i, f in enumerate(earlier):
            member[i, np.searchsorted(shared, f[np.isin(f, shared)])] = 1
        counted = linked & (member @ member.T == 0)

        ids, labels = group["vec_id"].to_numpy(), group["vec_id"].to_numpy().copy()
        while len(ids):
            lower = np.minimum(labels, np.where(linked, labels[None, :], np.iinfo(np.int64).max).min(axis=1))
            if (lower == labels).all():
                break
            labels = lower
        return pd.DataFrame({"vec_id": ids, "n_links": counted @ group["copies"].to_numpy(), "root": labels})

    return work


def link_vectors(vectors: DataFrame, settings: CapSettings = CapSettings()) -> DataFrame:
    """Each row's vec_id, n_links, component_id and kept.

    ``vectors``: vec_id, embedding. Two vectors are linked if they share a filter and their cosine, in double
    precision, is at least the threshold; ``n_links`` counts the other rows a row is linked with, ``component_id`` is the smallest
    vec_id reachable over links, itself included, and ``kept`` says whether it is the row's own.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing; nor do rows
    without vec_id, whose component is null and which are not kept. Equal vectors are linked
    with each other. Repeated rows are copies of each other. Vectors of different lengths fail the job. An empty table
    gives an empty result. Other columns are not looked at.
    """
    classes = _classes(vectors)
    members = with_filters(classes, settings)
    exploded = members.withColumn("filter", F.explode("filters"))
    crowded = stage(
        exploded.groupBy("filter")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > settings.block)
        .select("filter", F.ceil(F.col("n") / settings.block).cast("int").alias("parts")),
        "crowded-filters",
    )
    parts = F.coalesce("parts", F.lit(1))
    placed = (
        exploded.join(crowded, "filter", "left")
        .withColumn("part", F.pmod(F.xxhash64("vec_id"), parts).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .select(
            "filter", "vec_id", "copies", "embedding", "filters",
            F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), F.col("part").alias("side"),
        )
    )
    found = stage(
        placed.groupBy("filter", "low", "high").applyInPandas(_compare(settings), "vec_id bigint, n_links bigint, root bigint"),
        "vector-links",
    )
    components = connected_components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("vec_id").agg(F.sum("n_links").alias("n_links"))
    of_class = stage(
        classes.drop("embedding")
        .join(links, "vec_id", "left")
        .join(components.withColumnRenamed("node", "vec_id"), "vec_id", "left")
        .select(
            "key",
            (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        ),
        "vector-components",
    )
    takes_part = F.col("vec_id").isNotNull() & usable(F.col("embedding"))
    rows = vectors.select("vec_id", F.when(takes_part, vector_key(F.col("embedding"))).alias("key"))
    component = F.coalesce("component_id", "vec_id")
    return rows.join(of_class, "key", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
