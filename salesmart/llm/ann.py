"""Nearest neighbours by inner product with multi-index hashing of learned binary codes.

Vectors become codes of ``rotations`` times as many bits as they have components: the signs after rotations that are
learned, from different starts, to bring the components of a sample near plus or minus one. Vectors of unequal length
first get one more component that makes them equally long, so that the angle to a query orders as the inner product does.

The codes of a block of vectors are cut into substrings of 16 bits, and each substring is an index from its distinct values to
the vectors that have them. If two codes differ in at most ``m (e + 1) - 1`` bits, one of the m substrings differs in at most e. So opening
all occupied buckets within e errors in every substring retrieves every code within that radius; e is, per query, the least whose radius
holds as many codes as are to be reranked. These are compared by their original components. With a shortlist of 1 the result is exact.

A block's index is built once, and the queries stream through it in groups: a group's errors against all distinct values of a
substring are one array operation, and added up over the substrings they are the distances of what is opened. Rows and queries
reach a block's task in one sorted shuffle, rows first, so that a task holds one block and one group. Each task returns the
best of its block. The best of all blocks are the result. Equal vectors are one entry of the index
that names the smallest of their ids, as many as a result can hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.samples import capped_sample
from salesmart.llm.vectors import dimension_of, matrix, usable, vector_key
from salesmart.sinks.staging import stage

_SUBSTRING = 16


@dataclass(frozen=True)
class SearchSettings:
    """``sample``: vectors the rotations are learned from. ``shortlist``: share of a block that is reranked per query,
    and ``least`` its smallest number. ``block``: vectors in one index, at most about; there are ``blocks`` at least. ``queries``: queries probed at once."""

    k: int = 20
    rotations: int = 4
    rounds: int = 10
    sample: int = 4096
    shortlist: float = 0.06
    least: int = 100
    block: int = 32_768
    blocks: int = 16
    queries: int = 128
    seed: int = 3


def lengthened(values: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with one more component that makes all of them ``longest`` long."""
    rest = np.sqrt(np.maximum(0.0, longest**2 - (values**2).sum(axis=1)))
    return np.column_stack([values, rest]) / longest


def learn_rotations(sample: np.ndarray, settings: SearchSettings) -> np.ndarray:
    """(dimension, bits): iterative quantisation from random rotations of the principal axes."""
    random = np.random.default_rng(settings.seed)
    dimension = sample.shape[1]
    _, axes = np.linalg.eigh(sample.T @ sample)
    turned, found = sample @ axes, []
    for _ in range(settings.rotations):
        rotation = np.linalg.qr(random.standard_normal((dimension, dimension)))[0]
        for _ in range(settings.rounds):
            left, _, right = np.linalg.svd(np.sign(turned @ rotation).T @ turned)
            rotation = (left @ right).T
        found.append(axes @ rotation)
    return np.concatenate(found, axis=1)


def codes(values: np.ndarray, rotations: np.ndarray) -> np.ndarray:
    """Codes as rows of 16-bit substrings."""
    bits = values @ rotations > 0
    bits = np.pad(bits, ((0, 0), (0, -bits.shape[1] % _SUBSTRING)))
    return np.packbits(bits, axis=1).view(np.uint16)


class BlockIndex:
    """One index per substring over a block of codes: its distinct values, and each member's bucket among them."""

    def __init__(self, block: np.ndarray):
        self.count, self.substrings = block.shape
        found = [np.unique(block[:, s], return_inverse=True) for s in range(self.substrings)]
        self.values, self.buckets = [v for v, _ in found], [b for _, b in found]

    def within(self, code: np.ndarray, wanted: int) -> np.ndarray:
        """As ``within_all``, for one code."""
        return self.within_all(code[None], wanted)[0]

    def within_all(self, asked: np.ndarray, wanted: int) -> list[np.ndarray]:
        """For each code at least ``wanted`` members (or all): every member within some Hamming radius of it."""
        if wanted >= self.count:
            return [np.arange(self.count)] * len(asked)
        distance = np.zeros((len(asked), self.count), dtype=np.uint16)
        least = np.full(distance.shape, _SUBSTRING, dtype=np.uint8)  # fewest errors in any substring: the level that opens a member
        for s in range(self.substrings):
            errors = np.bitwise_count(self.values[s] ^ asked[:, s : s + 1])
            of_member = np.take(errors, self.buckets[s], axis=1)
            distance += of_member
            np.minimum(least, of_member, out=least)
        nearest_of = np.partition(distance, wanted - 1, axis=1)[:, wanted - 1]
        level = nearest_of // self.substrings  # the first whose radius, substrings * (level + 1) - 1, reaches that far
        inside = (least <= level[:, None]) & (distance <= nearest_of[:, None])
        return [np.nonzero(row)[0] for row in inside]


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, bool, pd.DataFrame]]:
    """Rows that follow each other and are of one block and kind."""
    for batch in batches:
        block, asks = batch["block"].to_numpy(), batch["asks"].to_numpy()
        edges = np.nonzero((np.diff(block) != 0) | (np.diff(asks.astype(np.int8)) != 0))[0] + 1
        for start, end in zip([0, *edges], [*edges, len(batch)], strict=True):
            if end > start:
                yield int(block[start]), bool(asks[start]), batch.iloc[start:end]


def _search(rotations: np.ndarray, longest: float, settings: SearchSettings):
    """The nearest of each block for each query; rows come by block, entries before queries."""

    def best_of(values: np.ndarray, ids: list, index: BlockIndex, asked: pd.DataFrame) -> pd.DataFrame:
        queries = matrix(asked["embedding"])
        norms = np.linalg.norm(queries, axis=1, keepdims=True)
        asked_codes = codes(np.column_stack([queries / norms, np.zeros(len(queries))]), rotations)
        wanted = max(settings.least, int(np.ceil(settings.shortlist * len(values))))
        found: list[tuple] = []
        for query_class, query, near in zip(asked["vec_id"], queries, index.within_all(asked_codes, wanted), strict=True):
            scores = (values[near] * query).sum(axis=1)
            if len(near) > settings.k + 1:
                limit = np.partition(scores, -settings.k - 1)[-settings.k - 1]
                near, scores = near[scores >= limit], scores[scores >= limit]
            best = sorted((-s, int(i)) for n, s in zip(near, scores, strict=True) for i in ids[n])
            found += [(query_class, i, -s) for s, i in best[: settings.k + 1]]
        return pd.DataFrame(found, columns=["query_class", "vec_id", "score"])

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        current, ready = None, None
        for block, asks, rows in _runs(batches):
            if block != current:
                held, current, ready = [], block, None
            if not asks:
                held.append(rows[["ids", "embedding"]])
            elif held:
                if ready is None:
                    entries = pd.concat(held)
                    values = matrix(entries["embedding"])
                    ready = values, entries["ids"].to_list(), BlockIndex(codes(lengthened(values, longest), rotations))
                for start in range(0, len(rows), settings.queries):
                    yield best_of(*ready, rows.iloc[start : start + settings.queries])

    return work


def nearest(vectors: DataFrame, is_query: Column, settings: SearchSettings = SearchSettings()) -> DataFrame:
    """The ``k`` nearest other vectors of each query: query_id, rank (from 1), vec_id, score.

    ``vectors``: vec_id, embedding; ``is_query``: a condition on the rows. Nearness is the largest inner product in double
    precision; ties go to the smaller vec_id, and a query is not its own neighbour. Fewer vectors than k are all returned.

    Vectors that are null, empty, zero or hold null or non-finite components are neither queries nor neighbours, nor are rows
    without vec_id. Equal vectors are separate neighbours. Rows with equal vec_id count once. Vectors of different lengths fail the
    job. An empty table gives an empty result. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    rows = (
        vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
        .select("vec_id", "embedding", F.coalesce(is_query, F.lit(False)).alias("asks"), vector_key(F.col("embedding")).alias("key"))
    )
    # Only the smallest ids of equal vectors can be in a result; the limit is applied in the map tasks already.
    in_order = Window.partitionBy("key").orderBy("vec_id")
    entries = stage(
        rows.withColumn("place", F.dense_rank().over(in_order))
        .where(F.col("place") <= settings.k + 1)
        .groupBy("key")
        .agg(F.min("vec_id").alias("vec_id"), F.sort_array(F.collect_set("vec_id")).alias("ids"), F.first("embedding").alias("embedding")),
        "ann-entries",
    )
    asking = stage(rows.where("asks").select(F.col("vec_id").alias("query_id"), "key").distinct(), "ann-queries")
    asked = stage(
        asking.select("key").distinct().join(entries, "key").select("key", "vec_id", "embedding"), "ann-query-vectors"
    )
    dimension = dimension_of(entries, "embedding")
    if dimension is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    count = entries.count()
    squares = F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda s, x: s + x * x)
    longest = float(np.sqrt(entries.agg(F.max(squares)).first()[0])) * (1 + 1e-9)
    chosen = capped_sample(entries, "vec_id", settings.sample).select("embedding").collect()
    sample = lengthened(np.array([r["embedding"] for r in chosen], dtype=np.float64), longest)
    rotations = learn_rotations(sample, settings)

    blocks = max(settings.blocks, -(-count // settings.block))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    rows = entries.select(block.alias("block"), F.lit(False).alias("asks"), "vec_id", "ids", "embedding").unionByName(
        asked.select(every.alias("block"), F.lit(True).alias("asks"), "vec_id", F.lit(None).cast("array<bigint>").alias("ids"), "embedding")
    )
    found = (
        rows.repartition(blocks, "block")
        .sortWithinPartitions("block", "asks")
        .mapInPandas(_search(rotations, longest, settings), "query_class bigint, vec_id bigint, score double")
    )
    best = Window.partitionBy("query_class").orderBy(F.desc("score"), "vec_id")
    of_class = stage(
        found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= settings.k + 1).drop("place"), "ann-found"
    )
    of_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asking.join(asked.select("key", F.col("vec_id").alias("query_class")), "key")
        .join(of_class, "query_class")
        .where("query_id <> vec_id")
        .withColumn("rank", F.row_number().over(of_query))
        .where(F.col("rank") <= settings.k)
        .select("query_id", "rank", "vec_id", "score")
    )
