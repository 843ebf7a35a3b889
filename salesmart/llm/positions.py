"""Ranked lexical search by the Best Position Algorithm over impact-ordered lists.

Documents are cut into blocks of bounded size. A block holds, for every term asked for, a list of its documents from the
largest impact down. For one item the lists of its terms are read from the top, side by side. A document met in one
list is at once looked up in all others (direct accesses), which gives its whole score, and its positions
there count as seen. A list's best position is the last one up to which all positions are seen, by either kind of access, so it lies at or
below the last position read. A document not yet met stands below the best position of every list, and its score
cannot exceed the sum of the impacts there. Reading stops when that sum is strictly below the score of the k-th document
found, so that ties are still met; the k-th of earlier blocks of the same task counts too.

Only rows of terms that some item holds are kept of a document, with its length. They are written to the shared folder once,
as their frequencies are needed before the first impact is known. Nothing is shuffled but counts per term and the k best per task and item.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.sinks.staging import stage

# Fixed value: letters and digits of ASCII, and every byte of other characters, belong to a term; A-Z are lower-cased.
_IN_TERMS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


@dataclass(frozen=True)
class RankSettings:
    """``asked``: rows of (item, term) that are ranked in one pass over the documents, about; they go to the driver and to every
    task. ``block_docs`` and ``block_postings``: a block ends at either. ``step``: positions read of each list in the first round,
    doubled in each further one. ``merging``: tasks per item that merge the tasks' results first."""

    k: int = 20
    asked: int = 200_000
    block_docs: int = 16_384
    block_postings: int = 2_000_000
    step: int = 32
    merging: int = 16


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(_IN_TERMS).split()


def _as_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term (binary), times: of the distinct rows of ``items`` that have an id."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (item, term, times)
                for item, text in zip(batch.column("item_id").to_pylist(), _as_bytes(batch.column("text")), strict=True)
                for term, times in Counter(terms_of(text or b"")).items()
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[i] for row in found], kind) for i, kind in enumerate((pa.int64(), pa.binary(), pa.int64()))],
                ["item_id", "term", "times"],
            )

    rows = items.select(F.col("item_id").cast("bigint"), "text").where("item_id IS NOT NULL").distinct()
    found = rows.mapInArrow(work, "item_id bigint, term binary, times bigint")
    return found.groupBy("item_id", "term").agg(F.sum("times").alias("times"))


def postings(docs: DataFrame, vocabulary) -> DataFrame:
    """doc_id, n (terms with repeats), terms and times (arrays) of the documents that have a term.

    ``vocabulary``: a broadcast dictionary from the terms asked for to their numbers.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value.get
        for batch in batches:
            ids, lengths, offsets, terms, times = [], [], [0], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), _as_bytes(batch.column("text")), strict=True):
                words = terms_of(text) if text else ()
                if not words:
                    continue
                held = Counter(map(number, words))
                held.pop(None, None)
                ids.append(doc_id)
                lengths.append(len(words))
                terms += held
                times += held.values()
                offsets.append(len(terms))
            lists = [
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))
                for values in (terms, times)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), *lists], ["doc_id", "n", "terms", "times"]
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(work, "doc_id bigint, n bigint, terms array<int>, times array<int>")


def document_counts(index: DataFrame, terms: int) -> np.ndarray:
    """In how many documents of ``postings`` each of the terms is. At most one row per term goes to the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(terms, dtype=np.int64)
        for batch in batches:
            counts += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=terms)
        held = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(counts[held])], ["term", "docs"])

    found = index.select("terms").mapInArrow(work, "term bigint, docs bigint").groupBy("term").agg(F.sum("docs").alias("docs"))
    out = np.zeros(terms, dtype=np.int64)
    for row in found.collect():
        out[row["term"]] = row["docs"]
    return out


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class ImpactLists:
    """Impact-ordered lists of the terms over one block of documents, with direct access by document."""

    def __init__(self, lengths: list[int], offsets: np.ndarray, terms: np.ndarray, times: np.ndarray, vocabulary: int, documents: int, total: int):
        self.offsets, self.terms = offsets, terms
        count = len(lengths)
        norms = np.array([100 - 25 + (25 * n * documents) // total for n in lengths], dtype=np.int64)
        owner = np.repeat(np.arange(count, dtype=np.int32), np.diff(offsets))
        times = times.astype(np.int64)
        self.impact_of = (1_000_000_000 * times) // (1000 * times + 12 * norms[owner])
        order = np.lexsort((-self.impact_of, terms))
        self.docs, self.impacts = owner[order], self.impact_of[order]
        self.place = np.empty(len(order), dtype=np.int64)
        self.place[order] = np.arange(len(order))
        self.starts = np.searchsorted(terms[order], np.arange(vocabulary + 1))
        self.unseen = np.ones(len(order) + 1, dtype=bool)
        self.known = np.zeros(count, dtype=bool)
        self.weights = np.zeros(vocabulary, dtype=np.int64)

    @staticmethod
    def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """All numbers from each start up to its end."""
        sizes = ends - starts
        return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, step: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents and scores that may be among the k best, all ties included, and the positions read of the lists.

        ``floor``: a score that k other documents are known to reach.
        """
        held = (self.starts[terms + 1] > self.starts[terms]) & (weights > 0)
        terms, weights = terms[held], weights[held]
        starts, ends = self.starts[terms], self.starts[terms + 1]
        self.weights[terms] = weights
        best, depth, kth = starts.copy(), 0, floor
        docs, scores, touched = [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int64)], []
        while len(terms) and (starts + depth < ends).any():
            low, depth = np.minimum(starts + depth, ends), depth + step
            step *= 2
            new = np.unique(self.docs[self._ranges(low, np.minimum(starts + depth, ends))])
            new = new[~self.known[new]]
            if len(new):
                self.known[new] = True
                first, last = self.offsets[new], self.offsets[new + 1]
                rows = self._ranges(first, last)
                weight = self.weights[self.terms[rows]]
                docs.append(new)
                scores.append(np.add.reduceat(weight * self.impact_of[rows], np.cumsum(last - first) - (last - first)))
                seen = self.place[rows[weight > 0]]
                self.unseen[seen] = False
                touched.append(seen)
                reached = np.concatenate(scores)
                if len(reached) >= k:
                    kth = max(kth, int(np.partition(reached, -k)[-k]))
            limit = 0
            for j, (at, end) in enumerate(zip(best.tolist(), ends.tolist(), strict=True)):
                ahead = self.unseen[at:end]
                step_on = int(ahead.argmax()) if len(ahead) else 0
                best[j] = at = at + step_on if len(ahead) and ahead[step_on] else end
                if at < end:
                    limit += int(weights[j]) * int(self.impacts[at - 1])
            if limit < kth:
                break
        docs, scores = np.concatenate(docs), np.concatenate(scores)
        self.weights[terms] = 0
        self.known[docs] = False
        for seen in touched:
            self.unseen[seen] = True
        good = (scores > 0) & (scores >= kth)
        return docs[good], scores[good], int(np.minimum(depth, ends - starts).sum())


def _blocks(batches: Iterator[pa.RecordBatch], settings: RankSettings) -> Iterator[tuple]:
    """(ids, lengths, offsets, terms, times) of blocks of documents."""
    parts: list[tuple] = []
    docs = held = 0

    def whole():
        ids, lengths, sizes, terms, times = (np.concatenate(x) for x in zip(*parts, strict=True))
        return ids, lengths.tolist(), np.concatenate([[0], np.cumsum(sizes)]), terms, times

    for batch in batches:
        columns = [batch.column(c) for c in ("doc_id", "n", "terms", "times")]
        sizes = np.diff(columns[2].offsets.to_numpy())
        ends = np.cumsum(sizes)
        start = 0
        while start < len(sizes):
            room = min(settings.block_docs - docs, len(sizes) - start)
            before = ends[start] - sizes[start]
            fits = int(np.searchsorted(ends[start : start + room], before + settings.block_postings - held, "right"))
            taken = max(1 if not docs else 0, fits)
            if taken:
                ids, n, terms, times = (c.slice(start, taken) for c in columns)
                parts.append((ids.to_numpy(), n.to_numpy(), sizes[start : start + taken], terms.flatten().to_numpy(), times.flatten().to_numpy()))
                docs, held, start = docs + taken, held + len(parts[-1][3]), start + taken
            if start < len(sizes):
                yield whole()
                parts, docs, held = [], 0, 0
    if docs:
        yield whole()


def _ranked(index: DataFrame, asked, documents: int, total: int, vocabulary: int, settings: RankSettings) -> DataFrame:
    """item_id, doc_id, score: the k best of each task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in asked.value]  # (-score, doc_id), in order
        for ids, lengths, offsets, terms, times in _blocks(batches, settings):
            lists = ImpactLists(lengths, offsets, terms, times, vocabulary, documents, total)
            for i, (_, item_terms, weights) in enumerate(asked.value):
                floor = -best[i][settings.k - 1][0] if len(best[i]) >= settings.k else 0
                docs, scores, _ = lists.best(item_terms, weights, settings.k, settings.step, floor)
                if len(docs):
                    found = zip((-scores).tolist(), ids[docs].tolist(), strict=True)
                    best[i] = sorted([*best[i], *found])[: settings.k]
        rows = [(item, doc_id, -score) for (item, _, _), found in zip(asked.value, best, strict=True) for score, doc_id in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array([row[c] for row in rows], pa.int64()) for c in range(3)], ["item_id", "doc_id", "score"]
        )

    return index.where("doc_id IS NOT NULL").mapInArrow(work, "item_id bigint, doc_id bigint, score bigint")


def rank_documents(docs: DataFrame, items: DataFrame, settings: RankSettings = RankSettings()) -> DataFrame:
    """The ``k`` highest-scoring documents of each item: item_id, rank (from 1), doc_id, score.

    ``docs``: doc_id, text; ``items``: item_id, text. Terms are maximal runs of ASCII letters and digits and of characters
    beyond ASCII; A-Z are lower-cased. Over the documents with a term, N of them with L terms, a term held by df documents weighs
    ``floor(1000 ln((2 N + 2) / (2 df + 1)))``, and a document of n terms has ``m = 75 + 25 n N div L``. Its score sums, over the item's
    terms with repeats, ``weight * (1e9 tf div (1000 tf + 12 m))``. Scores of 0 are left out; ties go to the smaller doc_id.

    Null and empty texts have no terms: such items give no rows, such documents count nowhere. Items without
    item_id are left out; repeated rows of an item count once, and different texts under one item_id are one
    item. Documents without doc_id count in N, L and df but are not ranked. Rows with equal doc_id are separate
    documents. Empty tables give an empty result. Other columns are not looked at.
    """
    spark = docs.sparkSession
    asked = stage(item_terms(items), "rank-items")
    passes = max(1, math.ceil(asked.count() / settings.asked))
    found = []
    for number in range(passes):
        group = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == number) if passes > 1 else asked
        rows = group.collect()
        vocabulary = {term: i for i, term in enumerate(sorted({bytes(r["term"]) for r in rows}))}
        if not vocabulary:
            continue
        index = stage(postings(docs, spark.sparkContext.broadcast(vocabulary)), "rank-postings")
        documents, total = index.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not documents:
            continue
        weights = [term_weight(documents, holding) for holding in document_counts(index, len(vocabulary)).tolist()]
        of_item: dict[int, list[tuple[int, int]]] = {}
        for r in rows:
            term = vocabulary[bytes(r["term"])]
            of_item.setdefault(r["item_id"], []).append((term, r["times"] * weights[term]))
        plain = [(i, np.array([t for t, _ in pairs]), np.array([w for _, w in pairs], dtype=np.int64)) for i, pairs in of_item.items()]
        found.append(_ranked(index, spark.sparkContext.broadcast(plain), documents, total, len(vocabulary), settings))
    if not found:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    merged = found[0]
    for more in found[1:]:
        merged = merged.unionByName(more)
    for keys in (["item_id", "part"], ["item_id"]):
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "doc_id")
        if "part" in keys:
            merged = merged.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(settings.merging)))
        merged = merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= settings.k)
    return merged.select("item_id", "rank", "doc_id", "score")
