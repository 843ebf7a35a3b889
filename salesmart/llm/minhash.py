"""Near copies among texts by a multi-index Hamming join of minwise signatures.

A text's set of word shingles becomes a signature of ``chunks * chunk`` values of 16 bits. Two signatures are as far apart as they
have different values. Cut into chunks, of which each may have ``errors`` differences, signatures at a distance of at most
``chunks * (errors + 1) - 1`` agree, by the pigeonhole principle, on some chunk up to that many errors. Each chunk
therefore gives one key per way to leave out ``errors`` of its values, and an equality join on the keys finds every pair
within the distance. With the defaults a pair of similarity 0.8 has no key in common with a probability below 1e-5.
Pairs are confirmed on the full sets of shingles.

Texts with equal sets are one class and are compared once. No group is joined with itself beyond ``small``
members. Of a larger group, every member is first confirmed against the group's smallest member;
most groups of copies end there. Only those that this leaves in other components are compared with the rest and among
themselves, in blocks of bounded size that give back links, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.components import connected_components
from salesmart.llm.marks import marks_of
from salesmart.llm.shingles import MinHash, mixed, shingle_sets
from salesmart.sinks.staging import shuffle_files_removed, small_batches, stage


@dataclass(frozen=True)
class NearCopySettings:
    """``percent``: similarity from which texts are linked. ``sketch``: one-bit positions for an early
    check of candidates, which may differ in at most ``sketch_errors`` of them (a pair at 0.8 differs in 13 on average, with a deviation of 3.4)."""

    width: int = 5
    percent: int = 80
    chunks: int = 9
    chunk: int = 5
    errors: int = 1
    sketch: int = 128
    sketch_errors: int = 32
    small: int = 32
    block: int = 512
    seed: int = 17


#: Characters of text handled at once in a task.
_AT_ONCE = 500_000


def _portions(lengths: list[int]) -> Iterator[slice]:
    """Slices of rows of about so many characters each."""
    start = total = 0
    for i, length in enumerate(lengths):
        total += length
        if total >= _AT_ONCE:
            yield slice(start, i + 1)
            start, total = i + 1, 0
    if start < len(lengths):
        yield slice(start, len(lengths))


def _signed(long: np.ndarray) -> np.ndarray:
    return long.view(np.int64)


def sign(docs: DataFrame, settings: NearCopySettings) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_a and set_b (a digest of the set), signature, sketch (array<bigint>).

    Texts without words have no signature.
    """
    positions = settings.chunks * settings.chunk

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        minhash = MinHash(max(positions, settings.sketch), settings.seed)
        for batch in batches:
            texts = [(t or "").encode() for t in batch["text"]]
            for rows in _portions([len(t) for t in texts]):
                part = batch.iloc[rows][["doc_id", "text_hash"]].copy()
                sets = shingle_sets(texts[rows], settings.width)
                part["n_shingles"] = [len(s) for s in sets]
                part["set_a"] = [int(_signed(mixed(s).sum(keepdims=True))[0]) if len(s) else 0 for s in sets]
                part["set_b"] = [int(_signed(mixed(s ^ np.uint64(1)).sum(keepdims=True))[0]) if len(s) else 0 for s in sets]
                signature, sketch = np.empty(len(sets), dtype=object), np.empty(len(sets), dtype=object)
                full = [i for i, s in enumerate(sets) if len(s)]
                if full:
                    values = minhash.signatures([sets[i] for i in full])
                    bits = np.packbits((values[:, : settings.sketch] & 1).astype(np.uint8), axis=1).view(np.int64)
                    for row, value, bit in zip(full, values[:, :positions], bits, strict=True):
                        signature[row], sketch[row] = value, bit
                part["signature"], part["sketch"] = signature, sketch
                yield part

    # Ids go as text, since pandas would turn whole numbers beside nulls into doubles.
    schema = (
        "doc_id string, text_hash bigint, n_shingles bigint, set_a bigint, set_b bigint,"
        " signature array<int>, sketch array<bigint>"
    )
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    return rows.mapInPandas(work, schema).withColumn("doc_id", F.col("doc_id").cast("bigint"))


def keys(settings: NearCopySettings) -> list:
    """One key per chunk and way to leave out ``errors`` of its values."""
    out = []
    for chunk in range(settings.chunks):
        for kept in combinations(range(settings.chunk), settings.chunk - settings.errors):
            values = [F.col("signature")[chunk * settings.chunk + i] for i in kept]
            out.append(F.xxhash64(F.lit(len(out)), *values))
    return out


def _confirm(settings: NearCopySettings):
    """Pairs whose similarity reaches the limit on their full sets."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            left = [(t or "").encode() for t in batch["text_a"]]
            right = [(t or "").encode() for t in batch["text_b"]]
            for rows in _portions([len(a) + len(b) for a, b in zip(left, right, strict=True)]):
                sets = shingle_sets(left[rows] + right[rows], settings.width)
                half = len(sets) // 2
                both = np.array([len(np.intersect1d(a, b, True)) for a, b in zip(sets[:half], sets[half:], strict=True)])
                sizes = np.array([len(a) + len(b) for a, b in zip(sets[:half], sets[half:], strict=True)])
                yield batch.iloc[rows][100 * both >= settings.percent * (sizes - both)][["a", "b"]]

    return work


def _compare(settings: NearCopySettings):
    """One link towards its component for every member of a pair of blocks that has a near copy there."""

    def work(group: pd.DataFrame) -> pd.DataFrame:
        texts = [(t or "").encode() for t in group["text"]]
        sets = [s for rows in _portions([len(t) for t in texts]) for s in shingle_sets(texts[rows], settings.width)]
        sizes = np.array([len(s) for s in sets])
        shingles, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(sets)), sizes)
        shared = times[column] > 1
        row, column = row[shared], (np.cumsum(times > 1) - 1)[column[shared]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        both = np.zeros((len(sets), len(sets)), dtype=np.float32)
        for first in range(0, int((times > 1).sum()), 4096):
            low, high = np.searchsorted(column, [first, first + 4096])
            held = np.zeros((len(sets), 4096), dtype=np.float32)
            held[row[low:high], column[low:high] - first] = 1
            both += held @ held.T
        linked = 100 * both >= settings.percent * (sizes[:, None] + sizes[None, :] - both)
        side = group["side"].to_numpy()
        if group["across"].iloc[0]:
            linked &= side[:, None] != side[None, :]
        np.fill_diagonal(linked, False)
        busy = np.nonzero(linked.any(axis=1))[0]
        linked, ids = linked[np.ix_(busy, busy)], group["doc_id"].to_numpy()[busy]
        labels = ids.copy()
        while len(ids):
            lower = np.minimum(labels, np.where(linked, labels[None, :], np.iinfo(np.int64).max).min(axis=1))
            if (lower == labels).all():
                break
            labels = lower
        return pd.DataFrame({"a": ids, "b": labels})

    return work


def near_copies(docs: DataFrame, settings: NearCopySettings = NearCopySettings()) -> DataFrame:
    """Each row's doc_id, n_shingles, component_id and kept.

    ``docs``: doc_id, text. Two texts are linked if ``100 * shared >= percent * all`` of their distinct shingles of ``width`` words
    (words are runs of other characters than space and control white space; A-Z count as lower case). A text of fewer words is one shingle.
    ``component_id`` is the smallest doc_id reachable over links, itself included; ``kept`` says whether it is the row's own.

    Null and empty texts, and texts without words, have no shingles and link with nothing. Rows without doc_id take
    no part: their component is null and they are not kept. Repeated rows are near copies of each other with the same doc_id, so
    each of them is kept or none is. An empty table gives an empty result. Other columns are not looked at.
    """
    identity = ["n_shingles", "set_a", "set_b"]
    with shuffle_files_removed(docs.sparkSession), small_batches(docs.sparkSession):
        signed = stage(sign(docs, settings), "near-signed")
        of_class = _components_of_classes(docs, signed, identity, settings)
    takes_part = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    component = F.when(takes_part, F.col("component")).otherwise(F.col("doc_id"))
    return (
        signed.select("doc_id", *identity)
        .join(of_class, identity, "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"),
        )
    )


def _components_of_classes(docs: DataFrame, signed: DataFrame, identity: list[str], settings: NearCopySettings) -> DataFrame:
    """``identity`` and component of each class of texts with equal sets."""
    classes = stage(
        signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy(*identity)
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.first("signature").alias("signature"), F.first("sketch").alias("sketch"))
        .select("first.doc_id", "first.text_hash", *identity, "signature", "sketch"),
        "near-classes",
    )
    keyed = classes.select("doc_id", "n_shingles", "sketch", F.explode(F.array(*keys(settings))).alias("key"))
    groups = stage(
        keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("doc_id").alias("center")).where("members > 1"), "near-groups"
    )
    grouped = stage(marks_of(groups, ["key"]).likely(keyed).join(groups, "key"), "near-grouped")

    # Candidates: all pairs of small groups, and the members of larger ones with their smallest.
    small = grouped.where(F.col("members") <= settings.small).select("key", "doc_id", "n_shingles", "sketch")
    large = grouped.where(F.col("members") > settings.small)
    centers = large.where("doc_id = center")
    a, b = F.col("a.doc_id"), F.col("b.doc_id")
    apart = sum(
        (F.bit_count(F.col("a.sketch")[i].bitwiseXOR(F.col("b.sketch")[i])) for i in range(settings.sketch // 64)), F.lit(0)
    )
    alike = (
        (F.col("a.n_shingles") * 100 >= F.col("b.n_shingles") * settings.percent)
        & (F.col("b.n_shingles") * 100 >= F.col("a.n_shingles") * settings.percent)
        & (apart <= settings.sketch_errors)
    )
    pairs = stage(
        small.alias("a")
        .join(small.alias("b"), (F.col("a.key") == F.col("b.key")) & (a < b) & alike)
        .select(a.alias("a"), b.alias("b"))
        .unionByName(
            centers.alias("a")
            .join(large.alias("b"), (F.col("a.key") == F.col("b.key")) & (a < b) & alike)
            .select(a.alias("a"), b.alias("b"))
        )
        .distinct(),
        "near-pairs",
    )
    compared = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).unionByName(large.select("doc_id"))
    texts = _texts(docs, classes, signed, compared)
    with_a = pairs.join(texts.withColumnsRenamed({"doc_id": "a", "text": "text_a"}), "a")
    with_both = with_a.join(texts.withColumnsRenamed({"doc_id": "b", "text": "text_b"}), "b")
    links = stage(with_both.select("a", "b", "text_a", "text_b").mapInPandas(_confirm(settings), "a bigint, b bigint"), "near-links")

    more = _links_of_rest(large, connected_components(links), texts, settings)
    if more is not None:
        links = links.unionByName(more)
    components = connected_components(links).withColumnRenamed("node", "doc_id")
    return stage(
        classes.join(components, "doc_id", "left").select(*identity, F.coalesce("component", "doc_id").alias("component")),
        "near-components",
    )


def _texts(docs: DataFrame, classes: DataFrame, signed: DataFrame, compared: DataFrame) -> DataFrame:
    """doc_id and text of the first document of each class whose doc_id is in ``compared``, once also where its row is repeated; some others beside.

    The texts are not shuffled to find those: the bits of the wanted ones go to all tasks. Where doc_ids repeat, which they normally don't,
    what that leaves is joined exactly, and repeated rows are gathered to take one of each.
    """
    identity = ["doc_id", "text_hash"]
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    wanted = stage(classes.select(*identity).join(compared.distinct(), "doc_id", "left_semi"), "near-compared")
    likely = marks_of(wanted, identity).likely(rows)
    taking_part = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    if taking_part.groupBy("doc_id").count().where("count > 1").isEmpty():
        return stage(likely.select("doc_id", "text"), "near-texts")
    first = stage(likely.join(wanted, identity, "left_semi").select(*identity, "text"), "near-texts")
    repeated = stage(
        taking_part.groupBy(*identity).agg(F.count(F.lit(1)).alias("times")).where("times > 1"),
        "near-repeated",
    )
    one_of_each = first.join(repeated, identity, "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    return first.join(repeated, identity, "left_anti").select("doc_id", "text").unionByName(one_of_each)


def _links_of_rest(
    large: DataFrame, components: DataFrame, texts: DataFrame, settings: NearCopySettings
) -> DataFrame | None:
    """Links of those members of large groups that are not in the component of the group's smallest member.

    They are compared with that component's members and among themselves; a group is cut into blocks.
    """
    labels = components.select(F.col("node").alias("doc_id"), "component")
    member = F.coalesce("component", "doc_id")
    labelled = (
        large.select("key", "doc_id", "center")
        .join(labels, "doc_id", "left")
        .select("key", "center", "doc_id", member.alias("component"))
        .join(labels.select(F.col("doc_id").alias("center"), F.col("component").alias("main")), "center", "left")
        .select("key", "doc_id", (F.col("component") != F.coalesce("main", "center")).alias("rest"))
    )
    labelled = stage(labelled, "near-labelled")
    parts = lambda rest: F.ceil(F.count_if(rest) / settings.block).cast("int")
    sizes = stage(
        labelled.groupBy("key")
        .agg(parts(F.col("rest")).alias("rests"), parts(~F.col("rest")).alias("mains"))
        .where("rests > 0"),
        "near-unsettled",
    )
    if sizes.isEmpty():
        return None
    number = F.pmod(F.xxhash64("doc_id"), F.greatest(F.lit(1), F.when(F.col("rest"), F.col("rests")).otherwise(F.col("mains"))))
    placed = labelled.join(sizes, "key").withColumn("part", number.cast("int"))

    def meeting(across_main: bool, other: str):
        """The block pairs that a row is in."""
        columns = {"main": F.lit(across_main), "part": F.col("part"), "other": F.explode(F.sequence(F.lit(0), F.col(other) - 1))}
        return [F.col("key"), F.col("doc_id"), F.col("rest"), *[c.alias(n) for n, c in columns.items()]]

    rest, main = placed.where("rest"), placed.where("NOT rest")
    with_main = rest.where("mains > 0").select(*meeting(True, "mains")).withColumnsRenamed({"part": "x", "other": "y"}).unionByName(
        main.select(*meeting(True, "rests")).withColumnsRenamed({"part": "y", "other": "x"})
    )
    among = rest.select(*meeting(False, "rests")).select(
        "key", "doc_id", "rest", "main", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"), "part"
    )
    meetings = with_main.select("key", "doc_id", "main", "x", "y", F.col("rest").cast("int").alias("side"), F.lit(True).alias("across")).unionByName(
        among.select("key", "doc_id", "main", "x", "y", F.col("part").alias("side"), (F.col("x") != F.col("y")).alias("across"))
    )
    return stage(
        meetings.join(texts, "doc_id")
        .groupBy("key", "main", "x", "y")
        .applyInPandas(_compare(settings), "a bigint, b bigint"),
        "near-rest-links",
    )
