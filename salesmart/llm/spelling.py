"""Spelling variants by one-edit neighbourhoods over a reduced alphabet.

The letters of a vocabulary are hashed to a few symbols, which makes every word a reduced word. Two words that differ by one
edit have reduced words that are equal or differ by one edit, and the neighbourhood of a reduced word over so few symbols is small enough to be written out
whole. It is joined with the reduced words that exist, and the words behind each hit are verified on their letters.

Each distinct reduced word writes itself, its deletions and its replacements by a later symbol. That is the full neighbourhood of every pair, met
once: an insertion is a deletion seen from the longer word, and a replacement by an earlier symbol one by a later symbol seen from the other word.
Reduced words travel as 64-bit numbers; equal numbers of different words cost a comparison, never a result.

More symbols make fewer words share a reduced word, and neighbourhoods larger. The number of symbols follows from the vocabulary: the
fewest with which a word shares its reduced word with few others, judged on a bounded sample of words. Any number gives the same result.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.samples import capped_sample
from salesmart.sinks.staging import stage

# Letters are A-Z, a-z and U+00C0 to U+00FF; A-Z are lower-cased.
_IN_RUNS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
_LETTERS = "".join(map(chr, [*range(97, 123), *range(0xC0, 0x100)]))

_BASE = 0x9E3779B97F4A7C15
_MASK = 2**64 - 1


@dataclass(frozen=True)
class SpellingSettings:
    """``shortest`` and ``least``: code points and occurrences a word has at least. ``factor``: how many times as frequent a form is.
    ``strike``: a run loses a code point if this divides its checksum. ``shared``: words that share a reduced word with a word, on average, itself included,
    at most; ``sample`` words decide it. ``held``: distinct words a task counts before it passes them on."""

    shortest: int = 7
    least: int = 2
    factor: int = 10
    strike: int = 31
    shared: float = 3.0
    sample: int = 50_000
    symbols: tuple[int, ...] = (3, 4, 5, 6, 8, 10, 12, 16)
    seeds: int = 6
    held: int = 200_000


def runs_of(text: str) -> list[bytes]:
    """The maximal runs of letters, one byte (ISO 8859-1) per code point, A-Z in lower case."""
    return text.encode("latin-1", "replace").translate(_IN_RUNS).split()


def struck(run: bytes, prefix: int, strike: int) -> bytes:
    """The run, without one code point if ``strike`` divides its checksum; ``prefix`` is the checksum of what precedes it."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix)
    return run if h % strike else run[: h % len(run)] + run[h % len(run) + 1 :]


def vocabulary(docs: DataFrame, settings: SpellingSettings) -> DataFrame:
    """word, n: the words with enough code points and occurrences."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def passed_on() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in counts], pa.string())
            made = pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], ["word", "n"])
            counts.clear()
            return made

        for batch in batches:
            for name, text in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist(), strict=True):
                prefix = zlib.crc32(f"{name}:".encode())
                for run, times in Counter(r for r in runs_of(text) if len(r) >= settings.shortest).items():
                    word = struck(run, prefix, settings.strike)
                    if len(word) >= settings.shortest:
                        counts[word] += times
                if len(counts) >= settings.held:
                    yield passed_on()
        yield passed_on()

    rows = docs.where("text IS NOT NULL").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name"), "text")
    return (
        rows.mapInArrow(work, "word string, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= settings.least)
    )


def reduction(symbols: int, seed: int) -> str:
    """The symbol of each letter, as text alongside the letters: a hash of the code point."""
    return "".join("abcdefghijklmnop"[zlib.crc32(f"{seed}:{ord(c)}".encode()) % symbols] for c in _LETTERS)


def choose_reduction(words: DataFrame, settings: SpellingSettings) -> str:
    """The reduction with the fewest symbols under which words share reduced words with few others.

    Of a sample with a share f of the words, a word's company is f times that of all.
    """
    total = words.count()
    chosen = [r["word"] for r in capped_sample(words, "word", settings.sample).select("word").collect()]
    best = ""
    for symbols in settings.symbols:
        company = {}
        for seed in range(settings.seeds):
            best = reduction(symbols, seed)
            table = str.maketrans(_LETTERS, best)
            pairs = sum(c * (c - 1) for c in Counter(w.translate(table) for w in chosen).values())
            company[best] = pairs / max(1, len(chosen)) * total / max(1, len(chosen))
        best = min(company, key=company.get)
        if company[best] + 1 <= settings.shared:
            break
    return best


def _powers(length: int) -> np.ndarray:
    return np.array([pow(_BASE, i, 2**64) for i in range(length)], dtype=np.uint64)


def _key(sums: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit number of the reduced words of one length with these polynomial sums."""
    x = sums + np.uint64((length * 0xD6E8FEB86659FD93) & _MASK)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)
    return (x ^ (x >> np.uint64(29))).view(np.int64)


def keys_of(reduced: np.ndarray) -> np.ndarray:
    """The number of each reduced word; all have one length. ``reduced``: (words, length) symbols from 1."""
    length = reduced.shape[1]
    return _key((reduced * _powers(length)).sum(axis=1, dtype=np.uint64), length)


def neighbours(reduced: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """For words of one length: which word, and the number of a neighbour: itself, its deletions, and its replacements by a later symbol.

    Each neighbour comes once: of a run of equal symbols only the first is deleted.
    """
    count, length = reduced.shape
    powers = _powers(length)
    terms = reduced * powers
    sums = terms.sum(axis=1, dtype=np.uint64)
    before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
    shorter = np.zeros_like(terms)  # what is behind a symbol, one place further to the front
    shorter[:, :-1] = np.cumsum((reduced[:, 1:] * powers[:-1])[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
    first = np.ones(reduced.shape, dtype=bool)
    first[:, 1:] = reduced[:, 1:] != reduced[:, :-1]
    word = np.broadcast_to(np.arange(count)[:, None], reduced.shape)
    rows, found = [np.arange(count), word[first]], [_key(sums, length), _key((before + shorter)[first], length - 1)]
    for symbol in range(2, symbols + 1):
        later = reduced < symbol
        rows.append(word[later])
        found.append(_key((sums[:, None] + (np.uint64(symbol) - reduced) * powers)[later], length))
    return np.concatenate(rows), np.concatenate(found)


def _by_length(texts: list[str], at_once: int = 20_000) -> Iterator[tuple[list[int], np.ndarray]]:
    """Positions and symbols (from 1) of the reduced words of each length."""
    places: dict[int, list[int]] = {}
    for i, text in enumerate(texts):
        places.setdefault(len(text), []).append(i)
    for length, rows in places.items():
        step = max(1, at_once * 16 // length)
        for start in range(0, len(rows), step):
            part = rows[start : start + step]
            flat = np.frombuffer("".join(texts[i] for i in part).encode(), dtype=np.uint8)
            yield part, flat.reshape(len(part), length).astype(np.uint64) - np.uint64(96)


def near_pairs(words: DataFrame, symbols_of: str) -> DataFrame:
    """a, n_a, b, n_b: every two words that differ by one edit, once."""
    symbols = ord(max(symbols_of)) - 96

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("reduced").to_pylist()
            keys = np.zeros(len(texts), dtype=np.int64)
            for rows, reduced in _by_length(texts):
                keys[rows] = keys_of(reduced)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys)], [*batch.schema.names, "key"])

    def write_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, reduced in _by_length(batch.column("reduced").to_pylist()):
                rows, found = neighbours(reduced, symbols)
                yield pa.RecordBatch.from_arrays([pa.array(keys_of(reduced)[rows]), pa.array(found)], ["a_key", "b_key"])

    reduced = F.translate("word", _LETTERS, symbols_of).alias("reduced")
    keyed = stage(words.select("word", "n", reduced).mapInArrow(number, "word string, n bigint, reduced string, key bigint"), "spelling-keyed")
    existing = stage(keyed.select("reduced", "key").distinct(), "spelling-reduced")
    met = existing.select("reduced").mapInArrow(write_out, "a_key bigint, b_key bigint").join(
        existing.select(F.col("key").alias("b_key")).distinct(), "b_key"
    )
    # Words whose reduced words share a number would meet twice without this.
    met = stage(met.distinct(), "spelling-met")
    a = keyed.select(F.col("key").alias("a_key"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    b = keyed.select(F.col("key").alias("b_key"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    once = (F.col("a_key") != F.col("b_key")) | (F.col("a") < F.col("b"))
    one_edit = F.levenshtein(F.col("a"), F.col("b"), 1) == 1
    pairs = met.join(a, "a_key").join(b, "b_key").where(once & one_edit)
    return stage(pairs.select("a", "n_a", "b", "n_b"), "spelling-pairs")


def _roots(forms: DataFrame, largest: int, factor: int) -> DataFrame:
    """word, root: from (word, root) of single steps to the last, in rounds that double the steps.

    Each step multiplies the occurrences, which bounds their number.
    """
    steps = max(1, math.floor(math.log(max(largest, 2), factor)))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        onward = forms.select(F.col("word").alias("root"), F.col("root").alias("further"))
        forms = stage(forms.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")
    return forms


def spelling_variants(docs: DataFrame, settings: SpellingSettings = SpellingSettings()) -> DataFrame:
    """Each word with its n, n_near, form, form_n and root. ``docs``: doc_id, text.

    Words come from maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case. Let h be the crc32 of ``<doc_id>:<run>``; if
    ``strike`` divides h, the run loses its code point h % length. Words have ``shortest`` code points and ``least`` occurrences at least. Two are near
    if one inserted, deleted or replaced code point makes one the other. A word's form is its near word with the largest
    n (ties: the first in code-point order) if that is at least ``factor`` times its own n, else null; the root follows forms to the last.

    Null and empty texts have no words; a null doc_id counts as empty text before the colon. Every row counts, also repeated
    ones. No word at all gives an empty result. Other columns are not looked at.
    """
    words = stage(vocabulary(docs, settings), "spelling-words")
    largest = words.agg(F.max("n")).first()[0]
    if largest is None:
        return words.select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", F.col("n").alias("n_near"), F.col("n").alias("form_n"))
    pairs = near_pairs(words, choose_reduction(words, settings))
    near = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("n_b").alias("n_a"), F.col("a").alias("b"), F.col("n_a").alias("n_b")))
    found = near.groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("form"))).alias("first")
    )
    is_form = -F.col("first.less") >= settings.factor * F.col("n")
    judged = stage(
        words.join(found, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(is_form, F.col("first.form")).alias("form"),
            F.when(is_form, -F.col("first.less")).alias("form_n"),
        ),
        "spelling-judged",
    )
    forms = judged.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    roots = _roots(forms, largest, settings.factor)
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
