"""Language identification by words first, with backoff to character n-grams.

The model counts, per language, words and the character n-grams of words (with ``^`` and ``$`` at
the ends). A known word adds its log frequency in each language to that language's score. An unseen word is
split into its longest n-grams; those that are unseen too are covered by n-grams one character shorter, down to
single characters. Scores are per-language log likelihoods; the confidence is the share of the best language when the mean
log likelihood per word is turned into probabilities over the words of the text.

Training reads a bounded, hash-chosen part of the labelled documents: ``max_training_docs`` over all languages, drawn per language,
so that a rare one keeps its documents however large the table is. Counting is one distributed
aggregation; the model that is sent to the tasks is bounded by ``max_words`` and ``max_grams`` per
language. Scoring sees whole texts and nothing but the text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.names import free_name
from salesmart.llm.samples import hash_sample_per
from salesmart.sinks.staging import stage

#: A word is a run of letters.
WORD = re.compile(r"[^\W\d_]+")

#: Longest n-gram, n-grams an unseen word is recognised by, and unseen words whose scores are remembered per task.
_LONGEST, _TELLING, _REMEMBERED = 5, 4, 200_000

UNDETERMINED = "und"


@dataclass(frozen=True)
class TrainingSettings:
    max_training_docs: int = 12_000
    max_words: int = 20_000
    max_grams: int = 30_000
    seed: int = 11


class Model:
    """Log frequencies: one row per word and per n-gram, one column per language."""

    def __init__(self, found: pd.DataFrame):
        """``found``: lang, kind (``word``, ``gram1``, …), item, times; one row per language and item."""
        self.languages = sorted(found["lang"].unique())
        self.words, self.word_rows = self._log_frequencies(found[found["kind"] == "word"], 0)
        self.grams: dict[str, int] = {}
        rows = []
        for n in range(1, _LONGEST + 1):
            index, more = self._log_frequencies(found[found["kind"] == f"gram{n}"], len(self.grams))
            self.grams |= index
            rows.append(more)
        self.gram_rows = np.concatenate(rows)

    @classmethod
    def from_values(cls, values: dict) -> Model:
        model = cls.__new__(cls)
        vars(model).update(values)
        return model

    def _log_frequencies(self, found: pd.DataFrame, first: int) -> tuple[dict[str, int], np.ndarray]:
        """Where each item's row is, counted from ``first``, and the rows."""
        places, items = pd.factorize(found["item"], sort=True)
        table = np.full((len(items), len(self.languages)), 0.5)
        table[places, pd.Index(self.languages, dtype=object).get_indexer(found["lang"])] += found["times"].to_numpy(dtype=float)
        return {item: first + i for i, item in enumerate(items)}, np.log(table / (table.sum(axis=0) + 0.5))

    def backed_off(self, word: str) -> np.ndarray:
        """Scores of an unseen word: the mean over its n-grams, where an unseen one counts as its shorter n-grams do."""
        rows: list[int] = []
        shares: list[float] = []

        def cover(text: str, n: int, share: float) -> None:
            n = min(n, len(text))
            count = len(text) - n + 1
            for i in range(count if n else 0):
                gram = text[i : i + n]
                row = self.grams.get(gram)
                if row is None:
                    cover(gram, n - 1, share / count)
                else:
                    rows.append(row)
                    shares.append(share / count)

        cover(f"^{word}$", _LONGEST, 1.0)
        return np.array(shares) @ self.gram_rows[rows] if rows else np.zeros(len(self.languages))

    def predict(self, text: str | None, remembered: dict[str, np.ndarray]) -> tuple[str, float]:
        words = Counter(WORD.findall(text.lower())) if text else None
        if not words or not self.languages:
            return UNDETERMINED, 0.0
        rows, row_times, unseen, unseen_times = [], [], [], []
        for word, times in words.items():
            row = self.words.get(word)
            if row is not None:
                rows.append(row)
                row_times.append(times)
                continue
            scores = remembered.get(word)
            if scores is None:
                if len(remembered) > _REMEMBERED:
                    remembered.clear()
                scores = remembered[word] = self.backed_off(word)
            unseen.append(scores)
            unseen_times.append(times)
        total = np.array(row_times) @ self.word_rows[rows] if rows else np.zeros(len(self.languages))
        if unseen:
            total = total + np.array(unseen_times) @ np.array(unseen)
        best = int(total.argmax())
        shares = np.exp(np.clip(total - total[best], -700, 0))
        return self.languages[best], float(shares[best] / shares.sum())

    def known_share(self, text: str | None, remembered: dict[str, float]) -> float:
        """Mean over the words of a text: 1 for a word of the model, else the share of the word's n-grams that are in it."""
        words = Counter(WORD.findall(text.lower())) if text else None
        if not words:
            return 0.0
        known = 0.0
        for word, times in words.items():
            if word in self.words:
                known += times
                continue
            share = remembered.get(word)
            if share is None:
                if len(remembered) > _REMEMBERED:
                    remembered.clear()
                ends = f"^{word}$"
                n = min(_TELLING, len(ends))
                count = len(ends) - n + 1
                share = remembered[word] = sum(ends[i : i + n] in self.grams for i in range(count)) / count
            known += times * share
        return known / words.total()


def held_out(doc_id: Column) -> Column:
    """Documents that are kept from training: a fixed quarter by a checksum of the id. Null ids are held out."""
    remainder = F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(4))
    return F.coalesce(remainder == 2, F.lit(True))


def train(docs: DataFrame, settings: TrainingSettings = TrainingSettings()) -> Model:
    """A model of the documents that are not held out and have a text and a language.

    The n-grams are taken from the distinct words of each language. Languages are the labels seen. Without any
    training document the model has no language and predicts none.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: dict[str, Counter] = {}
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                counts.setdefault(lang, Counter()).update(WORD.findall(text.lower()))
            yield frame((lang, "word", item, n) for lang, found in counts.items() for item, n in found.items())

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: dict[str, Counter] = {}
            for lang, word in zip(batch["lang"], batch["item"], strict=True):
                ends = f"^{word}$"
                counts.setdefault(lang, Counter()).update(
                    ends[i : i + n] for n in range(1, _LONGEST + 1) for i in range(len(ends) - n + 1)
                )
            yield frame((lang, f"gram{len(item)}", item, n) for lang, found in counts.items() for item, n in found.items())

    def frame(rows) -> pd.DataFrame:
        return pd.DataFrame(list(rows), columns=["lang", "kind", "item", "times"])

    schema = "lang string, kind string, item string, times bigint"

    def summed(found: DataFrame) -> DataFrame:
        return stage(found.groupBy("lang", "kind", "item").agg(F.sum("times").alias("times")), "language-counts")

    chosen = hash_sample_per(labelled.select("doc_id", "lang", "text"), "doc_id", "lang", settings.max_training_docs, settings.seed)
    word_counts = summed(chosen.select("lang", "text").mapInPandas(words, schema))
    counted = word_counts.unionByName(summed(word_counts.select("lang", "item").mapInPandas(grams, schema)))
    # The most frequent items of each language and kind, by a threshold on a histogram of counts: no sort, no large group.
    sizes = counted.groupBy("lang", "kind", "times").agg(F.count(F.lit(1)).alias("items")).collect()
    least: dict[tuple[str, str], int] = {}
    for lang, kind in {(r["lang"], r["kind"]) for r in sizes}:
        limit = settings.max_words if kind == "word" else settings.max_grams
        kept = 0
        for times, number in sorted(((r["times"], r["items"]) for r in sizes if (r["lang"], r["kind"]) == (lang, kind)), reverse=True):
            if kept + number > limit and kept:
                break
            kept += number
            least[lang, kind] = times
    if not least:
        return Model(frame([]))
    limits = F.create_map(*[F.lit(v) for (lang, kind), t in least.items() for v in (f"{lang}\t{kind}", t)])
    enough = F.col("times") >= F.element_at(limits, F.concat_ws("\t", "lang", "kind"))
    return Model(counted.where(enough).select("lang", "kind", "item", "times").toArrow().to_pandas())


def with_judgement(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """``docs`` with a column ``name``: struct of lang_pred and score, as ``identify`` gives them, and known, as ``Model.known_share``."""
    # Plain values, bounded by max_words and max_grams.
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    @F.pandas_udf("lang_pred string, score double, known double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scores: dict[str, np.ndarray] = {}
        shares: dict[str, float] = {}
        model_ = Model.from_values(shared.value)
        for texts in batches:
            found = [(*model_.predict(text, scores), model_.known_share(text, shares)) for text in texts]
            yield pd.DataFrame(found, columns=["lang_pred", "score", "known"])

    return docs.withColumn(name, judge("text"))


def in_a_language(docs: DataFrame, model: Model, least_known: float, ahead: float = 1.05) -> DataFrame:
    """The rows of ``docs`` whose text is in one of the model's languages.

    Two conditions decide. ``identify`` finds a language, with a score of ``ahead`` times an even split over the languages at least: a text
    of which nothing is known, such as one in an unlearned script, speaks for no language. And the model knows at least a share of
    ``least_known`` of the text, by words, since letter noise may well look more like one language than another. A short text of known
    words stays, even where several languages have them. A null text, or one without a letter, is in none.
    """
    name = free_name(docs.columns, "language_found")
    judged = with_judgement(docs, model, name)
    even = 1.0 / max(1, len(model.languages))
    found, score, known = (F.col(name)[field] for field in ("lang_pred", "score", "known"))
    clear = score >= min(1.0, ahead * even)
    return judged.where((found != UNDETERMINED) & clear & (known >= least_known)).select(*docs.columns)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1), predicted from the whole text alone.

    A null text, or one without a letter, is ``und`` with score 0; so is every text if the model knows no
    language. Equal scores go to the language first in order. Columns lang_pred and score of ``docs`` are replaced. Repeated
    rows are predicted alike. An empty table gives an empty result.
    """
    docs = docs.drop("lang_pred", "score")
    # Plain values, bounded by max_words and max_grams.
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        remembered: dict[str, np.ndarray] = {}
        known = Model.from_values(shared.value)
        for texts in batches:
            found = [known.predict(text, remembered) for text in texts]
            yield pd.DataFrame(found, columns=["lang_pred", "score"])

    name = free_name(docs.columns, "lang_found")
    return docs.withColumn(name, predict("text")).select(*docs.columns, f"{name}.lang_pred", f"{name}.score")


def recognised(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows of ``docs`` of whose text, the mean over its words, at least a share of ``least`` is in the model.

    See ``Model.known_share``: length does not matter, and languages may be mixed. A null text, or one without a letter, is not
    recognised; nor is any if the model knows no language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    @F.pandas_udf("double")
    def known_share(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        remembered: dict[str, float] = {}
        known = Model.from_values(shared.value)
        for texts in batches:
            yield pd.Series([known.known_share(text, remembered) for text in texts], dtype="float64")

    return docs.where((known_share("text") >= least) & F.col("text").rlike(r"\p{L}"))
