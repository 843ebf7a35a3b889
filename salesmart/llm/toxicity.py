"""Toxicity by a classifier chain of logistic models.

The categories are predicted one after another. Each model is linear in the features of a text and in the probabilities
that the earlier models gave, so that a later category can build on an earlier one. In training, those probabilities are out of
fold: each document's come from models that have not seen it, as they will in use.

Features are the presence of words and of word beginnings, which carry over inflected forms. Those that are
most unevenly spread over toxic and other documents are chosen by counts over the training documents.

The labels have one class, ``toxic``, the last category. The earlier ones are kinds of toxic text found in the training documents:
the words that toxic texts hold far more often than others are grouped by the company they keep, and a toxic text is of the kinds whose
words it holds. So they follow the corpus, whatever its languages.

Training reads a bounded, hash-chosen sample of labelled documents (``max_training_docs``); counting is distributed, and the driver
fits models on a matrix of at most that many rows and ``max_features`` columns. Scoring sees every whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.names import free_name
from salesmart.llm.samples import capped_sample
from salesmart.sinks.staging import stage

WORD = re.compile(r"[^\W\d_]+")

#: Lengths of word beginnings used as features.
_BEGINNINGS = (4, 5, 6)


@dataclass(frozen=True)
class ChainSettings:
    """``kinds``: how many kinds of toxic text precede the label in the chain. ``least_surprise``: deviations from its expected number
    of toxic texts from which a word tells of toxicity."""

    kinds: int = 2
    least_surprise: float = 4.0
    threshold: float = 0.5
    max_training_docs: int = 10_000
    max_features: int = 512
    folds: int = 4
    penalty: float = 0.05
    rounds: int = 400
    seed: int = 23

    @property
    def categories(self) -> list[str]:
        return [*[f"kind_{i + 1}" for i in range(self.kinds)], "toxic"]


def features_of(text: str | None) -> set[str]:
    """Words, and beginnings of longer words marked with a dash."""
    words = set(WORD.findall(text.lower())) if text else set()
    return words.union(f"{w[:n]}-" for w in words for n in _BEGINNINGS if len(w) > n)


def telling_words(names: list[str], x: np.ndarray, toxic: np.ndarray, settings: ChainSettings) -> list[list[int]]:
    """Features that tell of toxicity, in groups: one per kind, the strongest first.

    Words, not beginnings, count if toxic texts hold them more often than chance gives. A kind starts with the word that is strongest
    and least often met with the earlier kinds' first words; every other word joins the kind whose first word it is met with most, by
    cosine over toxic texts, or else the smaller kind. Ties go to the smaller name and the earlier kind.
    """
    groups: list[list[int]] = [[] for _ in range(settings.kinds)]
    share = toxic.mean() if len(toxic) else 0.0
    expected = x.sum(axis=0) * share
    surprise = (x[toxic > 0].sum(axis=0) - expected) / np.sqrt(expected * (1 - share) + 1)
    words = [i for i, name in enumerate(names) if not name.endswith("-") and surprise[i] >= settings.least_surprise]
    words.sort(key=lambda i: (-surprise[i], names[i]))
    held = x[toxic > 0]
    held /= np.maximum(np.linalg.norm(held, axis=0), 1e-9)
    together = held.T @ held
    firsts: list[int] = []
    for group in groups[: len(words)]:
        rest = [i for i in words if i not in firsts]
        first = max(rest, key=lambda i: (surprise[i] * (1 - max((together[i, f] for f in firsts), default=0.0)), -words.index(i)))
        firsts.append(first)
        group.append(first)
    for word in words:
        if word not in firsts:
            met = [together[word, f] for f in firsts]
            best = met.index(max(met)) if max(met) > 0 else min(range(len(firsts)), key=lambda k: len(groups[k]))
            groups[best].append(word)
    return groups


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int) -> np.ndarray:
    """Weights, the last of them the intercept, by accelerated gradient descent on the penalised mean log loss."""
    x = np.column_stack([x, np.ones(len(x), dtype=x.dtype)])
    ridge = np.full(x.shape[1], penalty / max(1, len(x)))
    ridge[-1] = 0
    vector = np.ones(x.shape[1], dtype=x.dtype)
    for _ in range(20):  # the largest curvature, by power iteration
        vector = x.T @ (x @ vector)
        vector /= np.linalg.norm(vector) or 1
    step = 1 / (0.25 * np.linalg.norm(x @ vector) ** 2 / len(x) + ridge.max() + 1e-9)
    weights = ahead = np.zeros(x.shape[1])
    for i in range(rounds):
        error = sigmoid(x @ ahead.astype(x.dtype)) - y
        slope = x.T @ error.astype(x.dtype) / len(x) + ridge * ahead
        following = ahead - step * slope
        ahead = following + i / (i + 3) * (following - weights)
        weights = following
    return weights


class Chain:
    """Fitted models. Without training documents every probability is 0."""

    def __init__(self, settings: ChainSettings, features: list[str]):
        self.settings = settings
        self.index = {name: i for i, name in enumerate(features)}
        self.beginnings = {name[:-1] for name in features if name.endswith("-")}
        self.weights: list[np.ndarray] = []
        self.kinds: list[list[str]] = []

    def fit(self, x: np.ndarray, y: np.ndarray, folds: np.ndarray) -> None:
        s = self.settings
        for category in range(y.shape[1]):
            target, out_of_fold = y[:, category], np.zeros(len(x))
            for fold in range(s.folds):
                held = folds == fold
                if held.any() and not held.all():
                    weights = fit_logistic(x[~held], target[~held], s.penalty, s.rounds)
                    out_of_fold[held] = sigmoid(x[held] @ weights[:-1].astype(x.dtype) + weights[-1])
            self.weights.append(fit_logistic(x, target, s.penalty, s.rounds))
            x = np.column_stack([x, out_of_fold.astype(x.dtype)])

    def predict(self, text: str | None) -> list[float]:
        """The probability of each category."""
        out: list[float] = []
        if not self.weights:
            return [0.0] * len(self.settings.categories)
        words = set(WORD.findall(text.lower())) if text else set()
        present = [self.index[w] for w in words & self.index.keys()]
        for n in _BEGINNINGS:
            present += [self.index[f"{b}-"] for b in {w[:n] for w in words if len(w) > n} & self.beginnings]
        for weights in self.weights:
            score = weights[present].sum() + weights[-1] + np.dot(weights[len(self.index) : -1], out)
            out.append(float(sigmoid(score)))
        return out


def train(docs: DataFrame, labels: DataFrame, settings: ChainSettings = ChainSettings()) -> Chain:
    """A chain for ``docs`` (doc_id, text) with ``labels`` (doc_id, toxic 0 or 1). Rows with nulls do not train.

    Of several texts under one doc_id the first in order trains; of several labels the highest counts.
    """
    spark = docs.sparkSession
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    chosen = (
        capped_sample(usable, "doc_id", settings.max_training_docs, settings.seed)
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    # One text per labelled doc_id, so that the bound holds for rows too, however often an id is repeated.
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = stage(texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")), "toxicity-sample")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: dict[str, list[int]] = {}
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                for name in [*features_of(text), ""]:
                    held = found.setdefault(name, [0, 0])
                    held[0] += 1
                    held[1] += toxic
            yield pd.DataFrame([(name, *held) for name, held in found.items()], columns=["name", "docs", "held"])

    counted = (
        sample.mapInPandas(count, "name string, docs bigint, held bigint")
        .groupBy("name")
        .agg(F.sum("docs").alias("docs"), F.sum("held").alias("held"))
        .where((F.col("docs") >= 5) | (F.col("name") == ""))
    )
    totals = counted.where(F.col("name") == "").first()
    if totals is None:
        return Chain(settings, [])
    best = counted.where(F.col("name") != "").orderBy(_surprise(totals).desc(), "name").limit(settings.max_features)
    chain = Chain(settings, [row["name"] for row in best.select("name").collect()])

    known = spark.sparkContext.broadcast(chain.index)  # at most max_features names

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            present = [sorted(known.value[f] for f in features_of(text) if f in known.value) for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "present": present, "toxic": batch["toxic"]})

    rows = sample.mapInPandas(encode, "doc_id bigint, present array<int>, toxic int").orderBy("doc_id").collect()
    x, toxic = np.zeros((len(rows), len(chain.index)), dtype=np.float32), np.array([r["toxic"] for r in rows], dtype=float)
    for i, row in enumerate(rows):
        x[i, row["present"]] = 1
    names = list(chain.index)
    groups = telling_words(names, x, toxic, settings)
    chain.kinds = [[names[i] for i in group] for group in groups]
    kinds = [x[:, group].any(axis=1) * toxic for group in groups]
    chain.fit(x, np.column_stack([*kinds, toxic]), np.arange(len(rows)) % settings.folds)
    return chain


def _surprise(totals):
    """How many deviations a feature's share of toxic texts is from that of all documents."""
    share = max(1e-6, min(1 - 1e-6, totals["held"] / totals["docs"]))
    expected = F.col("docs") * share
    return F.abs(F.col("held") - expected) / F.sqrt(expected * (1 - share) + 1)


def toxic_column(docs: DataFrame, chain: Chain, name: str) -> DataFrame:
    """``docs`` with the boolean column ``name``, as ``toxic`` of ``score``; other columns are kept, whatever their names."""
    found = score(docs.select(F.col("text"), F.struct(*docs.columns).alias("row")), chain)
    return found.select("row.*", F.col("toxic").alias(name))


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """``docs`` with ``p_<category>`` for each category, and ``toxic``: the last probability reaches the threshold.

    A null or empty text is scored like one that has none of the features. Repeated rows are scored alike. Columns of ``docs`` with
    the names of the new ones are replaced. An empty table gives an empty result.
    """
    names = [f"p_{c}" for c in chain.settings.categories]
    docs = docs.drop(*names, "toxic")
    # Plain values, at most max_features weights per category.
    shared = docs.sparkSession.sparkContext.broadcast((chain.index, chain.weights))
    settings = chain.settings

    @F.pandas_udf("array<double>")
    def probabilities(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index, weights = shared.value
        known = Chain(settings, list(index))
        known.weights = weights
        for texts in batches:
            yield pd.Series([known.predict(text) for text in texts], dtype=object)

    found = free_name(docs.columns, "chain_scores")
    scored = docs.withColumn(found, probabilities("text"))
    values = [F.col(found)[i].alias(name) for i, name in enumerate(names)]
    toxic = F.col(found)[len(names) - 1] >= chain.settings.threshold
    return scored.select(*docs.columns, *values, toxic.alias("toxic"))
