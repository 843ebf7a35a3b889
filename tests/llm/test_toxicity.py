"""The classifier chain on planted toxic texts."""

import random

import numpy as np

from salesmart.llm import toxicity
from salesmart.llm.toxicity import ChainSettings

SCHEMA = "doc_id bigint, text string, p_toxic string, toxic string"
WORDS = [f"{a}{b}{c}" for a in ("ba", "le", "mo", "ru") for b in ("ta", "ne", "so") for c in ("k", "li", "dor")]


def labelled(seed, count):
    draw = random.Random(seed)
    rows, labels = [], []
    for i in range(count):
        words, toxic = draw.choices(WORDS, k=draw.randint(5, 60)), int(draw.random() < 0.15)
        if toxic:  # words of two kinds, or inflected forms of a stem
            bad = draw.choice([["idiot"], ["pathetic", "scum"], [f"vequ{draw.choice(WORDS)}"]])
            for word in bad:
                words.insert(draw.randrange(len(words)), word)
        rows.append((i, " ".join(words), "clash", "clash"))
        labels.append((i, toxic))
    return rows, labels


def test_held_out_texts(spark):
    rows, labels = labelled(1, 900)
    docs = spark.createDataFrame(rows, SCHEMA)
    chain = toxicity.train(docs, spark.createDataFrame(labels[:600], "doc_id bigint, toxic int"))
    assert len(chain.weights) == 3 and [len(w) for w in chain.weights] == [len(chain.index) + 1 + i for i in range(3)]
    found = {r["doc_id"]: r for r in toxicity.score(docs, chain).collect()}
    assert all(found[i]["toxic"] == bool(t) for i, t in labels[600:])
    assert sorted(sorted(kind) for kind in chain.kinds) == [["idiot"], ["pathetic", "scum"]]
    text = {i: t.split() for i, t, *_ in rows}
    for i, toxic in labels[600:]:
        for number, kind in enumerate(chain.kinds):
            assert (found[i][f"p_kind_{number + 1}"] > 0.5) == bool(toxic and set(kind) & set(text[i]))


def test_telling_words_are_grouped_by_their_company():
    random_ = np.random.default_rng(3)
    toxic = (random_.random(600) < 0.2).astype(float)
    kind = random_.integers(0, 3, 600)
    x = (random_.random((600, 8)) < 0.1).astype(np.float32)
    for word, its_kind in enumerate([0, 0, 1, 1]):
        x[:, word] = (toxic > 0) & (kind == its_kind)
    names = ["b", "a", "c", "d", "e", "f", "g", "beg-"]
    x[:, 7] = toxic  # a beginning is no word
    groups = toxicity.telling_words(names, x, toxic, ChainSettings())
    assert sorted(sorted(g) for g in groups) == [[0, 1], [2, 3]]
    assert toxicity.telling_words(names, x, np.zeros(600), ChainSettings()) == [[], []]
    assert toxicity.telling_words(names[:1], x[:, :1], toxic, ChainSettings(kinds=3)) == [[0], [], []]
    assert toxicity.telling_words([], x[:0, :0], toxic[:0], ChainSettings()) == [[], []]


def test_later_models_are_fed_out_of_fold_probabilities():
    random_ = np.random.default_rng(0)
    x = (random_.random((400, 5)) < 0.3).astype(float)
    first = x[:, 0]
    chain = toxicity.Chain(ChainSettings(kinds=1), list("abcde"))
    chain.fit(x, np.column_stack([first, first]), np.arange(400) % 4)
    assert chain.weights[1][5] > 0.5  # the second category leans on the first one's probability


def test_nulls_empty_tables_and_no_labels(spark):
    rows, labels = labelled(2, 60)
    rows += [(1000, None, "", ""), (1001, "", "", ""), (None, "idiot", "", "")]
    labels += [(1000, 1), (None, 1), (5, None), (4, labels[4][1])]
    docs = spark.createDataFrame(rows, SCHEMA)
    chain = toxicity.train(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    found = toxicity.score(docs, chain)
    assert found.columns == ["doc_id", "text", "p_kind_1", "p_kind_2", "p_toxic", "toxic"]
    assert not any(r["toxic"] for r in found.where("text IS NULL OR text = ''").collect())
    assert toxicity.score(docs.limit(0), chain).count() == 0
    nothing = toxicity.train(docs, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert not any(r["toxic"] for r in toxicity.score(docs, nothing).collect())
