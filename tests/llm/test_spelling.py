"""Spelling variants, against all pairs of words."""

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from salesmart.llm.queries import QUERIES
from salesmart.llm.spelling import SpellingSettings, _by_length, keys_of, neighbours, spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, word string, n string, form int"


def one_edit(word):
    """A pattern-free neighbourhood: the word with each place left out, and with each place open."""
    for i in range(len(word)):
        yield ("out", word[:i] + word[i + 1 :])
        yield ("open", word[:i] + "*" + word[i + 1 :])


def brute(docs, settings=SpellingSettings()):
    counts = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % settings.strike == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= settings.shortest and n >= settings.least}
    near = {w: set() for w in words}
    open_ = {}
    for w in words:
        for kind, key in one_edit(w):
            if kind == "open":
                open_.setdefault(key, set()).add(w)
            elif key in words:
                near[w].add(key)
                near[key].add(w)
    for group in open_.values():
        for a, b in itertools.permutations(group, 2):
            near[a].add(b)
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        if best is not None and words[best] >= settings.factor * words[w]:
            forms[w] = best
    out = set()
    for w, n in words.items():
        root = w
        while root in forms:
            root = forms[root]
        out.add((w, forms.get(w), root, n, len(near[w]), words[forms[w]] if w in forms else None))
    return out


def variants(spark, docs, **how):
    df = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in docs], SCHEMA).repartition(3)
    rows = [tuple(r) for r in spelling_variants(df, SpellingSettings(**how)).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def made(seed):
    draw = random.Random(seed)
    bases = ["".join(draw.choices("abcdeéz", k=draw.randint(7, 9))) for _ in range(12)]
    docs = []
    for i in range(150):
        words = []
        for _ in range(draw.randint(0, 90)):
            word = draw.choice(bases)
            if draw.random() < 0.25:
                at, kind = draw.randrange(len(word)), draw.randrange(3)
                word = word[:at] + ("" if kind == 0 else draw.choice("abcé")) + word[at + (kind < 2) :]
            words.append(word.upper() if draw.random() < 0.1 else word)
        docs.append((i, draw.choice([" ", ", ", "1", "Ā", "_"]).join(words)))
    return docs


@pytest.mark.parametrize("how", [{}, {"symbols": (2,), "seeds": 1}, {"symbols": (16,), "held": 5}, {"factor": 3, "shortest": 5}])
def test_against_all_pairs(spark, how):
    docs = made(4) + [(None, "abcdeabcde abcdeabcde"), (900, None), (901, ""), (902, "12 _ 3"), (3, "aaaaaaa aaaaaaa aaaaaaaa aaaaaaaa")]
    docs += [(903, "aaaaaaab " * 400 + "÷ÿÀxÀxÀ " * 3 + "x" * 30_000)] + [(904, "abcdeaz")] * 5
    settings = SpellingSettings(**{k: v for k, v in how.items() if k in ("factor", "shortest")})
    assert variants(spark, docs, **how) == brute(docs, settings)


def test_forms_are_followed_to_the_last(spark):
    docs = [(i, "bbbbbbbb " * 3000 + "bbbbbbbc " * 250 + "bbbbbbcc " * 20 + "bbbbbccc bbbbbccc") for i in range(2)]
    rows = {r[0]: r for r in variants(spark, docs, strike=2**40)}
    assert rows["bbbbbccc"][1:3] == ("bbbbbbcc", "bbbbbbbb") and rows["bbbbbbbb"][1:3] == (None, "bbbbbbbb")


def test_no_words(spark):
    assert variants(spark, []) == set() and variants(spark, [(1, None), (2, "short words")]) == set()


def test_neighbourhoods_of_reduced_words():
    words = ["".join(w) for n in (3, 4) for w in itertools.product("abc", repeat=n)]
    key = {}
    for rows, reduced in _by_length(words):
        key |= {words[i]: int(k) for i, k in zip(rows, keys_of(reduced), strict=True)}
    assert len(set(key.values())) == len(words)
    for rows, reduced in _by_length(words):
        which, found = neighbours(reduced, 3)
        for i, word in enumerate(words[r] for r in rows):
            mine = found[which == i].tolist()
            assert len(mine) == len(set(mine))
            out = {word[:j] + word[j + 1 :] for j in range(len(word))}
            later = {word[:j] + s + word[j + 1 :] for j in range(len(word)) for s in "abc" if s > word[j]}
            assert {key[w] for w in out | later | {word} if w in key} == set(mine) & set(key.values())
            assert len(mine) == len(out | later | {word})
    assert np.dtype(np.int64) == found.dtype


def test_the_query_over_the_smallest_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = QUERIES["op13_spelling_variants"](spark, sf)
    assert found.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    assert {tuple(r) for r in found.collect()} == brute(docs)
