"""Ranked search, against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np

from salesmart.llm.positions import ImpactLists, RankSettings, _blocks, rank_documents, terms_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, score string, rank string, term int"
ITEMS = "item_id bigint, text string, doc_id string"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=20):
    counts = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    size, total = len(counts), sum(c.total() for _, c in counts)
    holding = Counter(t for _, c in counts for t in c)
    asked = {}
    for i, text in set(items):
        if i is not None and terms(text):
            asked.setdefault(i, Counter()).update(terms(text))
    out = set()
    for item, words in asked.items():
        scores = []
        for doc_id, c in counts:
            m = 75 + (25 * c.total() * size) // total
            score = sum(
                n * math.floor(1000 * math.log((2 * size + 2) / (2 * holding[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 12 * m))
                for w, n in words.items() if c[w]
            )
            if score > 0 and doc_id is not None:
                scores.append((-score, doc_id))
        out |= {(item, rank, d, -s) for rank, (s, d) in enumerate(sorted(scores)[:k], 1)}
    return out


def ranked(spark, docs, items, **how):
    docs = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in docs], DOCS).repartition(4)
    items = spark.createDataFrame([(i, t, "z") for i, t in items], ITEMS)
    rows = [tuple(r) for r in rank_documents(docs, items, RankSettings(**how)).collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def test_terms():
    text = "Ärger it's A1-b ÉCOLE\x00x\x7fy 日本 [z]"
    assert [t.decode() for t in terms_of(text.encode())] == terms(text)


def made(seed, count):
    draw = random.Random(seed)
    words = ["w" + str(i) for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    docs = [(i, " ".join(draw.choices(words, weights, k=draw.randint(1, 60)))) for i in range(count)]
    items = [(i, " ".join(draw.choices(words, weights, k=draw.randint(1, 12)))) for i in range(15)]
    return docs, items


def test_against_all_documents(spark):
    docs, items = made(1, 700)
    docs += [(1000 + i, docs[3][1]) for i in range(60)]  # ties
    docs += [(2, docs[5][1]), (9000, None), (9001, ""), (9002, "... --"), (None, docs[3][1]), (9003, "w1 " * 30_000)]
    items += [(50, "W1 w1 w1"), (51, None), (52, ""), (53, "unheard"), (None, "w1"), (0, items[0][1]), (1, "w5 w5")]
    for how in ({}, {"block_docs": 50, "step": 1}, {"block_postings": 300, "step": 2, "asked": 40}, {"k": 3, "merging": 1}):
        assert ranked(spark, docs, items, **how) == brute(docs, items, how.get("k", 20))


def test_empty_tables(spark):
    assert ranked(spark, [], [(1, "a")]) == set()
    assert ranked(spark, [(1, "a")], []) == set()
    assert ranked(spark, [(1, None)], [(1, "a")]) == set()


def test_reading_stops_before_the_end_of_the_lists():
    draw = np.random.default_rng(2)
    count = 4000
    terms, times = np.tile(np.arange(3, dtype=np.int32), count), draw.integers(1, 30, 3 * count)
    times[30:90] = 100_000
    lists = ImpactLists([100] * count, np.arange(0, 3 * count + 1, 3), terms, times, 3, count, 100 * count)
    docs, scores, read = lists.best(np.arange(3), np.array([5, 6, 7]), 20, 4, 0)
    assert set(docs) == set(range(10, 30)) and read < 3 * count / 10
    again = lists.best(np.arange(3), np.array([5, 6, 7]), 20, 4, int(scores.max()) + 1)
    assert len(again[0]) == 0 and again[2] <= read


def test_blocks_hold_every_document_once():
    import pyarrow as pa

    sizes = [3, 0, 7, 1, 20, 2, 2, 2, 9]
    lists = [[j % 5 for j in range(n)] for n in sizes]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(9), pa.int64()), pa.array(sizes, pa.int64()), pa.array(lists, pa.list_(pa.int32())), pa.array(lists, pa.list_(pa.int32()))],
        ["doc_id", "n", "terms", "times"],
    )
    for settings in (RankSettings(block_docs=2), RankSettings(block_postings=8), RankSettings()):
        ids, seen = [], []
        for block_ids, lengths, offsets, terms, _ in _blocks(iter([batch.slice(0, 4), batch.slice(4)]), settings):
            ids += block_ids.tolist()
            seen += [terms[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            assert len(lengths) <= settings.block_docs
        assert ids == list(range(9)) and seen == lists
