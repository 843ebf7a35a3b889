"""Personal data: rules against their patterns, the chain against all paths, and what training on few labels finds."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from salesmart.llm import crf, pii
from salesmart.llm.queries import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, found):
    digits = [int(c) for c in re.sub("[^0-9]", "", found)]
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits[::-1]))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    found = [(k, *m.span()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if good(k, m[0])]
    return sorted(found, key=lambda s: (s[1], list(PATTERNS).index(s[0])))


def test_rules_match_their_patterns():
    draw = random.Random(1)
    parts = ["a", "b.c", "@", "@", ".", ".", " ", "-", "+", "1", "25", "255", "4111111111111111", "(", ")", "é", "%", "\n", "_", "+1 (499) 555-6503", "1.2.3.4"]
    texts = ["".join(draw.choices(parts, k=draw.randint(1, 30))) for _ in range(4000)]
    texts += ["a@b.c@d.e", "x@y@z.w", "1.2.3.4.5.6.7.8", "0001.2.3.0255", "1.2.3.256", "4111 1111 1111 1111", "+12 3456-789(0)1", None, "", "x@mail.example.com."]
    texts += [r.replace("1", str(draw.randrange(10))) for r in texts[:500]]
    for text in texts:
        assert pii.rule_spans(text) == brute(text)
    assert sum(len(brute(t)) for t in texts) > 500


def test_very_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a" * 300_000, "a@" * 100_000, "1." * 100_000, "+1" * 100_000, "1 " * 50_000):
        pii.rule_spans(text)
        sum(1 for _ in pii.stretches(text))


def test_stretches_and_pieces():
    text = "ab 1-2  c@d\nxy z9, q 7"
    assert [[text[a:b] for a, b in s] for s in pii.stretches(text)] == [["1-2", "c@d"], ["z9,"], ["7"]]
    places, features = pii.pieces_of(text, next(iter(pii.stretches(text))))
    assert [text[a:b] for a, b in places] == ["1", "-", "2", "c", "@", "d"] and len(features) == 6
    assert pii.tags_of(places, [("email", 8, 11), ("ip", 3, 4)]) == [3, 0, 0, 1, 2, 2]
    assert not any("\t" in f or "\n" in f for fs in features for f in fs)


@pytest.fixture
def chain():
    random_ = np.random.default_rng(3)
    return crf.Chain(random_.normal(size=(7, 3)), random_.normal(size=(3, 3)))


def paths(chain, sequence):
    """All paths with their scores."""
    for path in itertools.product(range(3), repeat=len(sequence)):
        score = sum(chain.weights[f, s] for fs, s in zip(sequence, path, strict=True) for f in fs)
        yield path, score + sum(chain.transitions[a, b] for a, b in itertools.pairwise([0, *path, 0]))


SEQUENCES = [[[0], [1, 2], [], [6]], [[3]], [[4, 5], [0, 1]], [[2], [2], [3], [1], [0]]]


def test_viterbi_and_marginals_against_all_paths(chain):
    scores, lengths = chain.emissions(SEQUENCES)
    best, sure = chain.viterbi(scores, lengths), chain.marginals(scores, lengths)
    labels = np.zeros(best.shape, dtype=int)
    for i, sequence in enumerate(SEQUENCES):
        found = dict(paths(chain, sequence))
        assert tuple(best[i, : lengths[i]]) == max(found, key=found.get)
        total = sum(np.exp(s) for s in found.values())
        for t in range(lengths[i]):
            for state in range(3):
                share = sum(np.exp(s) for p, s in found.items() if p[t] == state) / total
                assert abs(sure[i, t, state] - share) < 1e-9
        assert abs(chain.log_likelihood(scores, lengths, labels)[i] - (found[(0,) * lengths[i]] - np.log(total))) < 1e-9


def test_gradient_against_differences(chain):
    labels = [[0, 1, 2, 0], [2], [1, 1], [0, 0, 2, 1, 1]]
    times = np.array([1.0, 2.0, 3.0, 1.0])
    lengths = np.array([4, 1, 2, 5])
    numbers, states = np.full((4, 5, 2), -1), np.zeros((4, 5), dtype=int)
    for i, sequence in enumerate(SEQUENCES):
        states[i, : lengths[i]] = labels[i]
        for t, found in enumerate(sequence):
            numbers[i, t, : len(found)] = found

    def value():
        scores, n = chain.emissions(SEQUENCES)
        return (chain.log_likelihood(scores, n, states) * times).sum()

    slopes = crf._gradient(chain, numbers, states, lengths, times)
    for slope, array in zip(slopes, (chain.weights, chain.transitions), strict=True):
        for place in np.ndindex(array.shape):
            array[place] += 1e-5
            up = value()
            array[place] -= 2e-5
            down = value()
            array[place] += 1e-5
            assert abs((up - down) / 2e-5 - slope[place]) < 1e-5


def test_batches_hold_every_sequence_once():
    lengths = [5, 1, 9, 3, 3, 100, 2]
    assert sorted(i for b in crf.batches(lengths, 10) for i in b) == list(range(7))


def made(seed, count):
    """Texts in which numbers of 13 digits after 'id' are no cards but those with blanks are; phones come without a plus."""
    draw = random.Random(seed)
    number = lambda n: "".join(draw.choices("0123456789", k=n))
    rows = []
    for _ in range(count):
        text, spans = "", []
        for _ in range(draw.randint(1, 6)):
            text += "".join(draw.choices(["the ", "Of ", "word, ", "v2 ", "(see 4) ", "3.1 ", f"id{number(6)} "], k=draw.randint(1, 4)))
            kind = draw.choice(pii.KINDS)
            found = {
                "email": f"u{number(2)}@host",
                "ip": ".".join([number(3)] * 4),
                "card": " ".join(number(4) for _ in range(4)),
                "phone": f"({number(3)}) {number(3)}-{number(4)}",
            }[kind]
            spans.append((kind, len(text), len(text) + len(found)))
            text += found + draw.choice([", ", " and ", "\n", ". x "])
        rows.append((text, spans))
    return rows


def test_the_field_learns_other_spellings_from_few_labels(spark):
    schema = "text string, spans array<struct<kind: string, start: int, end: int>>, label int"
    labelled = spark.createDataFrame([(t, s, 1) for t, s in [*made(1, 250), (None, []), ("x 1", None)]], schema)
    model = pii.train(labelled)
    right = wrong = missed = 0
    for text, spans in made(2, 200):
        found = set(model.find([text], 0.5)[0])
        right += len(found & set(spans))
        wrong += len(found - set(spans))
        missed += len(set(spans) - found)
    assert right >= 0.97 * (right + missed) and wrong <= 0.03 * right


def test_rows_of_every_sort(spark):
    texts = ["mail a@b.co", None, "", "no numbers", "4111111111111111 then +1 (499) 555-6503, 10.0.0.1", "x" * 100_000 + " 1.2.3.4", "1" * 50_000]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, texts[0], "clash"), (0, texts[0], "clash"), (2**60 + 1, None, "clash")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string").repartition(2)
    for model in (pii.Model({}, None), pii.train(pii.rule_labelled(docs))):
        found = pii.find_personal_data(docs, model).collect()
        assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in rows)
        for r in found:
            base = brute(dict((str(i), t) for i, t, _ in rows)[str(r["doc_id"])])
            assert [r[f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in base) for k in PATTERNS]
            assert r["base_sha256"] == hashlib.sha256(pii.written(base).encode()).hexdigest()
            assert set(pii.written(base).split(",")) <= set(r["spans"].split(",")) | {""}
    empty = docs.limit(0)
    assert pii.find_personal_data(empty, pii.train(pii.rule_labelled(empty))).count() == 0


def test_the_query_over_the_smallest_documents(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = QUERIES["op12_personal_data"](spark, sf).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    for r in found:
        base = pii.written(brute(texts[r["doc_id"]]))
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        if not re.search("[0-9@]", texts[r["doc_id"]] or ""):
            assert r["spans"] == ""
