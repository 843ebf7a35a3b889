"""Near copies of texts, against all pairs of full sets."""

import os
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmart.llm.minhash import NearCopySettings, near_copies
from salesmart.llm.shingles import shingle_sets
from salesmart.sinks.staging import shared_folder, shuffle_files_removed

SCHEMA = "doc_id bigint, text string, component_id string, kept string"


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return set(zip(*[words[i:] for i in range(width)], strict=False)) if len(words) >= width else {tuple(words)} - {()}


def brute(rows, width):
    sets, parent = {i: shingles(t, width) for i, t in rows}, {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def found_by(spark, rows, **how):
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], SCHEMA)
    return near_copies(docs, NearCopySettings(**how)).collect()


def changed(draw, words, share):
    return [draw.choice(VOCABULARY) if draw.random() < share else w for w in words]


VOCABULARY = [f"w{i}é" for i in range(4000)]


def corpus(seed):
    draw = random.Random(seed)
    passage = draw.choices(VOCABULARY, k=60)
    texts = [draw.choices(VOCABULARY, k=draw.randint(1, 200)) for _ in range(80)]
    texts += [t + passage for t in texts[:30]]
    for base in texts[:12]:
        texts += [changed(draw, base, draw.choice([0.005, 0.01, 0.03, 0.05, 0.1])) for _ in range(5)]
    group = draw.choices(VOCABULARY, k=150)  # one large group of copies, some far from the others
    texts += [group, *[changed(draw, group, draw.choice([0.01, 0.02, 0.04, 0.06])) for _ in range(120)]]
    rows = [" ".join(t) for t in texts]
    rows += [rows[0]] * 20 + [rows[1].upper().replace("É", "é")] * 3
    draw.shuffle(rows)
    return list(enumerate(rows))


def test_components_match_all_pairs(spark):
    for width, how in ((4, {}), (5, {"small": 4, "block": 16})):
        rows = corpus(width)
        expected = brute(rows, width)
        for row in found_by(spark, rows, width=width, **how):
            assert (row["n_shingles"], row["component_id"]) == expected[row["doc_id"]]
            assert row["kept"] == (row["component_id"] == row["doc_id"])


def test_nulls_short_and_long_texts_ties_and_repeated_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One  TWO"), (6, "one two three"), (7, None), (8, "x " * 60_000),
        (9, "x " * 60_000), (10, "a b c d e f"), (10, "a b c d e f"), (None, "one two"), (11, "É one"), (12, "é one"),
    ]
    found = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found_by(spark, rows)}
    assert {f for f in found if f[0] in (1, 2, 3, 7)} == {(i, 0, i, True) for i in (1, 2, 3, 7)}
    assert (5, 1, 4, False) in found and (6, 1, 6, True) in found and (9, 1, 8, False) in found
    assert (10, 2, 10, True) in found and (None, 1, None, False) in found
    assert (11, 1, 11, True) in found and (12, 1, 12, True) in found  # only A-Z are folded
    assert found_by(spark, []) == []


def test_shingles_of_bytes_match_words():
    draw = random.Random(9)
    texts = ["".join(draw.choices("aB é\t\n\x0b\x1c ", k=draw.randint(0, 40))) for _ in range(300)]
    for width in (1, 3, 5):
        sets = shingle_sets([t.encode() for t in texts], width)
        assert [len(s) for s in sets] == [len(shingles(t, width)) for t in texts]
        known = {}
        for text, found in zip(texts, sets, strict=True):
            for shingle in shingles(text, width) if len(found) == 1 else ():
                assert known.setdefault(shingle, found[0]) == found[0]
        assert len(set(known.values())) == len(known)
    assert np.array_equal(shingle_sets([b"a b", b"A  b"], 4)[0], shingle_sets([b"A  b"], 4)[0])


def test_large_ids_beside_nulls(spark):
    rows = [(2**60 + 1, "a b c d e f"), (None, "a b c d e f"), (2**60 + 3, "A b c d e f"), (2**60 + 3, "A b c d e f"), (2**60 + 5, "x y")]
    found = near_copies(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)).collect()
    first = 2**60 + 1
    expected = [(first, first, True), (first + 2, first, False), (first + 2, first, False), (first + 4, first + 4, True), (None, None, False)]
    assert sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in found), key=lambda r: (r[0] is None, r)) == expected


def shuffle_files(spark):
    """Path and bytes of each."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    found = [os.path.join(at, name) for top in folders for at, _, names in os.walk(top.getPath()) for name in names if name.startswith("shuffle_")]
    return {path: os.path.getsize(path) for path in found if os.path.exists(path)}


def test_only_compared_texts_are_gathered_and_nothing_shuffled_stays(spark, settings, tmp_path):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")  # as with larger texts
    draw = random.Random(4)
    texts = [" ".join(str(draw.getrandbits(64)) for _ in range(400)) for _ in range(120)]
    rows = [*enumerate(texts), (200, texts[7] + " more"), (201, texts[8]), (202, texts[9] + " more"), (202, texts[9] + " more")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "docs"))
    staged = lambda: {x for x in os.listdir(shared_folder(spark)) if x.startswith("near-texts-")}
    before, staged_before = shuffle_files(spark), staged()
    found = near_copies(spark.read.parquet(str(tmp_path / "docs")))
    until = time.time() + 20
    left = lambda: sum(size for path, size in shuffle_files(spark).items() if path not in before)
    while left() > sum(map(len, texts)) / 20 and time.time() < until:  # Spark removes them in the background
        time.sleep(0.2)
    assert left() <= sum(map(len, texts)) / 20
    (folder,) = staged() - staged_before
    gathered = spark.read.parquet(f"{shared_folder(spark)}/{folder}").collect()
    assert sorted(r["doc_id"] for r in gathered) == [7, 9, 200, 202, 202]
    for _ in range(2):  # what is returned can be run again
        copies = {r["doc_id"]: r["component_id"] for r in found.collect()}
        assert {i: c for i, c in copies.items() if i != c} == {200: 7, 201: 8, 202: 9} and len(copies) == 123


def test_whole_texts_are_read_twice_for_signatures_and_for_the_compared_ones(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")  # as with larger texts
    rows, read = corpus(5), spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        read.add(1)
        return text

    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("text", counted("text"))
    found = near_copies(docs, NearCopySettings(small=4, block=16)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: root for i, (_, root) in brute(rows, 5).items()}
    assert read.value == 2 * len(rows)


@pytest.mark.parametrize("before", [None, "false", "true"])
def test_the_setting_for_shuffle_files_is_put_back(spark, settings, before):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    if before is not None:
        settings(**{name.replace(".", "__"): before})
    held = spark.conf.getAll.get(name)
    with pytest.raises(ValueError, match="ended"), shuffle_files_removed(spark):
        assert spark.conf.getAll[name] == "true"
        raise ValueError("ended")
    assert spark.conf.getAll.get(name) == held == before
