"""The corpus pipeline stage by stage, and every query of the operators at the smallest scale."""

import random
import re

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from checks.compare import differences, duck
from salesmart.llm import language
from salesmart.llm.queries import ORACLE, QUERIES
from salesmart.sinks.staging import stage
from tests.llm.test_minhash import brute

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_query_is_registered():
    names = set(driver.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), duck(SF), ORACLE[name]) == []


def test_stages_on_the_smallest_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    junk = [(9000, None, "en", "s", 0), (9001, "12 34", "en", "s", 5), (9002, "", None, None, 0)]
    copies = docs.where("doc_id < 20").withColumn("doc_id", docs["doc_id"] + 5000)
    docs = stage(docs.unionByName(spark.createDataFrame(junk, docs.schema)).unionByName(copies), "documents")
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    seen = {}
    for name, function in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()} if name != "packing" else None
        docs = stage(function(spark, docs, SF), name)
        if name != "packing":
            assert docs.columns == COLUMNS
            seen[name] = (before, [r["doc_id"] for r in docs.collect()])
        else:
            assert docs.where("offset + length > 1024").count() == 0
            mixed = seen["mixing"][1]
            assert docs.where("start = 0").count() == len(mixed)
    before, after = seen["language"]
    assert set(before) - set(after) == {9000, 9001, 9002}
    before, after = seen["toxicity"]
    dropped = set(before) - set(after)
    assert len(dropped & toxic) >= 0.6 * len(toxic) and len(dropped - toxic) <= 0.02 * len(before) + len(dropped & set(range(5000, 5020)))
    before, after = seen["near_copies"]
    expected = {root for _, root in brute(list(before.items()), 5).values()}
    assert set(after) == expected and len(after) == len(expected)


def test_the_language_stage_rejects_what_the_model_does_not_know(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    draw = random.Random(2)
    noise = " ".join("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(3, 9))) for _ in range(60))
    alien = {9000: "Это предложение написано по-русски и никому не известно", 9001: "这是一个中文文档没有人认识", 9002: noise, 9003: noise[:40]}
    clean = {9010: "and the", 9011: "und", 9012: "le", 9013: "de la que", 9014: "The thing is of the"}
    planted = [(i, text, None, "s", len(text)) for i, text in (alien | clean).items()]
    docs = docs.unionByName(spark.createDataFrame(planted, docs.schema))
    kept = {r["doc_id"] for r in corpus_pipeline.language_stage(spark, docs, SF).collect()}
    assert {r["doc_id"] for r in docs.collect()} - kept == set(alien)


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SF), "empty")
        assert docs.count() == 0


def test_repeated_rows_and_null_ids_in_the_near_copy_stage(spark):
    rows = [(1, "a b c d e f g", "en", "s", 1)] * 3 + [(2, "A b c d e f g", "en", "s", 1), (None, "a b c d e f g", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = corpus_pipeline.near_copy_stage(spark, docs, SF).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept) == [(False, 1), (True, 0)]


def test_rows_with_equal_ids_and_different_texts_are_kept(spark):
    words = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(5, words, "a"), (5, "quite another text with words of its own", "b"), (5, words.upper(), "c"), (3, words + " ", "d"), (9, None, "e"), (9, "", "f")]
    schema = "doc_id bigint, text string, row_number string"
    docs = spark.createDataFrame(rows, schema)
    kept = corpus_pipeline.near_copy_stage(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(r["row_number"] for r in kept.collect()) == ["b", "d", "e", "f"]


def test_stages_keep_columns_with_clashing_names(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    extra = {name: docs["doc_id"] for name in ("lang_pred", "score", "known", "language_found", "toxic", "is_toxic", "chain_scores", "row", "p_toxic")}
    docs = stage(docs.withColumns(extra), "clashing")
    for name, function in corpus_pipeline.STAGES[:3]:
        docs = stage(function(spark, docs, SF), name)
        rows = docs.collect()
        assert rows and all(r[column] == r["doc_id"] for r in rows for column in extra)


def test_the_language_stage_decides_by_language(spark):
    """What speaks for every language alike is rejected even if all of it were known."""
    schema = "doc_id bigint, text string, lang string"
    rows = [(i, "kalo mitu bera" if i % 2 else "grun schel oft", "aa" if i % 2 else "bb") for i in range(400)]
    model = language.train(spark.createDataFrame(rows, schema))
    asked = [(1, "kalo mitu", None), (2, "grun", None), (3, "日本 日本", None), (4, None, None), (5, "12", None)]
    found = language.with_judgement(spark.createDataFrame(asked, schema), model, "found").collect()
    assert {r["doc_id"]: r["found"]["lang_pred"] for r in found if r["doc_id"] in (1, 2)} == {1: "aa", 2: "bb"}
    kept = lambda least, ahead: {r["doc_id"] for r in language.in_a_language(spark.createDataFrame(asked, schema), model, least, ahead).collect()}
    assert kept(0.4, 1.05) == kept(0.0, 1.9) == {1, 2}
