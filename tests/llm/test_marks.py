"""Lists of keys as bitmaps, and what the near-copy step shuffles."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from salesmart.llm import minhash
from salesmart.llm.marks import marks_of
from salesmart.sinks.staging import stage
from tests.llm.test_minhash import brute, corpus


@pytest.mark.parametrize(("listed", "most"), [(0, 99), (1, 99), (4000, 999), (4000, 2)])
def test_marks_lose_no_key_and_pass_on_few_others(spark, listed, most):
    keys = stage(spark.range(listed).select((F.col("id") * 7).alias("k"), F.lit("t").alias("t")), "keys")
    marks = marks_of(keys, ["k", "t"], most)
    rows = spark.range(30_000).select(F.col("id").cast("int").alias("k"), F.lit("t").alias("t"), F.col("id").alias("marks_block"))
    rows = rows.unionByName(spark.createDataFrame([(None, "t", 0), (7, None, 0)], "k int, t string, marks_block bigint"))
    likely, others = marks.likely(rows), marks.others(rows)
    assert likely.columns == others.columns == rows.columns
    assert likely.count() + others.count() == 30_002
    assert likely.where("t IS NOT NULL").join(keys, ["k", "t"]).count() == listed and others.join(keys, ["k", "t"]).isEmpty()
    assert most == 2 or likely.count() <= listed + 0.1 * 30_000


def test_texts_are_found_without_a_shuffle(spark, settings, monkeypatch):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")  # as with larger texts
    rows, plans = corpus(6), {}

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stage(df, name)

    monkeypatch.setattr(minhash, "stage", noted)
    docs = stage(spark.createDataFrame(rows, "doc_id bigint, text string"), "documents")
    found = {r["doc_id"]: r["component_id"] for r in minhash.near_copies(docs).collect()}
    assert found == {i: root for i, (_, root) in brute(rows, 5).items()}
    assert "hashpartitioning" not in plans["near-texts"]
    plan = plans["near-grouped"]  # keys are shuffled for the join, but first held against the marks
    assert plan.index("SortMergeJoin") < plan.index("hashpartitioning") < plan.index("LeftSemi")


def test_kept_texts_need_no_shuffle_in_the_pipeline(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    rows = corpus(7)
    docs = stage(spark.createDataFrame(rows, "doc_id bigint, text string"), "documents")
    kept = corpus_pipeline.near_copy_stage(spark, docs, "")
    expected = {root for _, root in brute(rows, 5).values()}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(expected)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 1 and plan.count("LeftAnti") == 2  # those without a mark, and those with one that stay
