"""Water-filling and seeded repetitions."""

import pytest

from salesmart.llm import mixing
from salesmart.llm.mixing import MixSettings

SCHEMA = "doc_id bigint, text string, source string, size string"


def water_fill(sizes, settings):
    """Clamp, hand the excess to the others by weight, until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: settings.weights[i % len(settings.weights)] for i, s in enumerate(names)}
    left, open_, target = sum(sizes.values()) * settings.budget, set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > sizes[s] * settings.max_epochs + 1e-9}
        if not full:
            return target | {s: weight[s] * level for s in open_}
        for s in full:
            target[s] = sizes[s] * settings.max_epochs
            left -= target[s]
        open_ -= full
    return target


def documents(spark, counts):
    rows = [(1000 * i + n, "w " * (1 + n % 7), s, "clash") for i, (s, k) in enumerate(counts.items()) for n in range(k)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("budget", [0.3, 1.0, 1.5, 2.0])
def test_targets_and_taken_words(spark, budget):
    settings = MixSettings(budget=budget, buckets=8)
    counts = {"b": 400, "a": 30, "ä": 90, "z": 5, None: 60}
    plan = mixing.mix_plan(documents(spark, counts).drop("size"), settings).toPandas()
    plan["taken"] = plan["whole"] * plan["size"] + plan["part"]
    groups = plan.groupby("source", dropna=False)
    sizes = {s: 0 for s in counts} | {(None if s != s else s): int(v) for s, v in groups["size"].sum().items()}
    expected = water_fill(sizes, settings)
    for source, group in groups:
        source = None if source != source else source
        assert group["target"].iloc[0] == pytest.approx(expected[source])
        assert (group["source_size"] == sizes[source]).all()
        assert abs(group["taken"].sum() - expected[source]) <= 1
    assert (plan["taken"] <= 2 * plan["size"]).all()
    assert (plan["part"] > 0).groupby(plan["source"], dropna=False).sum().sum() >= 0


def test_reruns_agree_and_nothing_depends_on_partitions(spark):
    docs = documents(spark, {"a": 50, "b": 200})
    once, again = (
        {tuple(r) for r in mixing.mix_plan(d).select("doc_id", "whole", "part").collect()}
        for d in (docs, docs.repartition(7, "text"))
    )
    assert once == again


def test_nulls_empty_texts_and_repeated_rows(spark):
    rows = [(None, None, None, "x"), (1, "", "a", "x"), (2, "\t one\n two ", "a", "x"), (2, "\t one\n two ", "a", "x")]
    plan = mixing.mix_plan(spark.createDataFrame(rows, SCHEMA))
    found = sorted((r["doc_id"] or 0, r["size"], r["whole"] * r["size"] + r["part"]) for r in plan.collect())
    assert [f[:2] for f in found] == [(0, 0), (1, 0), (2, 2), (2, 2)]
    assert sum(f[2] for f in found) == 6  # 150 % of 4 words
    assert mixing.mix_plan(spark.createDataFrame([], SCHEMA)).count() == 0


def test_documents_come_out_as_often_as_planned(spark):
    docs = documents(spark, {"a": 20, "b": 100})
    plan = {r["doc_id"]: r for r in mixing.mix_plan(docs).collect()}
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    times = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    for doc_id, row in plan.items():
        assert times.get(doc_id, 0) == row["whole"] + (0 < row["size"] <= 2 * row["part"])


def test_null_and_repeated_ids_come_out_as_often_as_planned(spark):
    rows = [(None, f"null {i}", "a", "x") for i in range(30)] + [(7, f"same {i}", "b", "y") for i in range(30)] + [(8, "one more", "b", "z")] * 3
    docs = spark.createDataFrame(rows, SCHEMA)
    plan = mixing.mix_plan(docs).collect()
    out = mixing.mix_documents(docs).collect()
    for source in "ab":
        planned = sum(r["whole"] + (0 < r["size"] <= 2 * r["part"]) for r in plan if r["source"] == source)
        assert sum(r["source"] == source for r in out) == planned > 0
    assert {(r["doc_id"], r["size"]) for r in out} == {(None, "x"), (7, "y"), (8, "z")}


def test_plan_has_no_python(spark):
    plan = mixing.mix_documents(documents(spark, {"a": 3}))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
