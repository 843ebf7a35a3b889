"""How much of whole texts is passed to Python functions at once."""

from pyspark.sql import functions as F

from salesmart.llm import minhash
from salesmart.sinks.staging import small_batches, stage

BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_batches_are_cut_by_bytes_unless_the_session_says_how(spark, settings):
    rows = spark.range(0, 300, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("text"))

    def sizes(batches):
        import pandas as pd

        for batch in batches:
            yield pd.DataFrame({"bytes": [int(batch["text"].str.len().sum())]})

    largest = lambda: max(r["bytes"] for r in rows.mapInPandas(sizes, "bytes bigint").collect())
    with small_batches(spark):
        assert largest() <= 5_000_000
    settings(**{BYTES.replace(".", "__"): "1000000"})
    with small_batches(spark):
        assert largest() <= 1_200_000


def test_the_near_copy_step_passes_small_batches(spark, monkeypatch):
    limits, before = {}, spark.conf.get(BYTES)

    def noted(df, name):
        limits[name] = int(spark.conf.get(BYTES).rstrip("b"))
        return stage(df, name)

    monkeypatch.setattr(minhash, "stage", noted)
    docs = stage(spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, None)], "doc_id bigint, text string"), "documents")
    assert sorted(r["component_id"] for r in minhash.near_copies(docs).collect()) == [1, 1, 3]
    assert {"near-signed", "near-links"} <= set(limits) and set(limits.values()) == {4 << 20} and spark.conf.get(BYTES) == before
