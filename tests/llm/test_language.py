"""Language identification on invented languages, judged on held-out documents."""

import random
import zlib

from pyspark.sql import functions as F

from salesmart.llm import language
from salesmart.llm.samples import hash_sample_per

SCHEMA = "doc_id bigint, text string, lang string, lang_pred string"
SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["ß", "chen", "gru", "öl"], "cc": ["ña", "el", "que", "sí"]}


def documents(seed, count, words=12):
    draw = random.Random(seed)
    rows = []
    for i in range(count):
        lang = draw.choice(list(SYLLABLES))
        text = " ".join("".join(draw.choices(SYLLABLES[lang], k=draw.randint(1, 4))) for _ in range(words))
        rows.append((i, text, lang, "clash"))
    return rows


def test_held_out_accuracy_and_rule(spark):
    rows = documents(1, 600)
    docs = spark.createDataFrame(rows, SCHEMA)
    model = language.train(docs)
    assert model.languages == ["aa", "bb", "cc"]
    found = language.identify(docs, model).withColumn("held", language.held_out(F.col("doc_id"))).collect()
    assert {r["doc_id"] for r in found if r["held"]} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r["lang_pred"] == r["lang"] for r in found if r["held"]) >= 0.97 * sum(r["held"] for r in found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_unseen_words_back_off_to_shorter_ngrams(spark):
    model = language.train(spark.createDataFrame(documents(2, 400), SCHEMA))
    assert "kalomitukalomitu" not in model.words
    assert model.predict("kalomitukalomitu", {})[0] == "aa"
    assert model.predict("grugrugruchenöl", {})[0] == "bb"
    assert model.backed_off("♥").tolist() == model.backed_off("☃").tolist()
    assert model.predict("日本", {})[0] in model.languages


def test_labels_of_held_out_documents_are_not_learned(spark):
    rows = [(i, "kalo mitu", "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else "aa", "") for i in range(80)]
    assert language.train(spark.createDataFrame(rows, SCHEMA)).languages == ["aa"]


def test_no_letters_nulls_long_texts_and_empty_tables(spark):
    model = language.train(spark.createDataFrame(documents(3, 200), SCHEMA))
    texts = [None, "", " \n", "123 !?_", "k" * 200_000, "ka lo " * 50_000]
    docs = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)], SCHEMA)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(docs, model).collect()}
    assert [found[i] for i in range(4)] == [("und", 0.0)] * 4
    assert found[5][0] == "aa"
    nothing = language.train(docs)
    assert nothing.languages == []
    assert {r["lang_pred"] for r in language.identify(docs, nothing).collect()} == {"und"}
    assert language.identify(docs.limit(0), model).count() == 0


def test_a_rare_language_is_learned_from_a_large_table(spark):
    common = [(i, "kalo mitu", "aa", "") for i in range(6000)]
    rare = [(10_000 + i, "chengru ölß", "bb", "") for i in range(40)]
    docs = spark.createDataFrame(common + rare, SCHEMA)
    model = language.train(docs, language.TrainingSettings(max_training_docs=100))
    assert model.predict("chengru", {})[0] == "bb"
    sample = hash_sample_per(docs, "doc_id", "lang", 100).groupBy("lang").count().collect()
    found = {r["lang"]: r["count"] for r in sample}
    assert found["bb"] == 40 and 30 <= found["aa"] <= 95
