"""Vector packing: limits, little padding, and exact round trips of the tokens."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from salesmart.llm.packing import Limits, pack_documents, pack_examples
from salesmart.llm.queries import QUERIES

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
SCHEMA = "doc_id bigint, text string, ids string, sequence_id string"


def packed(spark, texts, limits=Limits()):
    rows = [(i, t, "clash", "clash") for i, t in texts]
    return pack_documents(spark.createDataFrame(rows, SCHEMA), RANKS, PATTERN, limits).toPandas()


def check_sequences(found, limits):
    found = found.sort_values(["sequence_id", "offset"])
    ends = found.groupby("sequence_id")["length"].cumsum()
    assert (found["offset"] == ends - found["length"]).all()
    assert ends.max() <= limits.tokens
    assert found.groupby("sequence_id").size().max() <= limits.segments


def test_every_id_once_and_equal_to_the_tokenizer(spark):
    draw = random.Random(1)
    texts = [" ".join(draw.choices(["alpha", "ünïcode", "don't", "a\n\nb", "  gap", "123", "日本語"], k=draw.randint(0, 900))) for _ in range(120)]
    texts += [None, "", " ", "<|endoftext|>", "x" * 60_000, texts[0], texts[0]]
    found = packed(spark, list(enumerate(texts)))
    check_sequences(found, Limits())
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    for doc_id, pieces in found.sort_values("start").groupby("doc_id"):
        ids = tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids + [0]
        assert b"".join(pieces["ids"]) == np.array(ids, dtype="<u4").tobytes()
        assert (pieces["doc_tokens"] == len(ids)).all()
        assert list(pieces["start"]) == [0, *np.cumsum(pieces["length"])[:-1]]


def test_little_padding(spark):
    draw = random.Random(2)
    found = packed(spark, [(i, "word " * draw.randint(1, 2500)) for i in range(600)])
    lengths = found.groupby("sequence_id")["length"].sum()
    assert (1024 - lengths).sum() < 0.01 * lengths.sum() + 1024 * 8


def test_segment_limit_and_null_ids(spark):
    limits = Limits(tokens=64, segments=3, loss_tokens=64, window=50)
    found = packed(spark, [(None, "a"), (None, "a"), *[(i, "b") for i in range(20)]], limits)
    check_sequences(found, limits)
    assert len(found) == 22 and found["doc_id"].isna().sum() == 2


def test_empty_table(spark):
    assert len(packed(spark, [])) == 0


def test_examples_keep_all_three_limits(spark):
    draw = random.Random(3)
    limits = Limits(tokens=1000, segments=6, loss_tokens=300, window=64)
    rows = []
    for i in range(400):
        tokens = draw.randint(1, 600)
        rows.append((i, tokens, 1 + i % 3, draw.randint(0, min(tokens, 250))))
    examples = spark.createDataFrame(rows, "example_id bigint, tokens bigint, segments bigint, loss_tokens bigint")
    found = pack_examples(examples, limits, partitions=1).toPandas().merge(examples.toPandas(), on="example_id")
    assert len(found) == 400
    sums = found.groupby("sequence_id")[["tokens", "segments", "loss_tokens"]].sum()
    assert (sums <= [1000, 6, 300]).all().all()
    least = max(found["tokens"].sum() / 1000, found["segments"].sum() / 6, found["loss_tokens"].sum() / 300)
    assert len(sums) <= 1.15 * least + 1  # near the bound of the scarcest dimension


def test_an_example_over_a_limit_fails(spark):
    examples = spark.createDataFrame([(1, 5000, 1, 1)], "example_id bigint, tokens bigint, segments bigint, loss_tokens bigint")
    with pytest.raises(Exception, match="fits no sequence"):
        pack_examples(examples).collect()


def test_large_ids_beside_nulls(spark):
    large = [2**60 + 1, None, 2**60 + 3]
    found = pack_documents(spark.createDataFrame([(i, "a") for i in large], "doc_id bigint, text string").coalesce(1), RANKS, PATTERN)
    assert sorted(r["doc_id"] for r in found.collect() if r["doc_id"]) == [2**60 + 1, 2**60 + 3]
    examples = spark.createDataFrame([(i, 1, 1, 1) for i in large], "example_id bigint, tokens bigint, segments bigint, loss_tokens bigint")
    found = pack_examples(examples.coalesce(1))
    assert dict(found.dtypes)["example_id"] == "bigint"
    assert sorted(r["example_id"] for r in found.collect() if r["example_id"]) == [2**60 + 1, 2**60 + 3]


def test_the_query_gives_the_ids_of_the_unchanged_tokenizer(spark, tmp_path):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y  ", "plain  text", "a\n<|endoftext|>\nb", "<|endoftext", None, " "]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = {}
    for r in sorted(QUERIES["op1_packing"](spark, str(tmp_path)).collect(), key=lambda r: (r["doc_id"], r["start"])):
        found.setdefault(r["doc_id"], []).append((r["ids_crc32"], r["doc_tokens"]))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for doc_id, text in enumerate(texts):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert found[doc_id] == [(zlib.crc32(np.array(ids, dtype="<u4").tobytes()), len(ids))]


def test_the_query_over_the_smallest_documents(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = QUERIES["op1_packing"](spark, sf).toPandas()
    check_sequences(found, Limits())
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert set(found["doc_id"]) == set(texts)
    for doc_id, pieces in found.sort_values("start").groupby("doc_id"):
        ids = [*tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids, 0]
        crcs = [zlib.crc32(np.array(ids[s : s + n], dtype="<u4").tobytes()) for s, n in zip(pieces["start"], pieces["length"], strict=True)]
        assert list(pieces["ids_crc32"]) == crcs and pieces["length"].sum() == len(ids)
