"""A corpus from raw documents to training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its output is written as Parquet and
read again as the next one's ``docs``. All but the last return the columns of ``documents``; further columns pass through.
Every stage gives an empty result for an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import language, minhash, mixing, packing, toxicity
from salesmart.llm.marks import marks_of
from salesmart.llm.names import free_name
from salesmart.sinks.staging import stage

#: SQL cannot express the trained models; tests compare each stage with brute force instead.
ORACLE_SQL = None

#: Share of a text, by words, that the language model must have seen; letter noise has about 0.05, a document 0.9 and more.
LEAST_KNOWN = 0.4


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which language identification finds a language of the corpus.

    Rejected are texts that are null or without a letter, those that speak for no language more than for the others, and those of
    which the model of the corpus's languages knows too little, such as letter noise; a short text of known words stays, uncertain
    as its language may be. A language is what the labels call one: what is labelled noise is learned. Where no document
    has a language to learn from, those with a letter are kept.
    """
    model = language.train(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return language.in_a_language(docs, model, LEAST_KNOWN)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, by a chain trained on the labels of those here. Null and empty texts stay."""
    chain = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = free_name(docs.columns, "is_toxic")
    return toxicity.toxic_column(docs, chain, name).where(~F.col(name)).select(*docs.columns)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group of near copies; shingles are of five words.

    Documents without doc_id or words are nobody's copy and stay. Where doc_ids repeat, rows are told apart by a number: of rows that
    are near copies one stays, and rows with equal doc_id and different texts all do.
    """
    nameless, named = docs.where("doc_id IS NULL"), docs.where("doc_id IS NOT NULL")
    if named.groupBy("doc_id").count().where("count > 1").isEmpty():
        # What goes is mostly the shorter list. Texts whose bit among its marks is not set stay without a shuffle.
        dropped = stage(minhash.near_copies(named).where("NOT kept").select("doc_id"), "dropped-documents")
        marks = marks_of(dropped, ["doc_id"])
        kept = marks.likely(named).join(dropped, "doc_id", "left_anti").select(*docs.columns)
        return marks.others(named).unionByName(kept).unionByName(nameless)
    number = free_name(docs.columns, "row_number")
    rows = stage(named.withColumn(number, F.monotonically_increasing_id()), "numbered-documents")
    copies = minhash.near_copies(rows.select(F.col(number).alias("doc_id"), "text"))
    groups = stage(copies.select(F.col("doc_id").alias(number), "component_id"), "copy-groups")
    first = rows.select(number, "doc_id").join(groups, number).groupBy("component_id").agg(F.min(F.struct("doc_id", number)).alias("first"))
    kept = stage(first.select(f"first.{number}"), "kept-documents")
    return rows.join(kept, number, "left_semi").select(*docs.columns).unionByName(nameless)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights: a document comes once per whole repetition."""
    return mixing.mix_documents(docs).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: one row per piece of a document, with its ids, sequence and offset."""
    specials = packing.special_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return packing.pack_documents(docs, ranks, public_tokenizers.PATTERN, specials=specials)


STAGES = [
    ("language", language_stage),
    ("toxicity", toxicity_stage),
    ("near_copies", near_copy_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
