"""A corpus pipeline: language, exact copies, near copies, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from factpanel.llm import exact_dedup, language, near_dedup, packing
from factpanel.llm.common import stored
from factpanel.llm.queries import tokenizer_file


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled documents teach."""
    return language.accepted(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return exact_dedup.drop_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by 80 percent of their five-word shingles the one with the smallest doc_id."""
    return near_dedup.drop_near_duplicates(docs, words=5, percent=80)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence of 4096 ids and its place there."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"), end_id=2, rest=True)


STAGES = [
    ("language", known_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("packing", packed),
]

#: SQL cannot express the language model, the tokenizer or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
