"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factpanel.llm import (
    alignment, bitsliced, chat, exact_dedup, grammar, language, merkle, near_dedup, packing, pair_index, token_groups, warc, wordpiece,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Where the box keeps the file of a public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return packing.pack_documents(documents, tokenizer_file("word_bpe_49k.json"), end_id=2)


def op2_repair_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return grammar.encode_and_read(documents, tokenizer_file("byte_bpe_50k.json"), end_id=0)


def op3_boundary_chain_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.write_and_read(_table(spark, sf_dir, "pages"))


def op4_viterbi_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def op5_longest_match_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.count_tokens(_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op6_event_sourced_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "\\### Assistant: </turn> ok"
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"),
    )
    return chat.written_and_read(rows.unionByName(planted))


def op7_bit_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return bitsliced.search(vectors, F.col("vec_id") % 20 == 0, k=20, scale=64)


def op8_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_index.round_trip_digests(_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op9_heavy_hitter_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(_table(spark, sf_dir, "documents"))


def op10_odd_sketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), words=2, percent=80)


def op11_pointer_jump_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    return alignment.alignment(_table(spark, sf_dir, "documents"), *paths)


def op12_pointer_jump_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return merkle.manifest(documents, merkle.without_line_ends(documents))


def op13_token_group_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_groups.jaccard_components(_table(spark, sf_dir, "documents"), words=4, percent=85)


def queries() -> dict[str, Query]:
    return {
        "op1_harmonic_packing": op1_harmonic_packing,
        "op2_repair_shards": op2_repair_shards,
        "op3_boundary_chain_warc": op3_boundary_chain_warc,
        "op4_viterbi_language": op4_viterbi_language,
        "op5_longest_match_counts": op5_longest_match_counts,
        "op6_event_sourced_chat": op6_event_sourced_chat,
        "op7_bit_sliced_topk": op7_bit_sliced_topk,
        "op8_pair_index_bpe": op8_pair_index_bpe,
        "op9_heavy_hitter_dedup": op9_heavy_hitter_dedup,
        "op10_odd_sketch_near_dedup": op10_odd_sketch_near_dedup,
        "op11_pointer_jump_alignment": op11_pointer_jump_alignment,
        "op12_pointer_jump_proofs": op12_pointer_jump_proofs,
        "op13_token_group_join": op13_token_group_join,
    }
