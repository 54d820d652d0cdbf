"""The queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from termloom.llm import decontam, linededup, lm, media, neardup, packing, sharding, tokens, toxicity, warc
from termloom.llm.common import read_table, scratch_path, text_batches


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.op1_query(read_table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), capacity=4096, end_id=1)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return decontam.op3_query(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.op4_query(read_table(spark, sf_dir, "pages"))


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return tokens.op5_query(read_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), scratch_path(spark, "token-counts"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op6_query(read_table(spark, sf_dir, "documents"))


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return media.op7_query(read_table(spark, sf_dir, "documents"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return lm.op8_query(read_table(spark, sf_dir, "documents"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return neardup.op9_query(read_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return toxicity.op10_query(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_packing": op2_packing,
    "op3_decontamination": op3_decontamination,
    "op4_warc": op4_warc,
    "op5_tokens": op5_tokens,
    "op6_sharding": op6_sharding,
    "op7_media": op7_media,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_toxicity": op10_toxicity,
}

SQL: dict[str, str] = {
    "op1_line_dedup": linededup.OP1_SQL,
    "op4_warc": warc.OP4_SQL,
}
