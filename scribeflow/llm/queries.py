"""Registered queries of the training-data operators, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scribeflow.llm import (bm25, chat, collocations, decontaminate, fm_dedup, licenses, ngram_join, oracle, packing, rlbwt_dedup, sharding,
                            token_output, toxicity, whitening)
from scribeflow.llm.common import tables


def vocabulary(name: str) -> str:
    """Where a public tokenizer lies; the same place on every worker."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, tables(spark, sf_dir, "labels")))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(tables(spark, sf_dir, "documents"), sharding.layout())


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(tables(spark, sf_dir, "documents")).drop("text_hash")


def op4_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25.search(tables(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(tables(spark, sf_dir, "documents"), tables(spark, sf_dir, "benchmark"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(tables(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents")
    return packing.pack(packing.pieces(docs, vocabulary("byte_bpe_50k.json")))


def op8_fm_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_dedup.dedup(tables(spark, sf_dir, "documents"))


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.round_trip(tables(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op10_rlbwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlbwt_dedup.dedup(tables(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(tables(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(tables(spark, sf_dir, "documents"))


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk = tables(spark, sf_dir, "conversations")
    probe = spark.createDataFrame([(-1, k, role, "</s>[INST] ok [/INST]") for k, role in enumerate(("user", "assistant"))],
                                  "conv_id long, turn long, role string, text string")
    records = talk.select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.round_trip(chat.canonical(records, "conv_id"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_sharding": op2_sharding,
    "op3_ngram_join": op3_ngram_join,
    "op4_bm25": op4_bm25,
    "op5_decontaminate": op5_decontaminate,
    "op7_licenses": op7_licenses,
    "op6_packing": op6_packing,
    "op8_fm_dedup": op8_fm_dedup,
    "op9_token_output": op9_token_output,
    "op10_rlbwt_dedup": op10_rlbwt_dedup,
    "op11_whitening": op11_whitening,
    "op12_collocations": op12_collocations,
    "op13_chat": op13_chat,
}
ORACLE: dict[str, str] = {"op3_ngram_join": oracle.NGRAM_JOIN, "op8_fm_dedup": oracle.WORD_REPEATS, "op12_collocations": collocations.ORACLE}
