"""Training-data pipeline over ``documents``: five stages, each one operator.

Toxic documents go; one document of each group of near copies stays; passages that an earlier
document has are cut; documents that hold a benchmark item go; the rest is packed into
sequences.  ``pack`` returns a row for each piece, the other stages the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scribeflow.llm import decontaminate, ngram_join, packing, rlbwt_dedup, toxicity
from scribeflow.llm.common import stage, tables
from scribeflow.llm.queries import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.kept(docs, tables(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rlbwt_dedup.cleaned(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, tables(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs, vocabulary("byte_bpe_50k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("leaks", drop_leaks),
    ("packing", pack),
]

#: SQL cannot express the stages; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, name)
    return docs
