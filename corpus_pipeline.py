"""The corpus pipeline: five stages over documents, each written and read again.

quality   rows that the quality classifier rejects go
exact     of rows with equal texts the one with the smallest doc_id stays
near      of each group of near-duplicate rows the one with the smallest doc_id stays
mix       rows are repeated or left out to balance the sources
encode    every remaining row's text as byte-level BPE tokens, with digests

All stages but the last return the columns of documents, extra ones too, whatever their
names. The classifier learns from labels and from the documents that it is given.

Defined cases, stage by stage: null and empty texts score the prior of the labels in the
quality stage and stay where that is 0.5 or more; they are equal texts in the exact stage, of
which one stays; they are near nothing; they have no tokens. A null doc_id loses
against any other of an equal text, is near nothing and is mixed as any other row. Rows that repeat whole
are copies: one stays. Of texts that tie the smallest doc_id stays. An empty table goes
through every stage as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from presswork.llm import bpe, exact_dedup, mixing, ngram_join, quality
from presswork.plans.lineage import cut
from presswork.sources.tables import table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def balance(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality", classify), ("exact", drop_copies), ("near", drop_near_copies), ("mix", balance), ("encode", encode)]

#: The quality classifier can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
