"""A training-data pipeline over ``documents``: five stages, each written as Parquet and read by the next.

1. quality: co-trained classifier; documents it rejects go.
2. simhash: one document of each group of near copies stays.
3. substrings: words of repeated 20-word passages go (see ``superkmer_dedup``).
4. mixing: documents repeat or go by the rates that meet the target weights of the domains.
5. tokens: byte-level BPE ids of each text, with byte offsets for decoding.

All but the last return the columns of ``documents``.  A missing row never fails a stage: every
operator states what it does with nulls, empty texts, repeated rows and empty tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from panelkit.llm import byte_bpe, cotrain_quality, simhash_dedup, soft_mixing, superkmer_dedup
from panelkit.llm.common import materialise, table

#: tokens of the domains clean, low, toxic that the fourth stage aims at, as shares of the tokens it gets: clean documents
#: stay as they are, what is left of the toxic ones goes, the low ones are repeated up to two in a hundred
MIX = (1.0, 0.02, 0.0)
#: largest rate: no document is repeated more often, even if a target stays out of reach (the gap is returned by ``mix``)
MOST = 4.0


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return cotrain_quality.keep(docs, table(spark, sf_dir, "labels"))


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.deduplicate(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return superkmer_dedup.deduplicate(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return soft_mixing.resample(docs, table(spark, sf_dir, "labels"), MIX, most=MOST)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [("quality", quality), ("simhash", simhash), ("substrings", substrings), ("mixing", mixing), ("tokens", tokens)]

#: classifiers and tokenizers are not SQL; the tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
