"""The corpus pipeline: from documents to packed training sequences.

Each stage works on all documents that the one before kept. The first three return whole rows of ``documents``, the last
one row for each piece of a packed document.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import bm25_packing, byte_rnn, cotraining, minmax_dedup
from riskframe.llm.common import staged, table

#: A document stays if some language has at least this share of its positions; four equal languages have 0.25 each.
LEAST_LANGUAGE = 0.3
#: A document goes if label 1 (good) is less likely than this.
LEAST_QUALITY = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without letters and those in which no language stands out."""
    named = byte_rnn.identify(docs, keep=True)
    return named.where((F.col("lang_pred") != byte_rnn.NONE) & (F.col("score") >= LEAST_LANGUAGE)).select(docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the co-trained classifiers reject."""
    scored = cotraining.score(docs, table(spark, sf_dir, "labels"), keep=True)
    return scored.where(F.col("score") >= LEAST_QUALITY).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of each group of near-duplicates."""
    return minmax_dedup.unique(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 2048 ids."""
    packed = bm25_packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [("language", language), ("quality", quality), ("near_duplicates", near_duplicates), ("packing", packing)]

#: Trained models, signatures and retrieval are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
