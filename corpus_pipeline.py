"""Corpus preparation: quality, exact copies, near copies, secrets, packing.

Every stage works on all rows of the one before. The first four return the columns of ``documents``;
the last one returns the pieces of the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from bitloom.llm import exact, packing, quality, secret_scan, shingle_join
from bitloom.llm.common import stored, table
from bitloom.session import prepare_session


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly trained scorer accepts."""
    prepare_session(spark)
    return quality.accepted(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    prepare_session(spark)
    return exact.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies, the document with the smallest id."""
    prepare_session(spark)
    return shingle_join.near_deduplicated(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with found secrets replaced by a mark."""
    prepare_session(spark)
    return secret_scan.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 ids."""
    prepare_session(spark)
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", accept_quality), ("exact dedup", drop_copies), ("near dedup", drop_near_copies),
          ("secrets", mask_secrets), ("packing", pack)]

# Training, min-hashes and tokenizers have no SQL; a test compares the stages with plain re-computations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare_session(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
