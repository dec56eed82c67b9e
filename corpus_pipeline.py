"""The corpus pipeline: documents in, packed training sequences out.

Quality rules reject outliers, of each group of near copies one document stays, personal data and
what gives it away is masked, sources are mixed to their target weights, and what is left is packed
into sequences. Each stage works on all that the one before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lapak.llm import mixing, packing, quality, sanitise, simhash
from lapak.llm.common import table, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_good(docs)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def mask_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their personal data masked."""
    return sanitise.sanitise(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.take(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their place in a sequence."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", keep_good),
    ("near_copies", keep_one_copy),
    ("private", mask_private),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: Fingerprints, robust estimates and token ids have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
