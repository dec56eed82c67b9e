"""The registered queries: each operator with production parameters on its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import classifier, codebooks, collocations, dac, mixing, packing, pieces, pivots, quality, sanitise, sharding, simhash, warc
from .common import table


def op1_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_vectors(table(spark, sf_dir, "embeddings"))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op4_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.find(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_documents(table(spark, sf_dir, "documents"))


def op6_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dac.token_documents(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.duplicate_documents(table(spark, sf_dir, "documents"))


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codebooks.compress_vectors(table(spark, sf_dir, "embeddings"))


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_documents(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_shard, op2_near_vectors, op3_mix, op4_private, op5_quality, op6_classify, op7_token_ids,
        op8_warc, op9_simhash, op10_pack, op11_codes, op12_pieces, op13_collocations,
    )
}
SQL: dict[str, str] = {"op2_near_vectors": pivots.SQL, "op11_codes": codebooks.SQL, "op13_collocations": collocations.SQL}
