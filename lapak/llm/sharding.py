"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered 0 .. n-1 in a total order, and a keyed permutation of these numbers shuffles
them: place ``p`` goes to shard ``p % shards``, slot ``p // shards``. Counts differ by one at
most, slots have no gaps, and where a row went, or which row sits in a slot, is computed from
``n``, ``shards`` and ``seed`` alone, without a table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import number_rows

ROUNDS = 6


def _half_bits(n: int) -> int:
    """Bits of each half: the smallest even-bit block that holds n numbers."""
    return max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)


def _round_value(half: np.ndarray, key: int, bits: int) -> np.ndarray:
    """A keyed mix of a half, cut to its bits (multiply, fold, multiply)."""
    x = (half + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(29))) & np.uint64((1 << bits) - 1)


def _keys(seed: int) -> list[int]:
    return [(seed * 0x2545F4914F6CDD1D + r * 0x632BE59BD9B4E019 + 1) % 2**64 for r in range(ROUNDS)]


def _once(x: np.ndarray, bits: int, seed: int, inverse: bool) -> np.ndarray:
    low = np.uint64((1 << bits) - 1)
    left, right = x >> np.uint64(bits), x & low
    for key in reversed(_keys(seed)) if inverse else _keys(seed):
        if inverse:
            left, right = right ^ _round_value(left, key, bits), left
        else:
            left, right = right, left ^ _round_value(right, key, bits)
    return (left << np.uint64(bits)) | right


def permute(numbers: np.ndarray, n: int, seed: int, inverse: bool = False) -> np.ndarray:
    """The permutation of 0 .. n-1 (or its inverse) at ``numbers``.

    The block of the network may exceed ``n``; a value outside is sent through again until it is
    inside (cycle walking), which leaves a permutation of exactly 0 .. n-1.
    """
    bits = _half_bits(n)
    with np.errstate(over="ignore"):
        out = _once(np.asarray(numbers, dtype=np.uint64), bits, seed, inverse)
        while (outside := out >= np.uint64(n)).any():
            out[outside] = _once(out[outside], bits, seed, inverse)
    return out.astype(np.int64)


def locate(row_number: int, n: int, shards: int, seed: int = 0) -> tuple[int, int]:
    """Shard and slot of a row number."""
    place = int(permute(np.array([row_number]), n, seed)[0])
    return place % shards, place // shards


def row_at(shard: int, slot: int, n: int, shards: int, seed: int = 0) -> int:
    """The row number that sits in a slot."""
    return int(permute(np.array([slot * shards + shard]), n, seed, inverse=True)[0])


def shard_rows(
    df: DataFrame, order: Sequence[Column], shards: int, seed: int = 0
) -> DataFrame:
    """``df`` with ``row_number``, ``shard`` and ``slot``.

    ``order`` should tell all differing rows apart; equal rows are interchangeable and spread
    over the shards like any others. NULLs sort first. An empty table gives an empty one. ``df``
    must not have columns of the three names, nor ``piece`` and ``place``.
    """
    numbered = number_rows(df, order)
    n = numbered.count()

    @F.pandas_udf("long")
    def place_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(permute(batch.to_numpy(), n, seed))

    place = F.col("place")
    return (
        numbered.withColumn("place", place_of("row_number"))
        .withColumn("shard", (place % shards).cast("int"))
        .withColumn("slot", F.floor(place / F.lit(shards)).cast("long"))
        .drop("place")
    )


def write_shards(df: DataFrame, path: str) -> None:
    """Write a sharded frame, rows of a shard in slot order, one folder per shard.

    A shard is cut into ranges of slots, so its writing is not one task's work.
    """
    df.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = 20) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document.

    Size is the text's UTF-8 bytes plus 1; a NULL text counts as no bytes and has checksum 0.
    Rows are ordered by id, then by content, so repeated ids and repeated rows each get a slot of
    their own. NULL ids come first. The law is ``rows``: shard counts differ by one at most.
    """
    bytes_ = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    narrow = docs.select(
        F.col("doc_id"),
        (bytes_ + 1).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("content"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("doc_id", "content", "size", "text_crc32")]
    return shard_rows(narrow, order, shards, seed).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )
