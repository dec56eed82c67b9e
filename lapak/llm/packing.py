"""Packing documents into sequences: first-fit decreasing with a tournament tree.

Documents are cut into full sequences and a rest. Pieces are dealt at random into groups of a
bounded number; within a group the longest piece goes first, into the first sequence with room. A
tournament tree over the sequences' free places finds it in a logarithmic number of steps: every
inner node holds the most room below it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import written

LENGTH = 4096
#: Pieces of a group on average; a group is one task's work.
GROUP = 4096
#: Columns of a piece.
PIECE = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; pieces go by falling length, equal ones in the order given.

    A piece of length 0 takes no room; one longer than ``capacity`` is an error.
    """
    n = len(lengths)
    if n and int(lengths.max()) > capacity:
        raise ValueError("a piece is longer than a sequence")
    leaves = 1 << max(0, (n - 1)).bit_length()
    room = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    sizes = lengths.tolist()
    for piece in np.argsort(-lengths, kind="stable").tolist():
        size, node = sizes[piece], 1
        while node < leaves:
            node *= 2
            if room[node] < size:  # the left half has no sequence with room
                node += 1
        bins[piece], offsets[piece] = node - leaves, capacity - room[node]
        room[node] -= size
        while node > 1:
            node //= 2
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
    return bins, offsets


def pieces(docs: DataFrame, path: str, length: int = LENGTH, with_ids: bool = True) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens (and ids) of every piece of every document.

    A document is cut every ``length`` ids, so all its pieces but the last fill a sequence. A NULL
    or empty text has the end id alone.
    """
    ids_type = [pa.field("ids", pa.binary())] if with_ids else []
    schema = pa.schema([*((c, pa.int64()) for c in PIECE), *ids_type])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tokens.text_batches(batches):
            out: list[list] = [[] for _ in schema]
            for doc, ids in zip(part["doc_id"].to_pylist(), tokens.documents_ids(part["text"], path)):
                for start in range(0, len(ids), length):
                    piece = ids[start : start + length]
                    row = (doc, start, len(piece), zlib.crc32(piece), len(ids))
                    for column, value in zip(out, (*row, piece.tobytes()) if with_ids else row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, schema)], schema=schema)

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    kinds = ", ".join(f"{c} bigint" for c in PIECE)
    return narrow.mapInArrow(cut, kinds + ", ids binary" * with_ids)


def pack(parts: DataFrame, length: int = LENGTH, group: int = GROUP, seed: int = 11) -> DataFrame:
    """``parts`` (doc_id, start, length, ...) with ``sequence_id`` and ``offset``.

    A piece's group is a hash of its place in the written table, so the rows of one document, and
    repeated rows, are spread like any others and no group outgrows a task. Sequence ids are the
    group's number, shifted, plus the sequence's number in the group.
    """
    placed = written(parts.withColumn("part", F.spark_partition_id()), "pieces")
    groups = max(1, -(-placed.count() // group))
    dealt = placed.select("*", F.col("_metadata.row_index").alias("row")).withColumn(
        "group", F.pmod(F.xxhash64(F.lit(seed), "part", "row"), F.lit(groups))
    )

    def fit(group: pa.Table) -> pa.Table:
        group = group.sort_by([("part", "ascending"), ("row", "ascending")])
        bins, offsets = first_fit_decreasing(group["length"].to_numpy(), length)
        first = group["group"][0].as_py() << 32
        kept = group.drop_columns(["part", "row", "group"])
        return kept.append_column("sequence_id", pa.array(first + bins)).append_column("offset", pa.array(offsets))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    return dealt.groupBy("group").applyInArrow(fit, f"{fields}, sequence_id bigint, offset bigint")


def sequences(packed: DataFrame, length: int = LENGTH, pad: int = 0) -> DataFrame:
    """``sequence_id, ids, n_tokens`` of packed pieces with ids: little-endian, padded to ``length``.

    A sequence has at most ``length`` ids, so a group is small.
    """
    listed = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(listed, F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    missing = F.lit(length) - F.col("n_tokens")
    padding = F.unhex(F.expr(f"repeat('{pad.to_bytes(4, 'little').hex()}', cast({length} - n_tokens as int))"))
    return (
        packed.groupBy("sequence_id")
        .agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
        .withColumn("ids", F.when(missing > 0, F.concat("ids", padding)).otherwise(F.col("ids")))
    )


def pack_documents(docs: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    found = pieces(docs, path or tokens.vocabulary_path(), length, with_ids=False)
    return pack(found, length)
