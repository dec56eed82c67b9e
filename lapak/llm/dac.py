"""Token ids in directly addressable codes.

An id is cut into chunks of 8 bits. Level 0 holds the lowest chunk of every id, level 1 the next
chunk of those that have one, and so on; a bitmap per level says which ids go on. The place of an
id in the next level is the number of set bits before it, which a rank directory gives at once: so
any id is read without decoding its neighbours.

A file holds a run of documents in ascending doc_id order:

    "DAC1", then little-endian: documents, ids, levels (8 bytes each); doc_id and a NULL mark per
    document; first id of each document and their end; per level its length, chunks, bitmap and
    directory.

Files are written by tasks into the shared folder. A file's name holds a fresh token and the
manifest, committed by Spark, lists the files of the attempts that counted; what a lost or
repeated attempt left is never read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_folder
from . import tokens
from .common import file_system, written

MAGIC = b"DAC1"
#: Bits between entries of the rank directory.
BLOCK = 512
#: Ids of a file at most, beyond the document that crosses it.
FILE_IDS = 1 << 22
_MANIFEST = pa.schema(
    [("piece", pa.int32()), ("number", pa.int32()), ("name", pa.string()), ("n_documents", pa.int64()),
     ("n_ids", pa.int64()), ("bytes", pa.int64())]
)
_DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def _bitmap(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed bits, filled up to whole blocks, and the set bits before each block."""
    blocks = -(-len(bits) // BLOCK)
    packed = np.zeros(blocks * BLOCK // 8, dtype=np.uint8)
    some = np.packbits(bits, bitorder="little")
    packed[: len(some)] = some
    counts = np.bitwise_count(packed.reshape(blocks, BLOCK // 8)).sum(axis=1, dtype=np.uint64)
    return packed, np.cumsum(counts, dtype=np.uint64) - counts


def encode(doc_ids: Sequence[int | None], documents: Sequence[np.ndarray]) -> bytes:
    """The bytes of a file."""
    ids = np.concatenate(documents) if len(documents) else np.zeros(0, dtype="<u4")
    starts = np.cumsum([0, *map(len, documents)], dtype="<i8")
    levels, rest = [], ids
    while len(rest) or not levels:
        higher = rest >> 8
        packed, ranks = _bitmap(higher > 0)
        levels += [np.array([len(rest)], "<i8"), rest.astype(np.uint8), packed, ranks.astype("<u8")]
        rest = higher[higher > 0]
    head = np.array([len(documents), len(ids), len(levels) // 4], dtype="<i8")
    names = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
    nulls = np.array([d is None for d in doc_ids], dtype=np.uint8)
    return b"".join([MAGIC, *(np.ascontiguousarray(p).tobytes() for p in (head, names, nulls, starts, *levels))])


class Reader:
    """Reads ids from a file by position; ``read(offset, length)`` fetches bytes of the file."""

    def __init__(self, read):
        self._read = read
        at = len(MAGIC)
        if read(0, at) != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        self.n_documents, self.n_ids, n_levels = map(int, np.frombuffer(read(at, 24), "<i8"))
        at += 24
        names = np.frombuffer(read(at, 8 * self.n_documents), "<i8")
        at += 8 * self.n_documents
        nulls = np.frombuffer(read(at, self.n_documents), np.uint8)
        at += self.n_documents
        self.doc_ids = [None if z else int(d) for d, z in zip(names, nulls)]
        self.starts = np.frombuffer(read(at, 8 * (self.n_documents + 1)), "<i8")
        at += 8 * (self.n_documents + 1)
        self.levels = []
        for _ in range(n_levels):
            n = int(np.frombuffer(read(at, 8), "<i8")[0])
            blocks = -(-n // BLOCK)
            chunks = at + 8
            bitmap = chunks + n
            ranks = bitmap + blocks * BLOCK // 8
            at = ranks + 8 * blocks
            self.levels.append((n, chunks, bitmap, ranks))

    def __getitem__(self, i: int) -> int:
        """One id: per level one chunk, and one block of the bitmap with its directory entry."""
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        value = 0
        for depth, (_, chunks, bitmap, ranks) in enumerate(self.levels):
            value |= self._read(chunks + i, 1)[0] << (8 * depth)
            block, bit = divmod(i, BLOCK)
            words = int.from_bytes(self._read(bitmap + block * BLOCK // 8, BLOCK // 8), "little")
            if not words >> bit & 1:
                break
            before = int(np.frombuffer(self._read(ranks + 8 * block, 8), "<u8")[0])
            i = before + (words & ((1 << bit) - 1)).bit_count()
        return value

    def document(self, k: int) -> np.ndarray:
        """All ids of the k-th document: per level one run of chunks and of the bitmap."""
        first, last = int(self.starts[k]), int(self.starts[k + 1])
        return self.run(first, last)

    def run(self, first: int, last: int) -> np.ndarray:
        """Ids first .. last-1."""
        out = np.zeros(last - first, dtype="<u4")
        where = np.arange(last - first)
        for depth, (_, chunks, bitmap, ranks) in enumerate(self.levels):
            if last <= first:
                break
            out[where] |= np.frombuffer(self._read(chunks + first, last - first), np.uint8).astype("<u4") << np.uint32(8 * depth)
            low = first // BLOCK
            high = -(-last // BLOCK)
            packed = np.frombuffer(self._read(bitmap + low * BLOCK // 8, (high - low) * BLOCK // 8), np.uint8)
            bits = np.unpackbits(packed, bitorder="little")
            before = int(np.frombuffer(self._read(ranks + 8 * low, 8), "<u8")[0])
            skipped = int(bits[: first - low * BLOCK].sum())
            goes_on = bits[first - low * BLOCK : last - low * BLOCK].astype(bool)
            where = where[goes_on]
            first = before + skipped
            last = first + len(where)
        return out


def open_bytes(data: bytes) -> Reader:
    view = memoryview(data)
    return Reader(lambda at, n: bytes(view[at : at + n]))


def open_file(path: str) -> Reader:
    """A file on any file system that pyarrow knows; bytes are fetched as they are needed."""
    system, place = file_system(path)
    file = system.open_input_file(place)

    def read(at: int, n: int) -> bytes:
        return file.read_at(n, at)

    return Reader(read)


def write_ids(docs: DataFrame, folder: str, path: str) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into files below ``folder``; the manifest, one row per file.

    Documents are dealt by ranges of doc_id (NULL first) and sorted, so the files follow one
    another in that order; rows with one id stand in the order of their texts' hashes.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.col("content").asc_nulls_first()]
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("text").alias("content"))
    dealt = narrow.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text", F.spark_partition_id().alias("piece"))

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = file_system(folder)
        names: list[int | None] = []
        documents: list[np.ndarray] = []
        held = number = piece = 0

        def flush() -> pa.RecordBatch:
            name = f"{piece:08d}-{number:06d}-{uuid.uuid4().hex}.dac"
            data = encode(names, documents)
            with system.open_output_stream(f"{place}/{name}") as out:
                out.write(data)
            return pa.RecordBatch.from_pylist(
                [{"piece": piece, "number": number, "name": name, "n_documents": len(names), "n_ids": held, "bytes": len(data)}],
                schema=_MANIFEST,
            )

        for part in tokens.text_batches(batches):
            piece = part["piece"][0].as_py()
            for doc, ids in zip(part["doc_id"].to_pylist(), tokens.documents_ids(part["text"], path)):
                names.append(doc)
                documents.append(ids)
                held += len(ids)
                if held >= FILE_IDS:
                    yield flush()
                    names, documents, held, number = [], [], 0, number + 1
        if names:
            yield flush()

    spark = docs.sparkSession
    spark.createDataFrame([], "x int").write.mode("ignore").parquet(f"{folder}/made")  # makes the folder
    schema = "piece int, number int, name string, n_documents bigint, n_ids bigint, bytes bigint"
    return written(dealt.mapInArrow(save, schema), "manifest")


def read_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids of every document in the files of ``manifest``.

    Each file is one task's work; a start is the ids of all files before, which the manifest
    knows, plus the start in the file.
    """
    earlier = Window.orderBy("piece", "number").rowsBetween(Window.unboundedPreceding, -1)
    files = written(
        manifest.select("name", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("before")), "files"
    )

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader = open_file(f"{folder}/{row['name']}")
                for at in range(0, reader.n_documents, 1000):
                    numbers = range(at, min(at + 1000, reader.n_documents))
                    ids = [reader.document(k) for k in numbers]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": [reader.doc_ids[k] for k in numbers],
                            "start": [row["before"] + int(reader.starts[k]) for k in numbers],
                            "n_tokens": [len(x) for x in ids],
                            "ids": [x.tobytes() for x in ids],
                        },
                        schema=_DOCUMENTS,
                    )

    n = files.count()
    spread = files.repartitionByRange(max(1, n), "before")
    return spread.mapInArrow(load, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def token_documents(docs: DataFrame, path: str | None = None, folder: str | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from files written and read back.

    A NULL or empty text has the end id alone. Repeated rows are documents like any others. An
    empty table writes no file and returns no row.
    """
    place = folder or scratch_folder(docs.sparkSession, "token-ids")
    manifest = write_ids(docs, place, path or tokens.vocabulary_path())
    return read_ids(manifest, place).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
