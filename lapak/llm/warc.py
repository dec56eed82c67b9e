"""WARC archives in Zstandard: one frame per record, a dictionary in front.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary, itself
compressed or not; every further frame is one record. The reader loads the dictionary, decodes one
frame at a time and checks headers, lengths and digests.

A page is a ``response`` record with its HTTP header and payload. Of equal payloads of some length
only one is stored; the others are ``revisit`` records that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_folder
from .common import file_system, written

# Fixed values of the archive format.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
VERSION = "WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED = ("WARC-Record-ID", "WARC-Date", "WARC-Type", "Content-Length")

#: Payloads from this length on are stored once.
LEAST = 1000
#: The dictionary is trained on the first records of each file, up to these bytes.
SAMPLE, DICTIONARY = 2_000_000, 32_768
#: Compressed bytes after which a new file is begun.
FILE_BYTES = 64_000_000
CHUNK = 1 << 18


class ArchiveError(ValueError):
    """An archive that breaks the format."""


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_id(name: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(none|-?[0-9]+)>", name)
    if not found:
        raise ArchiveError(f"unknown record id {name}")
    return None if found[1] == "none" else int(found[1])


def build_record(page: dict, date: str = "2000-01-01T00:00:00Z") -> bytes:
    """The bytes of a page's record; ``page`` has page_id, url, payload, bytes, sha1 and refers_to."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {page['bytes']}\r\n\r\n".encode()
    again = page["record_type"] == "revisit"
    block = http if again else http + page["payload"]
    uri = quote(page["url"], safe="%/:=&?~#+!$,;'@()*[]|") if page["url"] else f"urn:page:{page['page_id']}"
    headers = {
        "WARC-Type": page["record_type"],
        "WARC-Record-ID": _record_id(page["page_id"]),
        "WARC-Date": date,
        "WARC-Target-URI": uri,
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(page["sha1"])).decode(),
        "WARC-Block-Digest": _digest(block),
        "Content-Type": "application/http; msgtype=response",
    }
    if again:
        headers |= {"WARC-Profile": REVISIT, "WARC-Refers-To": _record_id(page["refers_to"])}
    headers["Content-Length"] = str(len(block))
    head = "\r\n".join([VERSION, *(f"{k}: {v}" for k, v in headers.items())])
    return head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The parts of a record, checked; raises ArchiveError."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "strict").split("\r\n") if found else []
    if not lines or not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        raise ArchiveError("no version line")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not re.fullmatch(r"[!#$%&'*+.^_`|~0-9A-Za-z-]+", name):
            raise ArchiveError(f"bad header line {line!r}")
        headers[name.lower()] = value.strip()
    for name in NEEDED:
        if name.lower() not in headers:
            raise ArchiveError(f"{name} is missing")
    if not re.fullmatch(r"[0-9]+", headers["content-length"]):
        raise ArchiveError("bad Content-Length")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ArchiveError(f"Content-Length is {length}, the block has {len(rest) - 4} bytes")
    block = rest[:length]
    if "warc-block-digest" in headers and headers["warc-block-digest"] != _digest(block):
        raise ArchiveError("the block's digest differs")
    return headers | {"block": block}


def page_of(record: dict) -> dict:
    """The page of a response or revisit record, its payload checked against the headers."""
    http, found, payload = record["block"].partition(b"\r\n\r\n")
    stated = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)[ \t]*\r?$", http)
    if not found or not http.startswith(b"HTTP/") or not stated:
        raise ArchiveError("the block is no HTTP message with a length")
    again = record["warc-type"] == "revisit"
    if record["warc-type"] not in ("response", "revisit"):
        raise ArchiveError(f"record type {record['warc-type']}")
    digest = record.get("warc-payload-digest", "")
    if again and (payload or record.get("warc-profile") != REVISIT or "warc-refers-to" not in record):
        raise ArchiveError("an incomplete revisit")
    if not again and (len(payload) != int(stated[1]) or digest != _digest(payload)):
        raise ArchiveError("the payload differs from its length or digest")
    return {
        "page_id": _page_id(record["warc-record-id"]),
        "payload_bytes": int(stated[1]),
        "payload_digest": base64.b32decode(digest.removeprefix("sha1:")).hex(),
        "record_type": record["warc-type"],
        "refers_to": _page_id(record["warc-refers-to"]) if again else None,
        "payload": None if again else payload,
    }


class Writer:
    """Writes records into one archive; ``sink`` has ``write``."""

    def __init__(self, sink, dictionary: bytes | None):
        self.sink, self.bytes, self.records = sink, 0, 0
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self._compressor = zstandard.ZstdCompressor(level=3, dict_data=known, write_checksum=True, write_content_size=True)
        if dictionary:
            packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
            self._write(struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed)

    def _write(self, data: bytes) -> None:
        self.sink.write(data)
        self.bytes += len(data)

    def add(self, record: bytes) -> None:
        self._write(self._compressor.compress(record))
        self.records += 1


def train(records: list[bytes]) -> bytes | None:
    """A dictionary for records like these, or None where they are too few or too small."""
    try:
        return zstandard.train_dictionary(DICTIONARY, records).as_bytes()
    except zstandard.ZstdError:
        return None


def read_frames(read) -> Iterator[bytes]:
    """The records of an archive, one per frame; ``read(n)`` gives up to n bytes, none at the end."""
    held = b""

    def fill(n: int) -> bool:
        nonlocal held
        while len(held) < n and (more := read(CHUNK)):
            held += more
        return len(held) >= n

    dictionary, first = None, True
    while fill(1):
        if not fill(4):
            raise ArchiveError("the archive ends inside a frame")
        magic = struct.unpack("<I", held[:4])[0]
        if magic in SKIPPABLE:
            if not fill(8) or not fill(8 + struct.unpack("<I", held[4:8])[0]):
                raise ArchiveError("the archive ends inside a skippable frame")
            size = struct.unpack("<I", held[4:8])[0]
            body, held = held[8 : 8 + size], held[8 + size :]
            if magic == DICTIONARY_MAGIC:
                if not first:
                    raise ArchiveError("a dictionary that does not lead the archive")
                if body[:4] == struct.pack("<I", FRAME_MAGIC):
                    body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
                dictionary = zstandard.ZstdCompressionDict(body)
            first = False
            continue
        if magic != FRAME_MAGIC:
            raise ArchiveError("neither a frame nor a skippable frame")
        first = False
        fill(18)  # a frame header's most
        try:
            stated = zstandard.get_frame_parameters(held)
            frame = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
            out = [frame.decompress(held)]
            while not frame.eof:
                more = read(CHUNK)
                if not more:
                    raise ArchiveError("the archive ends inside a frame")
                out.append(frame.decompress(more))
        except zstandard.ZstdError as e:
            raise ArchiveError(f"a frame cannot be decoded: {e}") from e
        held = frame.unused_data
        record = b"".join(out)
        if stated.content_size not in (zstandard.CONTENTSIZE_UNKNOWN, len(record)):
            raise ArchiveError("a frame's length differs from its header")
        yield record


_MANIFEST = pa.schema([("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
_PAGES = pa.schema(
    [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
     ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
)


def records(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, payload, bytes, sha1, record_type, refers_to of every row of ``pages``.

    Of equal payloads of ``least`` bytes or more the largest page_id is stored, and rows that
    repeat it are stored too; the others refer to it. NULL ids are below all others; where a
    payload has only such, all are stored. NULL html is an empty payload.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    full = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("bytes"), F.sha1(payload).alias("sha1"),
    )
    groups = full.where(F.col("bytes") >= least).groupBy("sha1").agg(F.max("page_id").alias("stored"), F.count(F.lit(1)).alias("n"))
    # Written, so that the join below sees its size and can split a payload that many pages share.
    shared = written(groups.where("n > 1").select(F.col("sha1").alias("of"), "stored"), "shared")
    again = F.col("stored").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("stored")))
    return (
        full.join(shared, (F.col("sha1") == F.col("of")) & (F.col("bytes") >= least), "left")
        .withColumn("record_type", F.when(again, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(again, F.col("stored")))
        .withColumn("payload", F.when(~again, F.col("payload")))
        .drop("of", "stored")
    )


def write_archives(found: DataFrame, folder: str) -> DataFrame:
    """Write ``records`` into archives below ``folder``; the manifest, one row per archive.

    The manifest is committed by Spark and lists the archives of the attempts that counted.
    """

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = file_system(folder)
        waiting: list[bytes] = []
        held, writer, sink, name = 0, None, None, ""

        def begin() -> None:
            nonlocal writer, sink, name, waiting, held
            name = f"{uuid.uuid4().hex}.warc.zst"
            sink = system.open_output_stream(f"{place}/{name}")
            writer = Writer(sink, train(waiting))
            for record in waiting:
                writer.add(record)
            waiting, held = [], 0

        def end() -> pa.RecordBatch:
            nonlocal writer
            sink.close()
            row = {"name": name, "records": writer.records, "bytes": writer.bytes}
            writer = None
            return pa.RecordBatch.from_pylist([row], schema=_MANIFEST)

        for batch in batches:
            for k in range(batch.num_rows):
                record = build_record(batch.slice(k, 1).to_pylist()[0])
                if writer is None:
                    waiting.append(record)
                    held += len(record)
                    if held >= SAMPLE:
                        begin()
                else:
                    writer.add(record)
                if writer and writer.bytes >= FILE_BYTES:
                    yield end()
        if waiting:
            begin()
        if writer:
            yield end()

    spark = found.sparkSession
    spark.createDataFrame([], "x int").write.mode("ignore").parquet(f"{folder}/made")  # makes the folder
    return written(found.mapInArrow(save, "name string, records bigint, bytes bigint"), "archives")


def read_archives(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The pages of the archives in ``manifest``; an archive is one task's work, read as a stream.

    An archive that breaks the format, or has other than the stated number of records, fails.
    """

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, place = file_system(f"{folder}/{row['name']}")
                out, held, n = [], 0, 0
                with system.open_input_stream(place) as stream:
                    for record in read_frames(stream.read):
                        page = page_of(parse_record(record))
                        n += 1
                        held += page["payload_bytes"] if payloads else 100
                        out.append(page if payloads else page | {"payload": None})
                        if held >= 8_000_000:
                            yield pa.RecordBatch.from_pylist(out, schema=_PAGES)
                            out, held = [], 0
                if n != row["records"]:
                    raise ArchiveError(f"{row['name']} has {n} records instead of {row['records']}")
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=_PAGES)

    spread = manifest.repartitionByRange(max(1, manifest.count()), "name")
    kinds = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"
    return spread.mapInArrow(load, kinds)


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, read back."""
    place = folder or scratch_folder(pages.sparkSession, "archives")
    manifest = write_archives(records(pages), place)
    return read_archives(manifest, place, payloads=False).drop("payload")
