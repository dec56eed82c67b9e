import hashlib
import io
import random
import struct
from collections import Counter

import odd
import pytest
import zstandard

from lapak.llm import warc

SCHEMA = "page_id bigint, url string, html string, bytes string, sha1 string, of int, n int, payload string, stored int"


def pages():
    rng = random.Random(1)
    big = odd.words(rng, 400)
    rows = [(i, f"http://h{i % 7}.example/p/{i}", f"<html>{odd.words(rng, 1 + i)}</html>") for i in range(200)]
    rows += [(300 + i, f"http://copy.example/{i}", big) for i in range(60)]  # a large group of equal payloads
    rows += [(400 + i, "http://short.example/", "short") for i in range(5)]
    rows += [(500, None, None), (501, "", ""), (502, "http://a b/\r\nWARC-Type: x", "é😀" * 600), (None, "http://n/", big), (None, None, None)]
    rows += [(503, "u", "y" * 999), (504, "u", "y" * 999), (505, "u", "z" * 1000), (506, "u", "z" * 1000), (506, "u", "z" * 1000)]
    rows += [(None, "only", "q" * 2000), (None, "only", "q" * 2000), (507, "u", "\r\n\r\n" + "r" * 5000), (508, "u", "long " * 400_000)]
    return rows


def expected(rows):
    groups = {}
    for page_id, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000 and page_id is not None:
            groups[data] = max(groups.get(data, page_id), page_id)
    out = Counter()
    for page_id, _, html in rows:
        data = (html or "").encode()
        stored = groups.get(data)
        again = stored is not None and (page_id is None or page_id < stored)
        out[(page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", stored if again else None)] += 1
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "b", "s", 1, 2, "p", 3) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("size", [64_000_000, 3000])
def test_pages(spark, monkeypatch, size):
    monkeypatch.setattr(warc, "FILE_BYTES", size)
    rows = warc.archive_pages(frame(spark, pages())).collect()
    assert Counter(map(tuple, rows)) == expected(pages())


def test_payloads_come_back(spark, tmp_path):
    folder = f"file://{tmp_path}/a"
    manifest = warc.write_archives(warc.records(frame(spark, pages())), folder)
    back = {(r.page_id, r.payload_digest): r.payload for r in warc.read_archives(manifest, folder).collect() if r.record_type == "response"}
    assert all(hashlib.sha1(p).hexdigest() == d for (_, d), p in back.items())
    assert bytes(back[502, hashlib.sha1(("é😀" * 600).encode()).hexdigest()]).decode() == "é😀" * 600


def test_empty(spark):
    assert warc.archive_pages(frame(spark, [])).count() == 0


def page(i, text, url="http://x/"):
    data = text.encode()
    return {"page_id": i, "url": url, "payload": data, "bytes": len(data), "sha1": hashlib.sha1(data).hexdigest(), "record_type": "response", "refers_to": None}


def archive(n=300, dictionary=True):
    found = [warc.build_record(page(i, f"<html><body>number {i} {'text ' * (i % 40)}</body></html>")) for i in range(n)]
    sink = io.BytesIO()
    writer = warc.Writer(sink, warc.train(found) if dictionary else None)
    for r in found:
        writer.add(r)
    return found, sink.getvalue()


@pytest.mark.parametrize("dictionary", [True, False])
def test_one_frame_per_record(dictionary, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 100)
    found, data = archive(dictionary=dictionary)
    assert (struct.unpack("<I", data[:4])[0] == warc.DICTIONARY_MAGIC) == dictionary
    assert list(warc.read_frames(io.BytesIO(data).read)) == found
    assert [warc.page_of(warc.parse_record(r))["page_id"] for r in found] == list(range(300))


def test_plain_dictionary_and_other_skippable_frames():
    found, data = archive()
    size = struct.unpack("<I", data[4:8])[0]
    plain = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
    other = struct.pack("<II", warc.DICTIONARY_MAGIC, len(plain)) + plain + struct.pack("<II", 0x184D2A50, 3) + b"abc" + data[8 + size :]
    assert list(warc.read_frames(io.BytesIO(other).read)) == found


@pytest.mark.parametrize(
    "spoil",
    [
        lambda d: d[:-5],
        lambda d: d[:6],
        lambda d: d + b"xx",
        lambda d: d + b"no frame at all",
        lambda d: d[8 + struct.unpack("<I", d[4:8])[0] :],  # the dictionary is gone
        lambda d: d + d[: 8 + struct.unpack("<I", d[4:8])[0]],  # a second dictionary
        lambda d: d[:-40] + bytes([d[-40] ^ 255]) + d[-39:],
    ],
)
def test_broken_archives(spoil):
    with pytest.raises(warc.ArchiveError):
        list(warc.read_frames(io.BytesIO(spoil(archive()[1])).read))


@pytest.mark.parametrize(
    "old, new",
    [
        (b"WARC/1.1", b"WARC/9"),
        (b"WARC-Date: ", b"Date: "),
        (b"WARC-Type: response", b"WARC-Type response"),
        (b"Content-Length: ", b"Content-Length: 1"),
        (b"hello", b"hullo"),
        (b"<urn:page:5>", b"<urn:other>"),
        (b"sha1:", b"sha1:A"),
        (b"WARC-Type: response", b"WARC-Type: metadata"),
        (b"\r\n\r\n", b"\r\n"),
    ],
)
def test_broken_records(old, new):
    record = warc.build_record(page(5, "hello"))
    with pytest.raises((warc.ArchiveError, ValueError)):
        warc.page_of(warc.parse_record(record.replace(old, new)))
