import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import odd
from hypothesis import given
from hypothesis import strategies as st
from test_tokens import whole

from lapak.llm import packing, tokens


@given(st.lists(st.integers(0, 20), max_size=60))
def test_tree_finds_the_first_bin_with_room(lengths):
    bins, offsets = packing.first_fit_decreasing(np.array(lengths, dtype=np.int64), 20)
    held = []
    for piece in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = next((b for b, n in enumerate(held) if n + lengths[piece] <= 20), len(held))
        if at == len(held):
            held.append(0)
        assert (bins[piece], offsets[piece]) == (at, held[at])
        held[at] += lengths[piece]


def check(rows, docs):
    expected = Counter()
    for d in docs:
        ids = np.array([*whole(d[1]), tokens.END], dtype="<u4")
        for start in range(0, len(ids), packing.LENGTH):
            part = ids[start : start + packing.LENGTH]
            expected[(d[0], start, len(part), zlib.crc32(part), len(ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == expected
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.LENGTH
    return held


def test_documents(spark):
    docs = odd.documents()
    rows = packing.pack_documents(odd.frame(spark)).collect()
    held = check(rows, docs)
    used = sum(r.length for r in rows)
    assert len(held) - used / packing.LENGTH < 1  # one group: only the last sequence has room


def test_groups_and_large_ids(spark):
    docs = [(2**60 + i, odd.words(random.Random(i), 3 + i % 200), None, None, None, *odd.EXTRA) for i in range(500)]
    parts = packing.pieces(odd.frame(spark, docs), tokens.vocabulary_path())
    packed = packing.pack(parts, group=50)
    rows = packed.collect()
    assert len({r.sequence_id >> 32 for r in rows}) == 10
    check(rows, docs)


def test_sequences(spark):
    parts = packing.pieces(odd.frame(spark).where("doc_id < 50"), tokens.vocabulary_path(), length=256)
    packed = packing.pack(parts, length=256)
    ids = {(r.doc_id, r.start): r.ids for r in packed.collect()}
    place = {(r.sequence_id, r.offset): (r.doc_id, r.start, r.length) for r in packed.collect()}
    rows = packing.sequences(packed, length=256, pad=2).collect()
    for r in rows:
        assert len(r.ids) == 4 * 256
        tail = np.frombuffer(bytes(r.ids), "<u4")[r.n_tokens :]
        assert (tail == 2).all()
        for (s, offset), (doc, start, length) in place.items():
            if s == r.sequence_id:
                assert bytes(r.ids)[4 * offset : 4 * (offset + length)] == bytes(ids[doc, start])


def test_empty(spark):
    assert packing.pack_documents(odd.frame(spark, [])).count() == 0
