import zlib

import numpy as np
import odd
import pytest
from hypothesis import given
from hypothesis import strategies as st
from test_tokens import whole

from lapak.llm import dac, tokens


@given(st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=700), max_size=4))
def test_round_trip(documents):
    arrays = [np.array(d, dtype="<u4") for d in documents]
    reader = dac.open_bytes(dac.encode([7, None, -3, 2**62][: len(arrays)], arrays))
    assert reader.doc_ids == [7, None, -3, 2**62][: len(arrays)]
    flat = [i for d in documents for i in d]
    assert reader.n_ids == len(flat)
    for k, d in enumerate(documents):
        assert reader.document(k).tolist() == d
    for i in range(0, len(flat), 37):
        assert reader[i] == flat[i]
    assert reader.run(len(flat) // 3, len(flat)).tolist() == flat[len(flat) // 3 :]


def test_random_access_reads_little(tmp_path):
    ids = np.random.default_rng(1).integers(0, 49_408, 200_000).astype("<u4")
    (tmp_path / "a.dac").write_bytes(dac.encode([1], [ids]))
    reader = dac.open_file(f"file://{tmp_path}/a.dac")
    read, sizes = reader._read, []
    reader._read = lambda at, n: (sizes.append(n), read(at, n))[1]
    for i in (0, 511, 512, 99_999, 199_999):
        sizes.clear()
        assert reader[i] == ids[i]
        assert sum(sizes) < 200
    with pytest.raises(IndexError):
        reader[200_000]


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        dac.open_bytes(b"something else")


def test_documents(spark, monkeypatch):
    monkeypatch.setattr(dac, "FILE_IDS", 5000)  # several files per range
    docs = odd.documents()
    rows = dac.token_documents(odd.frame(spark)).collect()
    assert len(rows) == len(docs)
    got = sorted(rows, key=lambda r: r.start)
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    expected = []
    for d in docs:
        x = np.array([*whole(d[1]), tokens.END], dtype="<u4")
        expected.append((-1 if d[0] is None else d[0], len(x), zlib.crc32(x)))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == sorted(expected)


def test_empty(spark):
    assert dac.token_documents(odd.frame(spark, [])).count() == 0
