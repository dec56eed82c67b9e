import zlib
from collections import Counter

import numpy as np
import odd
import pytest

from lapak.llm import sharding


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 17, 64, 1000, 4097])
def test_permutation_and_inverse(n):
    numbers = np.arange(n)
    there = sharding.permute(numbers, n, 3)
    assert sorted(there) == list(range(n))
    assert (sharding.permute(there, n, 3, inverse=True) == numbers).all()


def test_seeds_shuffle_differently():
    a, b = (sharding.permute(np.arange(1000), 1000, s) for s in (1, 2))
    assert (a != b).mean() > 0.9
    assert abs(np.corrcoef(np.arange(1000), a)[0, 1]) < 0.1


def test_documents(spark):
    rows = sharding.shard_documents(odd.frame(spark)).collect()
    docs = odd.documents()
    assert len(rows) == len(docs)
    expected = Counter(
        (d[0], len((d[1] or "").encode()) + 1, zlib.crc32((d[1] or "").encode())) for d in docs
    )
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == expected
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        assert (r.shard, r.slot) == sharding.locate(r.row_number, len(rows), 16, 20)
        assert sharding.row_at(r.shard, r.slot, len(rows), 16, 20) == r.row_number
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(i, [])) for i in range(16)]
    assert max(counts) - min(counts) <= 1
    ids = [r.doc_id for r in sorted(rows, key=lambda r: r.row_number)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_repeatable(spark):
    a, b = (
        sorted(tuple(r) for r in sharding.shard_documents(odd.frame(spark).repartition(n).where("doc_id < 606")).collect())
        for n in (2, 9)
    )
    assert a == b


def test_empty(spark):
    assert sharding.shard_documents(odd.frame(spark, [])).count() == 0


def test_written_shards(spark, tmp_path):
    sharding.write_shards(sharding.shard_documents(odd.frame(spark)), f"{tmp_path}/shards")
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert back.count() == len(odd.documents())
    assert {r.shard for r in back.select("shard").distinct().collect()} == set(range(16))
