import random
import re
from collections import Counter

import numpy as np
import odd
import pytest
import xxhash

from lapak.llm import components, simhash


def brute_print(text):
    words = odd.WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(values, radius=4):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    listed = sorted(parent)
    for i, a in enumerate(listed):
        for b in listed[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {v: find(v) for v in listed}


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a B c", "A b C d", "A b C d e", "É x y z É ü", "a\x1cb c d e f", "ÄÖ " * 50])
def test_fingerprint(text):
    assert simhash.fingerprint(text) % 2**64 == brute_print(text)


def test_documents(spark):
    docs = odd.documents()
    rows = simhash.duplicate_documents(odd.frame(spark)).collect()
    prints = {d: brute_print(d[1]) for d in docs}
    root = brute_groups(set(prints.values()))
    smallest = {}
    for d, p in prints.items():
        if d[0] is not None:
            smallest[root[p]] = min(smallest.get(root[p], 10**9), d[0])
    expected = Counter((d[0], f"{prints[d]:016x}", smallest.get(root[prints[d]])) for d in docs)
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in rows) == expected
    assert len({e[2] for e in expected}) < len(docs) - 60


def random_prints(n, seed, dense=0):
    rng = random.Random(seed)
    values = {rng.getrandbits(64) for _ in range(n)}
    for v in list(values)[: n // 10]:
        for _ in range(rng.randint(1, 4)):
            for _ in range(rng.randint(1, 5)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    centre = rng.getrandbits(64)
    values |= {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(dense)}
    return np.array(sorted(values | {0, 2**64 - 1}), dtype="<u8")


@pytest.mark.parametrize("rows, columns", [(7, 16), (256, 4096)])
def test_blocks_span_all_links(monkeypatch, rows, columns):
    monkeypatch.setattr(simhash, "ROWS", rows)
    monkeypatch.setattr(simhash, "COLUMNS", columns)
    values = random_prints(400, 3, dense=60)
    expected = brute_groups(values.tolist())
    half = len(values) // 2
    rng = np.random.default_rng(0)
    mixed = rng.permutation(values)
    links = np.concatenate([simhash.links_between(mixed, None, 4)])
    assert len(links) < len(values)
    split = np.concatenate(
        [simhash.links_between(mixed[:half], None, 4), simhash.links_between(mixed[half:], None, 4), simhash.links_between(mixed[:half], mixed[half:], 4)]
    )
    for found in (links, split):
        assert all((int(a) ^ int(b)).bit_count() <= 4 for a, b in found)
        assert grouped(values.tolist(), found.tolist()) == expected


def grouped(nodes, links):
    parent = {v: v for v in nodes}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {v: find(v) for v in nodes}


def test_tiles(spark):
    values = random_prints(600, 8, dense=40)
    df = spark.createDataFrame([(int(v),) for v in values.view("<i8")], "fingerprint bigint")
    links = simhash.near_links(df, tile=100).collect()
    found = [(a % 2**64, b % 2**64) for a, b in links]
    assert grouped(values.tolist(), found) == brute_groups(values.tolist())


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(2)
    links = {
        "chain": [(i, i + 1) for i in range(200)],
        "star": [(0, i) for i in range(1, 300)],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)],
        "none": [],
    }[shape]
    rows = components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert len(rows) == len(nodes) == len({r.node for r in rows})
    expected = grouped(nodes, [l for l in links if l[0] != l[1]])
    roots = {}
    for r in rows:
        assert roots.setdefault(expected[r.node], r.root) == r.root
    assert len(set(roots.values())) == len(roots)


def test_keep_one(spark):
    docs = odd.documents()
    kept = simhash.keep_one(odd.frame(spark))
    assert kept.columns == odd.frame(spark).columns
    rows = [tuple(r) for r in kept.collect()]
    root = brute_groups({brute_print(d[1]) for d in docs})
    per_group = Counter(root[brute_print(r[1])] for r in rows)
    assert per_group == Counter(set(root.values()))
    assert not Counter(rows) - Counter(docs)
    smallest = {}
    for d in docs:
        if d[0] is not None:
            g = root[brute_print(d[1])]
            smallest[g] = min(smallest.get(g, 10**9), d[0])
    assert all(r[0] == smallest.get(root[brute_print(r[1])]) for r in rows)


def test_empty(spark):
    assert simhash.duplicate_documents(odd.frame(spark, [])).count() == 0
    assert simhash.keep_one(odd.frame(spark, [])).count() == 0
