import math
import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from lapak.llm import pivots

SCHEMA = "vec_id bigint, embedding array<float>, label int, uid string, n string, p int, links int"


def brute(rows, least=0.9):
    """n_links and component per row, by all pairs of equal length."""
    sound = [
        i for i, (_, v) in enumerate(rows)
        if v and all(x is not None and math.isfinite(x) for x in v) and 0 < sum(float(x) ** 2 for x in v) < math.inf
    ]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for d in {len(rows[i][1]) for i in sound}:
        own = [i for i in sound if len(rows[i][1]) == d]
        m = np.array([rows[i][1] for i in own], dtype=np.float64)
        m /= np.linalg.norm(m, axis=1)[:, None]
        near = m @ m.T >= least
        for a, b in zip(*np.nonzero(np.triu(near, 1))):
            links[own[a]] += 1
            links[own[b]] += 1
            x, y = find(own[a]), find(own[b])
            parent[max(x, y)] = min(x, y)
    smallest = {}
    for i, (vec_id, _) in enumerate(rows):
        r = find(i)
        if vec_id is not None:
            smallest[r] = min(smallest.get(r, vec_id), vec_id)
    return [(vec_id, links[i], smallest.get(find(i)), vec_id == smallest.get(find(i))) for i, (vec_id, _) in enumerate(rows)]


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


def vectors(seed, n, dims=24, hot=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = rng.normal(size=dims)
        rows.append(v)
        for _ in range(int(rng.integers(0, 3)) if i % 5 == 0 else 0):
            rows.append(v + rng.normal(size=dims) * 0.1)
    centre = rng.normal(size=dims)
    rows += [centre + rng.normal(size=dims) * 0.08 for _ in range(hot)]  # a dense group
    rows += [centre] * hot  # equal vectors
    return [(i, np.float32(v).tolist()) for i, v in enumerate(rows)]


def odd_vectors():
    v = [0.5, -0.25, 1.0]
    return [(1, v), (2, v), (2, v), (3, [1.0, -0.5, 2.0]), (4, None), (5, []), (6, [0.0, 0.0, 0.0]), (7, [1.0, None, 2.0]),
            (8, [float("nan"), 1.0, 1.0]), (9, [float("inf"), 1.0, 1.0]), (None, v), (None, [0.0, 1.0, 0.0]), (10, [0.5, -0.25]),
            (11, [0.5, -0.25]), (12, [-0.0, 1.0, 0.0]), (13, [0.0, 1.0, -0.0]), (14, [1e-38, 0.0, 0.0]), (15, [3e38, 0.0, 0.0]), (0, [1.0])]


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 0, "u", "n", 1, 2) for i, v in rows], SCHEMA).repartition(4)
    return [tuple(r) for r in pivots.near_vectors(df, **options).collect()]


def test_odd_vectors(spark):
    assert order(run(spark, odd_vectors())) == order(brute(odd_vectors()))
    assert run(spark, []) == []


def test_a_length_with_one_pivot(spark):
    """Two unequal near vectors of a rare length, one of them in the sample."""
    few = spark.createDataFrame([(1, 1, [0.5, -0.25, 1.0]), (2, 1, [0.5, -0.25, 1.001])], "uid bigint, n bigint, vec array<double>")
    index = pivots.described(few, {3: np.array([[1.0, 0.0, 0.0]])})
    links = pivots.index_links(index).where("to is null").collect()
    assert sorted((r.uid, r.links) for r in links) == [(1, 1), (2, 1)]


@pytest.mark.parametrize("longest", [2048, 40])
def test_against_all_pairs(spark, longest):
    rows = vectors(1, 300, hot=60)
    got, expected = run(spark, rows, longest=longest), brute(rows)
    assert [g[0] for g in order(got)] == [e[0] for e in order(expected)]
    assert sum(g[1] for g in got) >= 0.99 * sum(e[1] for e in expected)
    limit = dict((e[0], e[1]) for e in expected)
    assert all(g[1] <= limit[g[0]] for g in got)


def test_dividing_lists_changes_nothing(spark):
    rows = vectors(2, 200, hot=80)
    assert order(run(spark, rows, longest=2048)) == order(run(spark, rows, longest=16))


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.1"])
def test_recall_on_embeddings(spark, folder):
    table = pq.read_table(f"/root/testdata/{folder}/embeddings.parquet")
    rows = list(zip(table["vec_id"].to_pylist(), table["embedding"].to_pylist()))
    got = pivots.near_vectors(spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet")).collect()
    found, there = sum(r.n_links for r in got), sum(e[1] for e in brute(rows))
    assert there * 0.99 <= found <= there


def test_recall_at_the_limit():
    """Pairs at cosine 0.9 to 0.92, the hardest that count: at least nine in ten share pivots."""
    rng = np.random.default_rng(7)
    n, dims = 10_000, 64
    a = rng.normal(size=(n, dims))
    a /= np.linalg.norm(a, axis=1)[:, None]
    side = rng.normal(size=(n, dims))
    side -= (side * a).sum(1)[:, None] * a
    side /= np.linalg.norm(side, axis=1)[:, None]
    cosine = rng.uniform(0.9, 0.92, size=(n, 1))
    b = cosine * a + np.sqrt(1 - cosine**2) * side
    points = a[rng.permutation(n)[: pivots.PIVOTS * math.isqrt(2 * n)]]
    one, two = pivots.describe(a, points), pivots.describe(b, points)
    shared = np.array([len(np.intersect1d(x, y)) for x, y in zip(one, two)])
    print("recall", (shared >= pivots.SHARED).mean())
    assert (shared >= pivots.SHARED).mean() >= 0.9


def test_lengths_whose_squares_no_double_holds(spark):
    rows = [(1, [1e200, 0.0]), (2, [1e200, 1.0]), (3, [1e-200, 0.0]), (4, [1e-200, 0.0]), (5, [0.0, -1e300]), (6, [5e-324, 5e-324]), (7, [1e-320, 1e-320])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in pivots.near_vectors(df).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (0, 5), 6: (1, 6), 7: (1, 6)}


def beside(rng, v, cosine):
    """A vector at just this cosine from ``v``."""
    side = rng.normal(size=len(v))
    side -= side @ v / (v @ v) * v
    side *= np.linalg.norm(v) / np.linalg.norm(side)
    return cosine * v + math.sqrt(1 - cosine * cosine) * side


@pytest.mark.parametrize("place", ["alone", "in clusters"])
@pytest.mark.parametrize("cosine", [0.9005, 0.92, 0.95])
def test_recall_of_planted_pairs(spark, place, cosine):
    """Pairs planted beside the given vectors, which hold none, and inside dense clusters of them."""
    rng = np.random.default_rng(11)
    given = np.array(pq.read_table("/root/testdata/sf0.1/embeddings.parquet")["embedding"].to_pylist(), dtype=np.float64)
    if place == "alone":
        bases, others = given[:600], given[600:]
    else:  # five centres with 300 vectors around each, pairs beside some of those
        around = np.concatenate([[beside(rng, c, rng.uniform(0.93, 0.99)) for _ in range(300)] for c in given[:5]])
        bases, others = around[::3], np.concatenate([given[5:], around])
    pairs = [(b, beside(rng, b, cosine)) for b in bases]
    rows = [(i, v.tolist()) for i, v in enumerate([*others, *[v for p in pairs for v in p]])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    classes = df.selectExpr("vec_id as uid", "1L as n", "embedding as vec")
    index = pivots.described(classes, pivots.pivot_sample(classes)).where(f"uid >= {len(others)}").orderBy("uid").collect()
    near = [len(set(a.pivots) & set(b.pivots)) >= pivots.SHARED for a, b in zip(index[::2], index[1::2])]
    print("recall", place, cosine, np.mean(near))
    assert len(near) == len(pairs) and np.mean(near) >= 0.9
    if place == "alone":  # of all links, which are the planted ones
        got = sum(r.n_links for r in pivots.near_vectors(df).collect())
        assert 0.9 * 2 * len(pairs) <= got <= 2 * len(pairs)
