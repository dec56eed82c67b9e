import hashlib
import math
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from lapak.llm import codebooks

SCHEMA = "vec_id bigint, embedding array<double>, label int, uid string, x string, entry int, salt int, moved string"
MORE = ("u", "x", 1, 2, "m")


def brute(rows):
    """Lloyd's rounds in memory with Python's integers; ``rows`` are (vec_id, vector, label)."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    widths = [len(r[1]) for r in kept if r[1] and len(r[1]) % 4 == 0]
    if not widths:
        return []
    width = min(set(widths), key=lambda w: (-widths.count(w), w))
    limit = codebooks.largest(width)
    kept = [(i, [math.floor(max(min(1024 * x, limit), -limit)) for x in v], g) for i, v, g in kept if len(v) == width]
    each = width // 4
    cut = [[tuple(v[p * each : (p + 1) * each]) for p in range(4)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:256]
    books = [[cut[k][p] for k in order] for p in range(4)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, c)), e) for e, c in enumerate(book))

    for _ in range(4):
        for p in range(4):
            held = defaultdict(list)
            for c in cut:
                held[near(c[p], books[p])[1]].append(c[p])
            for e, parts in held.items():
                books[p][e] = tuple(sum(column) // len(parts) for column in zip(*parts))
    found = [[near(c[p], books[p]) for p in range(4)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    of_label = defaultdict(int)
    for (_, _, g), e in zip(kept, errors):
        of_label[g] += e
    digest = hashlib.sha256(",".join(str(x) for book in books for c in book for x in c).encode()).hexdigest()
    top = (1 << 63) - 1
    return [(i, "".join(f"{e:02x}" for _, e in f), err, min(of_label[g], top), digest) for (i, _, g), f, err in zip(kept, found, errors)]


def result(spark, rows):
    df = codebooks.compress_vectors(spark.createDataFrame([(*r, *MORE) for r in rows], SCHEMA).repartition(3))
    assert df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted(map(str, map(tuple, df.collect())))


def vectors(seed, n, width=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    return [(i, (centres[int(rng.integers(12))] + rng.normal(size=width) * 0.2).tolist(), [None, 1, 2][int(rng.integers(3))]) for i in range(n)]


def test_against_memory(spark):
    rows = vectors(1, 700)
    assert result(spark, rows) == sorted(map(str, brute(rows)))


def test_hot_entry_and_repeats(spark):
    """A third of all vectors are equal, vec_ids repeat, and parts tie between entries."""
    rows = vectors(2, 300, 4) + [(1000 + i, [0.5, -0.5, 0.25, 0.0], 7) for i in range(200)] + [(3, [1.0, 2.0, 3.0, 4.0], 1)] * 3
    rows += [(5, [float(random.Random(i).randint(-1, 1)) for _ in range(4)], 2) for i in range(50)]
    assert result(spark, rows) == sorted(map(str, brute(rows)))


def test_odd_vectors(spark):
    rows = vectors(3, 40) + [
        (None, [0.1] * 8, 1), (None, None, 1), (100, [None] * 8, 1), (101, [math.nan] * 8, 2), (102, [math.inf] + [0.0] * 7, 2), (103, [], 1),
        (104, [1.0] * 4, 1), (105, [1.0] * 7, 1), (106, [0.0] * 8, None), (107, [-0.0] * 8, 3), (108, [1e-300] * 8, 3), (109, [-1e-300] * 8, 3),
        (-5, [1.0] * 8, 4), (-5, [1.0] * 8, 4),
    ]
    assert result(spark, rows) == sorted(map(str, brute(rows)))


@pytest.mark.parametrize("big", [1e5, 1e9, 1e300])
def test_large_components(spark, big):
    """Beyond what doubles hold exactly, and beyond the limit."""
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-big, big) if rng.random() < 0.5 else rng.uniform(-1, 1) for _ in range(8)], rng.choice([1, None])) for i in range(280)]
    assert result(spark, rows) == sorted(map(str, brute(rows)))


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [math.nan] * 4, 1)], [(1, [1.0] * 3, 1)]])
def test_nothing_left(spark, rows):
    assert result(spark, rows) == []


def test_nearest_in_both_ways():
    rng = np.random.default_rng(5)
    x, book = rng.integers(-900, 900, size=(500, 6)), rng.integers(-900, 900, size=(40, 6))
    book[7] = book[3]
    x[:40] = book
    far = ((x[:, None] - book[None]) ** 2).sum(-1)
    for factor in (1, 1 << 18):
        entry, error = codebooks.nearest(x * factor, book * factor)
        assert (entry == far.argmin(1)).all() and (error == far.min(1) * factor**2).all()


def test_only_changed_members_move(spark):
    """Members that keep their entry are not in the shuffled part."""
    rows = spark.createDataFrame([(*r, *MORE) for r in vectors(6, 400)], SCHEMA)
    kept, width = codebooks.whole_vectors(rows)
    books = codebooks.first_codebooks(kept, width, entries=16)
    each = width // 4
    members = kept.selectExpr("uid", "0 salt", "0 position", f"slice(x, 1, {each}) x", "-1 entry")
    settled = codebooks.settle(members, books)
    again = codebooks.assigned(settled, books)
    assert again.where("moved").count() == 0 and again.count() == 400
    books = codebooks.updated(settled, books)
    moved = codebooks.assigned(settled, books).where("moved").count()
    assert 0 < moved < 200


def test_sql(spark):
    folder = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    got = codebooks.compress_vectors(spark.read.parquet(f"{folder}/embeddings.parquet")).collect()
    assert sorted(map(tuple, got)) == sorted(db.sql(codebooks.SQL).fetchall())
