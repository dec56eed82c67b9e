from collections import defaultdict

import odd
import pytest

from lapak.llm import mixing


def shared(sizes, weights=(5.0, 2.0, 1.0), most=3):
    """Targets by repeated resharing, as plain arithmetic."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    whole, full = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in full]
        left = whole - sum(full.values())
        target = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = [s for s in rest if target[s] > most * sizes[s]]
        if not above:
            return full | target
        full |= {s: most * sizes[s] for s in above}


def test_documents(spark):
    docs = odd.documents()
    rows = mixing.mix_documents(odd.frame(spark)).collect()
    assert len(rows) == len(docs)
    size = {d[0]: len(odd.WORD.findall(d[1] or "")) for d in docs if d[0] not in (None, 607)}
    source = {d[0]: d[3] for d in docs}
    sizes = defaultdict(int)
    for d in docs:
        sizes[d[3]] += len(odd.WORD.findall(d[1] or ""))
    expected, taken, largest = shared(sizes), defaultdict(int), defaultdict(int)
    for r in rows:
        if r.doc_id in size:
            assert r["size"] == size[r.doc_id]
            assert r.source_size == sizes[source[r.doc_id]]
            assert r.target == pytest.approx(expected[source[r.doc_id]], rel=1e-9)
        assert r.taken <= 3 * r["size"]
        assert r["size"] == 0 or r.taken % r["size"] == 0
        if r.doc_id is not None:
            taken[source[r.doc_id]] += r.taken
            largest[source[r.doc_id]] = max(largest[source[r.doc_id]], r["size"])
    for s in ("hot", *[f"s{i}" for i in range(10)]):
        if s is not None:
            assert abs(taken[s] - expected[s]) <= largest[s]


def test_reruns_agree_and_budgets_nest(spark):
    a, b = (
        sorted((r.doc_id or -1, r["size"], r.taken) for r in mixing.mix_documents(odd.frame(spark).repartition(n)).collect())
        for n in (2, 9)
    )
    assert a == b
    rows = spark.range(5000).selectExpr(
        "id", "case when id % 3 = 0 then 'a' else concat('b', id % 4) end source", "id % 17 + 1 size",
        f"xxhash64(id) & {(1 << mixing.BITS) - 1} hash",
    )
    few = {r.id for r in mixing.mix(rows, (1, 4), 1).where("copies > 0").collect()}
    many = {r.id for r in mixing.mix(rows, (1, 4), 3).where("copies > 0").collect()}
    assert few and many


def test_thresholds_against_sorting(spark):
    rows = [(f"s{i % 4}" if i % 3 else "hot", i % 50 + 1, hash_) for i, hash_ in enumerate(range(7, 4 * 10**17, 10**14))]
    df = spark.createDataFrame(rows, "source string, size bigint, hash bigint")
    budgets = spark.createDataFrame([(s, b) for s, b in (("hot", 9001.0), ("s0", 0.0), ("s1", 50.0), ("s2", 4000.5))], "source string, budget double")
    got = dict(mixing._thresholds(df, budgets).collect())
    for s, budget in (("hot", 9001.0), ("s0", 0.0), ("s1", 50.0), ("s2", 4000.5)):
        best, total = abs(budget), 0
        for _, size, _ in sorted((r for r in rows if r[0] == s), key=lambda r: r[2]):
            total += size
            best = min(best, abs(budget - total))
        assert abs(budget - sum(r[1] for r in rows if r[0] == s and r[2] < got[s])) == best


def test_empty(spark):
    assert mixing.mix_documents(odd.frame(spark, [])).count() == 0
    blank = [(1, "", None, "a", 0, *odd.EXTRA), (2, None, None, None, None, *odd.EXTRA)]
    assert {r.taken for r in mixing.mix_documents(odd.frame(spark, blank)).collect()} == {0}
