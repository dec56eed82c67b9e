import math
import random
from collections import Counter

import numpy as np
import odd
import pytest

from lapak.llm import quality


def brute_counts(text):
    text = text or ""
    words = odd.WORD.findall(text)
    dup, seen = 0, set()
    for line in text.split("\n"):
        if odd.WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated)


@pytest.mark.parametrize(
    "text", [None, "", " ", "# <\n", "a a a", "a a a a", "a b c a b c", "x\ny\nx\n\nx\n \n ", "a\x1cb|\x0bc", "ü ü ü ü 😀 ü ü"]
)
def test_counts(text):
    assert quality.text_counts(text) == brute_counts(text)


def test_counts_of_random_texts():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice(["a", "b", "cc", "#"]) + rng.choice([" ", "\n", "  "]) for _ in range(rng.randint(0, 60)))
        assert quality.text_counts(text) == brute_counts(text)


def test_chi2():
    assert quality.chi2_cdf(9.2364, 5) == pytest.approx(0.9, abs=1e-4)
    assert quality.chi2_quantile(0.99, 7) == pytest.approx(18.4753, abs=1e-3)


def brute_mcd(x, floors):
    """Concentration steps on all rows in memory, from the same two starts, in the same grid."""
    x = np.round(x * quality.GRID) / quality.GRID
    n = len(x)
    q = np.percentile(x, [25, 50, 75], axis=0)

    def held(scatter):
        """A floor counts only where the estimate is below it."""
        out = scatter * 0.99
        for i, f in enumerate(floors):
            out[i, i] = max(scatter[i, i], f * f)
        return out

    starts = [(x.mean(0), held(np.cov(x.T, bias=True))), (q[1], held(np.diag(((q[2] - q[0]) / 1.349) ** 2)))]
    best = None
    for centre, scatter in starts:
        for _ in range(30):
            d = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(scatter), x - centre)
            bucket = np.floor(np.log2(d + 1e-6) * quality.FINE)
            last = np.sort(bucket)[math.ceil(quality.CORE * n) - 1]
            near = x[bucket <= last]
            centre, scatter = near.mean(0), held(quality.CONSISTENT * np.cov(near.T, bias=True))
        found = (np.linalg.slogdet(scatter)[1], centre, scatter)
        best = found if best is None or found[0] < best[0] else best
    _, centre, scatter = best
    return np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(scatter), x - centre)


def corpus(rng):
    rows = []
    for i in range(900):
        source = "a" if i % 3 else ("b" if i % 2 else "c")
        text = odd.words(rng, rng.randint(60, 300), 5000)
        if i % 11 == 0:
            text = text.replace(" ", "### ")
        if i % 50 == 0:
            text = None
        rows.append((i, text, "en" if i % 5 else None, source, 0, *odd.EXTRA))
    return rows


def test_verdicts_against_memory(spark, monkeypatch):
    monkeypatch.setattr(quality, "POOL", 100)
    monkeypatch.setattr(quality, "STEPS", 30)
    docs = corpus(random.Random(6))
    rows = {r.doc_id: r for r in quality.judge_documents(odd.frame(spark, docs)).collect()}
    assert len(rows) == len(docs)
    floors = [0.25, 0.02, 0.05, 0.05, 0.1]
    place, vector = {}, {}
    for d in docs:
        n, chars, symbols, dup, repeat = counts = brute_counts(d[1])
        r = rows[d[0]]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (n < 50 or 100 * repeat > 50 * n)
        if r.base_failed:
            assert not r.kept
            continue
        place[d[0]] = (d[2], d[3])
        vector[d[0]] = [math.log1p(n), math.log(chars / n), math.log1p(10 * symbols / n), math.sqrt(dup / n), math.sqrt(repeat / n)]
    sizes = Counter(place.values())
    rest = Counter()
    for (lang, _), k in sizes.items():
        rest[lang] += k if k < 100 else 0
    pool = {i: p if sizes[p] >= 100 else (p[0] if rest[p[0]] >= 100 else "rest") for i, p in place.items()}
    rejected = 0
    for name in set(pool.values()):
        ids = [i for i in pool if pool[i] == name]
        d = brute_mcd(np.array([vector[i] for i in ids]), floors)
        for i, far in zip(ids, d):
            assert rows[i].distance == pytest.approx(far, rel=0.05, abs=0.05)
            if abs(far - quality.LIMIT) > 0.1 * quality.LIMIT:
                assert rows[i].kept == (far <= quality.LIMIT)
            rejected += not rows[i].kept
    assert 60 <= rejected <= 90  # those with symbols


def test_odd_documents(spark):
    docs = odd.documents()
    rows = quality.judge_documents(odd.frame(spark)).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    assert got == Counter((d[0], *brute_counts(d[1])) for d in docs)
    kept = quality.keep_good(odd.frame(spark))
    assert kept.columns == odd.frame(spark).columns
    good = {r.doc_id for r in rows if r.kept}
    assert {r.doc_id for r in kept.collect()} == good
    assert not Counter(map(tuple, kept.collect())) - Counter(docs)


def test_few_or_no_rows(spark):
    assert quality.judge_documents(odd.frame(spark, [])).count() == 0
    few = [(i, odd.words(random.Random(i), 80, 9000), None, None, 0, *odd.EXTRA) for i in range(5)]
    rows = quality.judge_documents(odd.frame(spark, few)).collect()
    assert all(r.kept and r.distance is None for r in rows)


def test_each_statistic_rejects_alone(spark):
    """In a pool of usual documents one that is far off in a single statistic goes, whichever it is."""
    rng = random.Random(8)
    usual = [[f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(80, 700))] for _ in range(400)]
    texts = [" ".join(w) for w in usual]
    plain = [f"v{k}" for k in range(300)]
    odd_ones = {
        "length": " ".join(f"v{k}" for k in range(90_000)),
        "word_length": " ".join(f"{k}v" * 12 for k in range(300)),
        "symbols": " ".join(plain) + " " + "#" * 60,
        "dup_lines": " ".join(plain) + "\nab\n" + "ab\n" * 60,
        "repeats": " ".join(plain + [w for k in range(36) for w in (plain[5 * k], plain[5 * k + 1], plain[5 * k + 2], f"u{k}")]),
    }
    docs = [(i, t, "en", "s", 0, *odd.EXTRA) for i, t in enumerate([*texts, *odd_ones.values()])]
    rows = {r.doc_id: r for r in quality.judge_documents(odd.frame(spark, docs)).collect()}
    for i, name in enumerate(odd_ones, len(texts)):
        assert not rows[i].base_failed and not rows[i].kept, name
    far = sorted(rows[i].distance for i in range(len(texts)))
    assert sum(rows[i].kept for i in range(len(texts))) >= 398 and far[len(far) // 2] <= 6


def test_statistics_that_go_together(spark):
    """Two statistics of a perfect correlation do not make the estimate fail."""
    docs = [(i, " ".join(f"x{i}y{k}" + "#" * (i % 7) for k in range(60 + i % 3)), "en", "s", 0, *odd.EXTRA) for i in range(300)]
    rows = quality.judge_documents(odd.frame(spark, docs)).collect()
    assert all(r.distance is not None and math.isfinite(r.distance) for r in rows)
