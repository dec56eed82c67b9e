import random
import re
from collections import Counter, defaultdict

import duckdb
import odd
import pytest

from lapak.llm import collocations

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute(docs, least, top, longest=4):
    """All phrases counted in memory, scored with Python's integers."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        rows = []
        cands = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        covered = Counter()
        for p, a in cands.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    covered[p[i : i + m]] = max(covered[p[i : i + m]], a)
        for p, a in cands.items():
            if p in covered and 100 * covered[p] >= 80 * a:
                continue
            cuts = [(2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
            s, k = min(cuts)
            rows.append((-s, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def result(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, df.collect()))


def corpus(seed=1, n=400):
    rng = random.Random(seed)
    marks = [" ", " ", " ", " ", ", ", ". ", "\n", "\t", "  ", "\x1c", ";", " \x0b", "!?"]
    docs = []
    for i in range(n):
        words = [rng.choice(["a", "B", "b", "ü", "Ü", "c", "d'", "e-f", "\U0001f600", "ｚ"])[: rng.randint(1, 3)] if rng.random() < 0.7 else f"w{rng.randint(0, 50)}" for _ in range(rng.randint(0, 60))]
        text = "".join(w + rng.choice(marks) for w in words)
        if i % 9 == 0:
            text += " the quick brown fox" * rng.randint(1, 4)
        docs.append((text if i % 50 else None, rng.choice(["en", "de", None, "und", ""])))
    docs += [("same words again here. " * 4, "hot")] * 40 + [("x " * 3000, "long"), ("y" * 100_000, "long"), ("", "empty"), (" .,", "empty")]
    return docs


def frame(spark, docs):
    rows = [(i, t, g, None, None, *odd.EXTRA) for i, (t, g) in enumerate(docs)]
    return odd.frame(spark, rows)


@pytest.mark.parametrize("lookup, block", [(1_000_000, 7), (0, 7), (40, 50)])
def test_against_memory(spark, monkeypatch, lookup, block):
    """Whatever the blocks, and whether frequent groups are looked up or joined."""
    monkeypatch.setattr(collocations, "LOOKUP", lookup)
    monkeypatch.setattr(collocations, "BLOCK", block)
    monkeypatch.setattr(collocations, "JOINED", 20 * block)
    docs = corpus()
    assert result(collocations.collocations(frame(spark, docs), 5, 60)) == brute(docs, 5, 60)


def test_production_parameters_and_sql(spark, tmp_path):
    docs = corpus(2, 4000)
    rows = brute(docs, collocations.LEAST, collocations.TOP)
    assert len(rows) > 100
    assert result(collocations.collocations(frame(spark, docs))) == rows
    frame(spark, docs).write.parquet(f"{tmp_path}/documents")
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    assert sorted(db.sql(collocations.SQL).fetchall()) == rows


def test_ties_are_cut_in_byte_order(spark):
    words = ["z", "é", "\U0001f600", "ｚ", "a"]
    docs = [(" . ".join(f"{a} {b}" for a in words for b in words), "en")] * 5
    for top in (1, 7, 24):
        assert result(collocations.collocations(frame(spark, docs), 5, top)) == brute(docs, 5, top)


def test_large_counts(spark):
    """Scores stay exact where products pass 64 bits."""
    big = 9_000_000_000_000_000_000
    rows = spark.createDataFrame([(big, big, big), (big - 1, big, big), (1, big, 1), (7, 9, 11), (big // 3, big // 2, big)], "a bigint, l bigint, r bigint")
    got = rows.select("a", "l", "r", collocations.score(rows.a, rows.l, rows.r).alias("s")).collect()
    assert [x.s for x in got] == [2_000_000 * x.a // (x.l + x.r) for x in got]


def test_odd_documents(spark):
    docs = odd.documents()
    expected = brute([(d[1], d[2]) for d in docs], 30, 2000)
    assert result(collocations.collocations(odd.frame(spark))) == expected
    assert collocations.collocations(odd.frame(spark, [])).count() == 0
    nothing = [(1, None, None, None, None, *odd.EXTRA)]
    assert collocations.collocations(odd.frame(spark, nothing)).count() == 0


def test_real_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.text, r.lang) for r in docs.select("text", "lang").collect()]
    assert result(collocations.collocations(docs)) == brute(rows, 30, 2000)
