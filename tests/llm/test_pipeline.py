from collections import Counter, defaultdict

import numpy as np
import odd
import test_packing
from test_quality import brute_counts
from test_sanitise import brute as private
from test_simhash import brute_groups, brute_print

import corpus_pipeline
from lapak.llm import packing


def test_stages_one_after_another(spark, tmp_path):
    folder = odd.stored(spark, tmp_path)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if name != "pack":
            assert docs.columns == columns
            seen[name] = [tuple(r) for r in docs.collect()]
    given = odd.documents()
    good = Counter(seen["quality"])
    assert not good - Counter(given)
    for d in given:
        n, _, _, _, repeated = brute_counts(d[1])
        if n < 50 or 100 * repeated > 50 * n:
            assert d not in good
    root = brute_groups({brute_print(d[1]) for d in good})
    assert Counter(root[brute_print(d[1])] for d in seen["near_copies"]) == Counter(set(root.values()))
    assert sorted(d[0] for d in seen["private"]) == sorted(d[0] for d in seen["near_copies"])
    assert not any(private(d[1]) for d in seen["private"])
    assert set(seen["mix"]) <= set(seen["private"])
    assert max(Counter(seen["mix"]).values()) <= 3
    words = defaultdict(int)
    for d in seen["mix"]:
        words[d[3]] += len(odd.WORD.findall(d[1]))
    assert sum(words.values()) > 0
    test_packing.check(docs.collect(), seen["mix"])


def test_run(spark, tmp_path):
    rows = corpus_pipeline.run(spark, odd.stored(spark, tmp_path)).collect()
    held = defaultdict(int)
    for r in rows:
        held[r.sequence_id] += r.length
    assert rows and max(held.values()) <= packing.LENGTH
    assert np.mean(list(held.values())) > 0


def test_empty_and_repeated(spark, tmp_path):
    assert corpus_pipeline.run(spark, odd.stored(spark, tmp_path / "none", [])).count() == 0
    text = " ".join(f"w{i}" for i in range(60))
    same = [(1, text, None, None, None, *odd.EXTRA)] * 5
    rows = corpus_pipeline.run(spark, odd.stored(spark, tmp_path / "same", same)).collect()
    assert [r.doc_id for r in rows] == [1]
