import math
import random
from collections import defaultdict

import odd
import pytest

from lapak.llm import classifier


def corpus(n=600):
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < (0.3 if i % 4 == 0 else 0.9)
        text = odd.words(rng, rng.randint(60, 200), 3000)
        if not good:
            text = text.replace(" ", "### ") if i % 3 else text[:90]
        docs.append((i, text, "en" if i % 3 else "de", "bad" if i % 4 == 0 else "good", None, *odd.EXTRA))
        labels.append((i, int(good), 0))
    return docs, labels


def classify(spark, docs, labels):
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    return {r.doc_id: r for r in classifier.classify_documents(odd.frame(spark, docs), frame).collect()}


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    rows = classify(spark, docs, [x for x in labels if x[0] % 5 > 1])
    held = [x for x in labels if x[0] % 5 <= 1]
    right = sum(rows[i].kept == bool(q) for i, q, _ in held)
    assert right >= 0.97 * len(held)
    assert rows[0].p_host < rows[1].p_host


def test_posteriors(spark):
    rng = random.Random(1)
    rows = []
    for host, share, n in (("big", 0.9, 400), ("mid", 0.5, 100), ("one", 0.0, 1), (None, 0.1, 50), ("other", 0.95, 200)):
        rows += [(host, f"p{k % 2}", share) for k in range(n)]
    df = spark.createDataFrame(rows, "host string, path string, p_document double")
    sites, overall = classifier.site_posteriors(df)
    found = {(r.host, r.path): r for r in sites.collect()}
    assert overall == pytest.approx(sum(r[2] for r in rows) / len(rows))
    assert found["big", "p0"].p_host == pytest.approx(0.9, abs=0.01)
    assert found[None, "p1"].p_host == pytest.approx(0.1, abs=0.06)
    # One document moves its site a little, away from the global share but not to its own value.
    assert 0.1 < found["one", "p0"].p_host < overall
    assert found["one", "p0"].p_path <= found["one", "p0"].p_host


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, 0, 0)], [(1, 1, 0), (1, 0, 0), (None, 1, 0), (2, None, 0)]])
def test_labels_of_one_kind(spark, labels):
    rows = classify(spark, odd.documents(), labels)
    share = (sum(x[1] for x in labels[:1]) + 1) / (len(labels[:1]) + 2) if len(labels) < 2 else 0.5
    assert all(r.p_document == pytest.approx(share) for r in rows.values())


def test_odd_documents(spark):
    labels = [(i, int(i % 9 != 0), 0) for i in range(0, 300, 2)]
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    docs = odd.documents()
    rows = classifier.classify_documents(odd.frame(spark), frame).collect()
    assert len(rows) == len(docs)
    assert all(r.kept is not None and 0 <= r.p_good <= 1 for r in rows)
    assert classifier.classify_documents(odd.frame(spark, []), frame).count() == 0


def brute_posteriors(rows):
    """p_host, p_path, p_good of every (host, path, p_document), by the definition in memory."""
    def weight(groups):
        n = sum(len(g) for _, g in groups)
        if not n:
            return classifier.MOST_WEIGHT
        chance = overall * (1 - overall)
        spread = sum(len(g) * (sum(g) / len(g) - m) ** 2 for m, g in groups)
        between = (spread - len(groups) * chance) / max(n - sum(len(g) ** 2 for _, g in groups) / n, 1.0)
        w = chance / between - 1 if between > 0 else classifier.MOST_WEIGHT
        return min(max(w, classifier.LEAST_WEIGHT), classifier.MOST_WEIGHT)

    overall = min(max(sum(r[2] for r in rows) / len(rows), classifier.EDGE), 1 - classifier.EDGE)
    hosts, paths = defaultdict(list), defaultdict(list)
    for h, p, x in rows:
        hosts[h].append(x)
        paths[h, p].append(x)
    wh = weight([(overall, g) for g in hosts.values()])
    post = lambda g, prior, w: (sum(g) + w * prior) / (len(g) + w)
    p_host = {h: post(g, overall, wh) for h, g in hosts.items()}
    wp = weight([(p_host[h], g) for (h, _), g in paths.items()])
    logit = lambda p: math.log(min(max(p, classifier.EDGE), 1 - classifier.EDGE) / (1 - min(max(p, classifier.EDGE), 1 - classifier.EDGE)))
    out = []
    for h, p, x in rows:
        others_h, others_p = list(hosts[h]), list(paths[h, p])
        others_h.remove(x)
        others_p.remove(x)
        rest = post(others_p, post(others_h, overall, wh), wp)
        good = 1 / (1 + math.exp(-(logit(x) + logit(rest) - logit(overall))))
        out.append((p_host[h], post(paths[h, p], p_host[h], wp), good))
    return out


def test_posteriors_against_memory(spark, monkeypatch):
    """Every document's site as its other documents show it; a lone document has its own evidence only."""
    rng = random.Random(4)
    rows = [(rng.choice(["a", "a", "a", "b", None, f"h{i}"]), rng.choice(["x", "y", None]), rng.random() ** rng.choice([1, 3])) for i in range(300)]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id bigint, host string, path string, p_document double")
    monkeypatch.setattr(classifier, "document_evidence", lambda docs, labels, keep: frame.select(*keep, "p_document"))
    docs = frame.withColumn("text", frame.host)
    got = {r.doc_id: r for r in classifier.classify(docs, frame, frame.host, frame.path).collect()}
    for i, (p_host, p_path, good) in enumerate(brute_posteriors(rows)):
        assert (got[i].p_host, got[i].p_path, got[i].p_good) == pytest.approx((p_host, p_path, good), rel=1e-9)
        assert got[i].kept == (good >= classifier.KEEP)


def test_words_are_evidence(spark):
    """Texts alike in all counts are told apart by their words and word pairs."""
    rng = random.Random(6)
    rows = []
    for i in range(400):
        words = [f"w{rng.randint(0, 200)}" for _ in range(60)]
        words[10:12] = ["red", "blue"] if i % 2 else ["blue", "red"]
        words[20] = "fine" if i % 2 else "dull"
        rows.append((i, " ".join(words), "en", "s", 0, *odd.EXTRA))
    found = classify(spark, rows, [(i, i % 2, 0) for i in range(300)])
    assert sum((found[i].p_document >= 0.5) == bool(i % 2) for i in range(300, 400)) >= 95
