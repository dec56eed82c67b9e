import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import odd
import pytest
import regex

from lapak.llm import sanitise

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(value):
    digits = [int(c) for c in value if c in "0123456789"]
    doubled = [d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits))]
    return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0


HOLDS = {
    "email": lambda v: True,
    "ip": lambda v: all(int(p) <= 255 for p in v.split(".")),
    "card": luhn,
    "phone": lambda v: 8 <= sum(c in "0123456789" for c in v) <= 15,
}


def brute(text):
    return [(k, m.start(), m.end()) for k in PLAIN for m in re.finditer(PLAIN[k], text or "") if HOLDS[k](m[0])]


def card(rng, n=16, sep=""):
    digits = [rng.randint(0, 9) for _ in range(n - 1)]
    total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits)))
    return sep.join(map(str, [*digits, -total % 10]))


def texts():
    rng = random.Random(9)
    out = [None, "", "a@b", "a@b.c", "x.y+z%@a-b.c.d_e@f.g!h@i.j.k@l.m", "@a.b", "é😀a@b.cü1.2.3.4", "1.2.3.4.5.6.7.8", "1.2.3",
           "001.02.3.255 1.2.3.256 0.0.0.0000 1234.1.1.1.1", "+1 (234) 555-6789, +12 +1+2345678901 +1-2345678-", "+1" + "-" * 50 + "2",
           card(rng), card(rng, 19, "-"), card(rng, 17, " "), card(rng, 15), card(rng, 20), card(rng) + " 1", card(rng) + "  1", "1-" + card(rng),
           "a" * 50_000, "1" * 50_000, "1 " * 30_000, "a@" * 20_000, "1." * 20_000, "+1" * 20_000, "a.b@c.d " * 800, "x" * 30_000 + "@y.z"]
    for _ in range(400):
        out.append("".join(rng.choice(["a", "Z9", "@", ".", "b.c", " ", "-", "+1", "12", "3", "(", ")", "_", "é", "😀", "1.2", card(rng), "\n", "%"]) for _ in range(rng.randint(1, 30))))
    return out


def test_base_spans(spark):
    given = texts()
    docs = [(i, t, None, None, None, *odd.EXTRA) for i, t in enumerate(given)]
    rows = {r.doc_id: r for r in sanitise.find(odd.frame(spark, docs)).collect()}
    assert len(rows) == len(given)
    for i, t in enumerate(given):
        spans = brute(t)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert rows[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), (t or "")[:200]
        assert ",".join(s for s in rows[i].spans.split(",") if not s.startswith("term")) == joined
        assert [rows[i][f"n_{k}"] for k in PLAIN] == [sum(s[0] == k for s in spans) for k in PLAIN]


def corpus():
    """One address always stands beside a rare name; another beside words that are everywhere."""
    rng = random.Random(3)
    rows = []
    for i in range(200):
        text = odd.words(rng, 30, 60)
        if i < 6:
            text += f" Zebulon told bob@mail.example {text[:20]} tail {i}"
        elif i < 12:
            text += f" w1 w2 w3 eve@mail.example w4 w5 tail {i}"
        elif i == 12:
            text += " Quentin once@mail.example"  # one text is no estimate
        elif i == 13:
            text += " Zebulon alone"
        rows.append((i, text, "en", "a", len(text), *odd.EXTRA))
    copy = "Solitary copies@mail.example beside"
    return rows + [(300 + i, copy, "en", "a", len(copy), *odd.EXTRA) for i in range(20)]


def test_disclosing_terms(spark):
    docs = odd.frame(spark, corpus())
    scanned = sanitise.scan(docs.select("text"))
    found = {(r.entity, r.term): r.replacement for r in sanitise.disclosing(docs.select("text"), scanned).collect()}
    assert found["email bob@mail.example", "zebulon"] == "NAME"
    assert not any(t in ("w1", "w2", "w3", "w4", "w5") for e, t in found if e.startswith("email eve"))
    assert {e for e, _ in found} <= {"email bob@mail.example", "email eve@mail.example"}
    spans = {r.doc_id: r.spans for r in sanitise.find(docs).collect()}
    text = {d[0]: d[1] for d in corpus()}
    for i in range(6):
        at = text[i].index("Zebulon")
        assert f"term:{at}:{at + 7}" in spans[i].split(",")
    assert spans[13] == "" and spans[12].count("term") == 0 and spans[300].count("term") == 0


def test_an_entity_in_one_text_is_weighed(spark):
    """In a corpus large enough, one text shows what a term gives away; fewer documents do not."""
    docs = [(i, f"plain words of text again w{i % 40} w{i % 41}", "en", "a", 1, *odd.EXTRA) for i in range(2000)]
    docs.append((5000, "plain words Quentin again once@mail.example text", "en", "a", 1, *odd.EXTRA))
    spans = {r.doc_id: r.spans for r in sanitise.find(odd.frame(spark, docs)).collect()}
    assert spans[5000].split(",") == ["email:26:43", "term:12:19"]
    few = docs[:100] + docs[-1:]
    spans = {r.doc_id: r.spans for r in sanitise.find(odd.frame(spark, few)).collect()}
    assert spans[5000] == "email:26:43"


def test_terms_anywhere_in_the_document(spark):
    """A term counts and is masked however far from the entity, each time, and however short."""
    plain = [(i, f"plain words of text again w{i % 40} w{i % 41}", "en", "a", 1, *odd.EXTRA) for i in range(2000)]
    far = "Quentin " + "plain words " * 200 + "once@mail.example " + "text again " * 20 + "quentin, Bo 張偉。李 İlk"
    copy = "plain words Zebulon " + "of text " * 20 + "two@mail.example"
    docs = plain + [(i, t, "en", "a", 1, *odd.EXTRA) for i, t in [(5000, far), (5001, copy), (5002, copy), (5003, "")]]
    spans = {r.doc_id: r.spans for r in sanitise.find(odd.frame(spark, docs)).collect()}
    terms = [tuple(map(int, s.split(":")[1:])) for s in spans[5000].split(",") if s.startswith("term")]
    assert [far[a:b] for a, b in terms] == ["Quentin", "quentin", "Bo", "張偉", "李", "İlk"]
    assert spans[5001] == spans[5002] and "term:12:19" in spans[5001].split(",")
    masked = {r.doc_id: r.text for r in sanitise.sanitise(odd.frame(spark, docs)).collect()}
    assert "uentin" not in masked[5000] and "張" not in masked[5000] and masked[0] == plain[0][1]


def test_copies_without_entity_are_one_text(spark):
    """Where documents without entities decide, their different texts are what counts."""
    words = [f"w{i % 40} w{i % 41} of the text" for i in range(1200)]
    held = [f"Zebulon t{i}@mail.example of the text w{i}" for i in range(1)] + [f"Zebulon same@mail.example w{i} of the text" for i in range(8)]
    for others in (["Zebulon alone"] * 2, [f"Zebulon alone w{i}" for i in range(2)]):
        docs = odd.frame(spark, [(i, t, "en", "a", 1, *odd.EXTRA) for i, t in enumerate(words + held + others)])
        found = sanitise.disclosing(docs, sanitise.scan(docs.select("text"))).collect()
        n, texts = len(words + held + others), 9 + len(set(others))
        share, z2 = 8 / texts, sanitise.SURE**2
        low = (share + z2 / (2 * texts) - sanitise.SURE * (share * (1 - share) / texts + z2 / (4 * texts**2)) ** 0.5) / (1 + z2 / texts)
        reached = math.log2(n * 8 / (8 * 11) * low / share) >= sanitise.DISCLOSED * math.log2(n / 8)
        assert (("email same@mail.example", "zebulon") in {(r.entity, r.term) for r in found}) == reached


def test_places_of_words(spark):
    texts = ["", " ", "a", "é😀b.c  Dd", "x " * (2 * sanitise.BLOCK), " ".join(f"w{i}" for i in range(1000)), "." * 300 + "ab"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r.text: [tuple(m) for m in r.at] for r in rows.select("text", sanitise.words_at(rows.text).alias("at")).collect()}
    for t in texts:
        assert got[t] == [(m.start(), m.end(), m[0]) for m in re.finditer(r"[^\W_]+", t)]


def test_evidence_of_few_texts(spark):
    rows = spark.createDataFrame([(1, 1), (1, 2), (3, 3), (100, 100), (100, 200)], "k long, n long")
    parts = [r[0] for r in rows.select(sanitise.certain(rows.k, rows.n)).collect()]
    assert parts[1] < parts[0] < parts[2] < parts[3] < 1
    assert parts[0] == pytest.approx(1 / (1 + sanitise.SURE**2)) and parts[4] > 0.85


def test_sanitised_documents(spark):
    docs = corpus()
    out = sanitise.sanitise(odd.frame(spark, docs))
    assert out.columns == odd.frame(spark).columns
    assert out.schema == odd.frame(spark).schema
    rows = {r.doc_id: r for r in out.collect()}
    assert len(rows) == len(docs)
    for d in docs:
        r = rows[d[0]]
        assert r.n_chars == len(r.text) and "@" not in r.text
        if "@" not in d[1]:
            assert r.text == d[1]
    assert "[NAME] [WORD] [EMAIL]" in rows[0].text
    assert rows[300].text == "Solitary [EMAIL] beside"


@pytest.mark.parametrize("text, expected", [("a 1.2.3.4 b", "a [IP] b"), ("x@1.2.3.4", "[EMAIL]"), ("mail +1 234 567 8901.5.6.7 x", "mail [PHONE] x"), (None, None), ("", "")])
def test_overlapping_spans(spark, text, expected):
    row = sanitise.sanitise(odd.frame(spark, [(1, text, None, None, None, *odd.EXTRA)])).first()
    assert row.text == expected


def test_odd_documents(spark):
    assert sanitise.find(odd.frame(spark, [])).count() == 0
    assert sanitise.sanitise(odd.frame(spark, [])).count() == 0
    docs = odd.documents()
    assert sanitise.find(odd.frame(spark)).count() == len(docs)
    assert sorted(map(str, sanitise.sanitise(odd.frame(spark)).collect())) == sorted(map(str, odd.frame(spark).collect()))


CLASS_OF_TEXT = {"NUMBER": r"\p{N}", "NAME": r"(?<![\p{L}\p{N}])\p{Lu}", "WORD": r"(?<![\p{L}\p{N}])(?!\p{Lu})\p{L}"}


def brute_spans(texts):
    """Spans of every text by the definition: all pairs of entity and term, all counts in memory."""
    n = len(texts)
    low = lambda t: t.replace("İ", "i").lower().replace("ς", "σ")
    kind = lambda w: "NUMBER" if regex.search(r"\p{N}", w) else "NAME" if regex.match(r"\p{Lu}", w) else "WORD"
    copies, terms, entities, classes = Counter(t or "" for t in texts), {}, {}, {}
    for t in copies:
        words = regex.findall(r"[\p{L}\p{N}]+", t)
        terms[t] = {}
        for w in words:
            terms[t][low(w)] = min(kind(w), terms[t].get(low(w), "Z"))
        entities[t] = {f"{k} {t[a:b].lower()}" for k, a, b in brute(t)}
        classes[t] = {c for c, p in CLASS_OF_TEXT.items() if regex.search(p, t)}
    d_e, d_t, t_t, d_c = Counter(), Counter(), Counter(), Counter()
    d_et, t_et, d_ec, least = Counter(), Counter(), Counter(), {}
    for t, k in copies.items():
        for e in entities[t]:
            d_e[e] += k
            d_ec.update({(e, c): k for c in classes[t]})
            for w, c in terms[t].items():
                d_et[e, w] += k
                t_et[e, w] += 1
                least[e, w] = min(c, least.get((e, w), "Z"))
        d_c.update({c: k for c in classes[t]})
        d_t.update({w: k for w in terms[t]})
        t_t.update(terms[t].keys())
    found = {}
    z = sanitise.SURE
    for (e, w), both in d_et.items():
        limit = sanitise.DISCLOSED * math.log2(n / d_e[e])
        share, of = t_et[e, w] / t_t[w], t_t[w]
        low_end = (share + z * z / (2 * of) - z * math.sqrt(share * (1 - share) / of + z * z / (4 * of * of))) / (1 + z * z / of)
        if limit > 0 and math.log2(n * both / (d_e[e] * d_t[w])) * 1.0 + math.log2(low_end / share) >= limit:
            c = least[e, w]
            found[e, w] = c if math.log2(n * d_ec[e, c] / (d_e[e] * d_c[c])) < limit else ""
    out = []
    for t in texts:
        t = t or ""
        base = brute(t)
        hits = defaultdict(list)
        for e in entities[t]:
            for w in terms[t]:
                if (e, w) in found:
                    hits[w].append(found[e, w])
        spans = [("term", m.start(), m.end()) for m in regex.finditer(r"[\p{L}\p{N}]+", t)
                 if low(m[0]) in hits and not any(a < m.end() and m.start() < b for _, a, b in base)]
        out.append(",".join(f"{k}:{a}:{b}" for k, a, b in [*base, *spans]))
    return out, found


@pytest.mark.parametrize("seed, sure", [(1, 0.1), (2, 0.4), (3, 1.2815515655446004)])
def test_disclosed_terms_against_memory(spark, monkeypatch, seed, sure):
    monkeypatch.setattr(sanitise, "SURE", sure)
    if seed == 2:
        monkeypatch.setattr(sanitise, "SENT", 0)
    rng = random.Random(seed)
    names = ["Zebulon", "zebulon", "Quentin", "ΣΟΦΟΣ", "σοφος", "İlk", "x9", "張偉", "Bo"]
    texts = []
    for i in range(500):
        text = odd.words(rng, rng.randint(0, 25), 80)
        for k in range(rng.choice([0, 0, 0, 1, 2])):
            mail = rng.randint(0, 30)
            text += f" {rng.choice(['mail', 'Mail'])} u{mail}@mail.example" + (f" {names[mail % len(names)]}" if rng.random() < 0.7 else "")
        if rng.random() < 0.1:
            text += " " + rng.choice(names)
        texts += [text] * rng.choice([1, 1, 1, 4])
    texts += [None, "", "+1 234 567 8901 unique words", "lone@mail.example"]
    docs = odd.frame(spark, [(i, t, None, None, None, *odd.EXTRA) for i, t in enumerate(texts)])
    expected, pairs = brute_spans(texts)
    scanned = sanitise.scan(docs.select("text"))
    assert {(r.entity, r.term): r.replacement for r in sanitise.disclosing(docs, scanned).collect()} == pairs
    assert len(pairs) > 20 and {"", "WORD"} <= set(pairs.values()) | {""}
    got = {r.doc_id: r.spans for r in sanitise.find(docs).collect()}
    assert [got[i] for i in range(len(texts))] == expected


def test_pairs_of_a_text_full_of_addresses_stay_linear(spark):
    """2,000 addresses and 10,000 words in one text: pairs by group, not by address."""
    full = " ".join(f"a{i}@mail.example" for i in range(2000)) + " " + " ".join(f"v{i}q" for i in range(10_000))
    docs = [(i, f"plain words of text again w{i % 40} w{i % 41}", "en", "a", 1, *odd.EXTRA) for i in range(1500)]
    docs += [(5000, full, "en", "a", 1, *odd.EXTRA), (5001, "a1@mail.example again", "en", "a", 1, *odd.EXTRA)]
    frame = odd.frame(spark, docs)
    scanned = sanitise.scan(frame.select("doc_id", "text"), ("doc_id",))
    _, groups, pairs, entities = sanitise.together(scanned, len(docs))
    assert entities.count() == 2000 and groups.count() == 3
    assert pairs.count() < 3 * 14_000
    spans = {r.doc_id: r.spans for r in sanitise.find(frame).collect()}
    assert spans[5000].count("term:") == 10_000 and spans[5000].count("email:") == 2000
