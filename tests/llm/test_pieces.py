import hashlib
import random

import numpy as np
import odd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from lapak.llm import pieces
from lapak.llm.tokens import vocabulary_path

LIBRARY = SentencePieceProcessor(model_file=vocabulary_path(pieces.MODEL))
ENCODER = pieces.PieceEncoder(pieces.PieceModel(vocabulary_path(pieces.MODEL)))
MODEL = ENCODER.model


def same(text):
    ids = ENCODER.encode(text)
    assert ids.tolist() == LIBRARY.encode(text), repr(text[:200])
    assert MODEL.decode(ids) == LIBRARY.decode(ids.tolist()), repr(text[:200])


@settings(max_examples=500, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    same(text)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="aabeeorstnh  ▁\n\t.,'-é中\x00<0xA>s/", max_size=80))
def test_texts_of_few_letters(text):
    same(text)


def test_texts_of_pieces():
    rng = random.Random(1)
    usual = [p for p in MODEL.id_of if p.strip(pieces.BLANK)]
    for _ in range(3000):
        same("".join(rng.choice(usual) for _ in range(rng.randint(1, 8))).replace(pieces.BLANK, rng.choice([" ", "", "▁"])))


def test_every_piece_alone_and_doubled():
    for piece in MODEL.id_of:
        same(piece)
        same(piece + piece)


@pytest.mark.parametrize("before, after", [("", ""), ("a", "b"), ("a", " "), ("\n", "\n"), (" ", "中"), ("", "\U0001f600"), ("é", "…")])
def test_runs_of_blanks(before, after):
    for n in [*range(0, 70), 500, 10_000]:
        same(before + " " * n + after)


@pytest.mark.parametrize("text", ["", " ", "  a b  ", "a▁b", "▁", "<s> </s> <unk> <0x0A>", "\x00", "x" * 30_000, "ab" * 20_000, "=" * 999, "-" * 1000, "0" * 5000, "\U0001f600" * 300, "e" + "́" * 50])
def test_single_texts(text):
    same(text)


def test_pairs_against_plain_bpe():
    """The test by growing edges says what merging both pieces together says."""
    rng = random.Random(2)
    known = [i for i in range(MODEL.n) if MODEL.rights[i]]
    frequent = [i for i in known if len(MODEL.texts[i]) < 4][:3000]
    for pool in (known, frequent):
        for _ in range(6000):
            a, b = rng.choice(pool), rng.choice(pool)
            if pieces.BLANK in MODEL.texts[b]:
                continue
            merged = MODEL._merged(MODEL.texts[a] + MODEL.texts[b])[0]
            assert MODEL.side_by_side(a, b) == (merged == [MODEL.texts[a], MODEL.texts[b]])


def test_decoding_any_ids():
    """Also ids that no text gives: lone bytes, control and unknown ids, blanks in front."""
    rng = random.Random(3)
    some = [0, 1, 2, *range(3, 300), *rng.sample(range(300, MODEL.n), 300)]
    for _ in range(5000):
        ids = [rng.choice(some) for _ in range(rng.randint(0, 12))]
        assert MODEL.decode(np.array(ids, dtype=np.int32)) == LIBRARY.decode(ids), ids


def test_forgetting(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 20)
    fresh = pieces.PieceEncoder(MODEL)
    for d in odd.documents():
        assert fresh.encode(d[1]).tolist() == LIBRARY.encode(d[1] or "")
    assert len(fresh.pairs) < 100_000


def test_documents(spark):
    docs = odd.documents()

    def expected(doc):
        ids = LIBRARY.encode(doc[1] or "")
        joined = ",".join(map(str, ids)).encode()
        return doc[0], len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()

    got = [tuple(r) for r in pieces.piece_documents(odd.frame(spark)).collect()]
    assert sorted(map(str, got)) == sorted(str(expected(d)) for d in docs)
    assert pieces.piece_documents(odd.frame(spark, [])).count() == 0


def test_real_ids_and_other_columns(spark):
    """The operator keeps all other columns, whatever their names, and its ids decode again."""
    rows = spark.createDataFrame([(1, "Hello  world é", "x"), (1, None, None), (2, "", "y")], "ids_ int, body string, text string")
    with_ids = pieces.encoded(rows, "body", "ids")
    assert with_ids.columns == ["ids_", "text", "ids"]
    assert [r.ids for r in with_ids.orderBy("text").collect()] == [[], LIBRARY.encode("Hello  world é"), []]
    back = pieces.decoded(with_ids, "ids", "body")
    assert sorted(map(str, back.select("ids_", "body", "text").collect())) == sorted(
        map(str, rows.fillna("", ["body"]).collect())
    )
