import sys
import unicodedata

import numpy as np
import odd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lapak.llm import tokens

from tokenizers import Tokenizer

PLAIN = Tokenizer.from_file(tokens.vocabulary_path())
ENCODER = tokens.encoder(tokens.vocabulary_path())


def whole(text):
    """The library's own answer for the whole text."""
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aAbB ,.'st\n\t\x0b\x1c\x85\xa0éÉ́Σσ0½ﬁ中あ​😀<|>#", max_size=40), max_size=5))
def test_words_give_the_ids_of_whole_texts(texts):
    ids, counts = ENCODER.encode(pa.array(texts, pa.string()))
    at = 0
    for text, n in zip(texts, counts):
        assert ids[at : at + n].tolist() == whole(text)
        at += n
    assert at == len(ids)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" .,!'-ab\u0301")), max_size=30), max_size=4))
def test_texts_of_any_characters(texts):
    ids, counts = ENCODER.encode(pa.array(texts, pa.string()))
    assert ids.tolist() == [i for t in texts for i in whole(t)]
    assert counts.tolist() == [len(whole(t)) for t in texts]


def test_letters_that_end_in_a_combining_mark():
    """Each letter whose normal form does not end in a letter, before each mark, as the library has it."""
    letters = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isalpha() and not unicodedata.normalize("NFC", c).lower()[-1].isalpha()]
    assert "\u0130" in letters and "\u0958" in letters and len(letters) >= 60
    texts = [f"x{c}{m}" for c in letters for m in tokens.MARKS] + [f"{c}{m}y {c}{c}, {c}" for c in letters for m in ".!'"]
    ids, counts = tokens.WordEncoder(tokens.vocabulary_path()).encode(pa.array(texts))
    at = 0
    for text, n in zip(texts, counts.tolist()):
        assert ids[at : at + n].tolist() == whole(text), text
        at += n


def test_every_letter_before_a_mark():
    letters = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isalpha()]
    texts = [" ".join(f"a{c}." for c in letters[k : k + 500]) for k in range(0, len(letters), 500)]
    ids, _ = tokens.WordEncoder(tokens.vocabulary_path()).encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in whole(t)]


@pytest.mark.parametrize("code", [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, 0x2000, 0x2028, 0x202F, 0x3000, 0x200B, 0xFEFF])
def test_every_kind_of_blank(code):
    for text in (f"ab{chr(code)}cd", f"x{chr(code)}'s", f"{chr(code)}b{chr(code)}{chr(code)}c"):
        assert ENCODER.encode(pa.array([text]))[0].tolist() == whole(text)


def test_documents_and_forgetting(monkeypatch):
    texts = [d[1] for d in odd.documents()]
    expected = [[*whole(t), tokens.END] for t in texts]
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    fresh = tokens.WordEncoder(tokens.vocabulary_path())
    monkeypatch.setitem(tokens._ENCODERS, "own", fresh)
    got = [ids for k in range(0, len(texts), 10) for ids in tokens.documents_ids(pa.array(texts[k : k + 10], pa.string()), "own")]
    assert [g.tolist() for g in got] == expected
    assert all(g.dtype == np.dtype("<u4") for g in got)


@pytest.mark.parametrize("word", ["İstanbul.", "ﬁn,", "½", "a½.", "x's.", "don't'", "ª.", "ſt!", "ǅ", "Ω", "aͅb", "ʼn", "A.B.", "a_b_", "_", "''", "中。", "ٲ"])
def test_single_words(word):
    fresh = tokens.WordEncoder(tokens.vocabulary_path())
    texts = [word, word.lower(), f"plain {word} words", word * 2]
    ids, counts = fresh.encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in whole(t)]


def test_batches_keep_all_rows():
    rows = {"doc_id": [1, None, 2**60 + 1, 4], "text": ["a" * 10, None, "b" * 30, ""]}
    parts = list(tokens.text_batches([pa.RecordBatch.from_pydict(rows)], size=12))
    assert [i for p in parts for i in p["doc_id"].to_pylist()] == rows["doc_id"]
    assert len(parts) == 2
    empty = pa.RecordBatch.from_pydict({"doc_id": [], "text": pa.array([], pa.string())})
    assert list(tokens.text_batches([empty])) == []


def test_special_tokens_as_the_library_has_them():
    plain = PLAIN
    texts = ["<|endoftext|>", "a <|startoftext|> b", "end<|endoftext|>. Next", "<|endoftext|><|endoftext|>!", "<|ENDOFTEXT|> <| endoftext |>", "no, <|none|>"]
    ids, _ = tokens.WordEncoder(tokens.vocabulary_path()).encode(pa.array(texts))
    expected = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == [i for e in expected for i in e]
    assert expected[0] == [49407] and 49406 in expected[1]
