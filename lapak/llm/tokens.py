"""Token ids of whole texts by the tokenizers library.

The vocabulary drops white space and never joins characters across it, so the ids of a text are
those of its blank-separated words in turn. Each distinct word is encoded once by the library and
remembered; the memory is bounded and starts anew when full.
"""

from __future__ import annotations

import os
import string
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words a worker remembers (about 200 bytes each).
REMEMBERED = 1_000_000
#: Id appended to every document.
END = 2
VOCABULARY = "word_bpe_49k.json"
#: The library splits letters from these, and a run of them is one piece (an apostrophe is not).
MARKS = string.punctuation.replace("'", "")
#: Words encoded in one call.
CALL = 2048


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Encodes texts through a memory of words."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        #: Ids that end a piece.
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        #: Number of each known word, and per number where its ids start and how many they are.
        self.index: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, dtype="<u4")
        self.starts = np.zeros(1 << 14, dtype=np.int64)
        self.counts = np.zeros(1 << 14, dtype=np.int64)
        self.n = self.used = 0

    def _store(self, words: Sequence[str], ids: np.ndarray, counts: np.ndarray) -> None:
        while self.n + len(words) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        at = slice(self.n, self.n + len(words))
        self.counts[at] = counts
        self.starts[at] = self.used + np.cumsum(counts) - counts
        self.index.update(zip(words, range(at.start, at.stop)))
        self.n += len(words)
        self.used += len(ids)

    def _gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of numbered words in a row, and how many each has."""
        counts = self.counts[numbers]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.arange(total) + np.repeat(self.starts[numbers] - (ends - counts), counts)], counts

    def _any_words(self, words: Sequence[str]) -> None:
        """``word_ids`` tells which word each id belongs to."""
        for at in range(0, len(words), CALL):
            part = list(words[at : at + CALL])
            encoded = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            owners = np.array(encoded.word_ids, dtype=np.int64)
            self._store(part, np.array(encoded.ids, dtype="<u4"), np.bincount(owners, minlength=len(part)))

    def _pieces(self, words: Sequence[str]) -> None:
        """Words that are one piece each: as many ends as words, so every end closes a word."""
        for at in range(0, len(words), CALL):
            part = list(words[at : at + CALL])
            (encoded,) = self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)
            ids = np.array(encoded.ids, dtype="<u4")
            last = np.nonzero(self.ends[ids])[0]
            if len(last) == len(part) and last[-1] == len(ids) - 1:
                self._store(part, ids, np.diff(last, prepend=-1))
            else:  # a letter that the library sees otherwise
                self._any_words(part)

    @staticmethod
    def _ends_in_letter(head: str) -> bool:
        """Whether the library sees a letter at the end: some, normalised, end in a combining mark,
        which it joins to the marks behind."""
        return head.isascii() or unicodedata.normalize("NFC", head).lower()[-1].isalpha()

    def _learn(self, new: Sequence[str]) -> None:
        """A word of letters, with marks behind or not, has the ids of its letters and its marks."""
        split, letters, marks, others = [], {}, {}, []
        known = self.index
        for word in new:
            head = word.rstrip(MARKS)
            if head.isalpha() and self._ends_in_letter(head):
                tail = word[len(head) :]
                if head.isascii():
                    head = head.lower()
                if head not in known:
                    letters[head] = None
                if head != word:
                    split.append((word, head, tail))
                if tail and tail not in known:
                    marks[tail] = None
            else:
                others.append(word)
        self._pieces(list(letters))
        self._any_words([w for w in marks if w not in known])
        self._any_words([w for w in others if w not in known])
        joined = [(w, known[h], known[t]) for w, h, t in split if t]
        known.update((w, known[h]) for w, h, t in split if not t)
        if joined:
            ids, counts = self._gather(np.array([n for _, h, t in joined for n in (h, t)], dtype=np.int64))
            self._store([w for w, _, _ in joined], ids, counts.reshape(-1, 2).sum(axis=1))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each; NULL is an empty text."""
        split = pc.ascii_split_whitespace(texts)
        found = split.flatten().dictionary_encode()
        distinct = found.dictionary.to_numpy(zero_copy_only=False)
        if len(self.index) > REMEMBERED or self.used > 8 * REMEMBERED:
            self._forget()
        known = self.index
        numbers = np.fromiter(map(known.get, distinct, repeat(-1)), dtype=np.int64, count=len(distinct))
        missing = np.nonzero(numbers < 0)[0]
        if len(missing):
            new = distinct[missing].tolist()
            self._learn(new)
            numbers[missing] = np.fromiter(map(known.__getitem__, new), dtype=np.int64, count=len(new))
        ids, counts = self._gather(numbers[found.indices.to_numpy()])
        words = pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False)
        upto = np.concatenate([[0], np.cumsum(counts)])
        last = np.cumsum(words)
        return ids, upto[last] - upto[last - words]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and vocabulary, kept for its later tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def documents_ids(texts: pa.Array, path: str) -> list[np.ndarray]:
    """Ids of each text with the end id, as unsigned 32-bit little-endian arrays."""
    ids, counts = encoder(path).encode(texts)
    out, at = [], 0
    for n in counts.tolist():
        one = np.empty(n + 1, dtype="<u4")
        one[:n] = ids[at : at + n]
        one[n] = END
        out.append(one)
        at += n
    return out


def text_batches(batches: Iterable[pa.RecordBatch], size: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to about ``size`` bytes of text, or one text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(sizes, dtype=np.int64) // size
        cuts = np.nonzero(np.diff(block))[0] + 1
        for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield batch.slice(first, last - first)
