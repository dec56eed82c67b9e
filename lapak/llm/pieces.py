"""SentencePiece BPE without a merge queue: a table of each prefix's last piece.

What BPE makes of a text ends, for every prefix, in one piece only: of all pieces that match at the
prefix's end it is the one that BPE leaves beside the last piece of what stands before it. So one
run of an automaton over the text, with a test per match whether two pieces can stand side by side,
fills a table from which the ids are read backwards. The work is linear in the text however long a
word is.

No piece goes over from another character to a blank, so a text falls apart into words with the
blanks before them, and a word's ids are found once and remembered (in bounded memory). Runs of
blanks are pieces of one and the same, lowest score, which the table's rule does not cover: BPE
joins them last and from the left, and so does ``run``.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name
from .tokens import text_batches, vocabulary_path

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
#: Words and pairs of pieces that a worker remembers, and the longest word it does.
REMEMBERED, LONGEST = 400_000, 64
NEVER = float("inf")
#: Bytes of text, or ids, in an Arrow batch.
BATCH = 4_000_000

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class PieceModel:
    """Pieces of a SentencePiece BPE model with byte fallback and no normalisation but blanks."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        rules, trained = proto.normalizer_spec, proto.trainer_spec
        if trained.model_type != trained.BPE or not trained.byte_fallback or trained.treat_whitespace_as_suffix:
            raise ValueError(f"{path}: not a BPE model with byte fallback")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.add_dummy_prefix or not rules.escape_whitespaces:
            raise ValueError(f"{path}: a model that normalises texts")
        processor = SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.n = processor.get_piece_size()
        self.texts = [processor.id_to_piece(i) for i in range(self.n)]
        self.unknown_text = trained.unk_surface
        self.silent = {i for i in range(self.n) if processor.is_control(i)}
        self.unknown = processor.unk_id()
        byte_ids = [i for i in range(self.n) if processor.is_byte(i)]
        self.byte_of = {i: int(self.texts[i][3:5], 16) for i in byte_ids}
        self.byte_id = {b: i for i, b in self.byte_of.items()}
        usual = [i for i in range(self.n) if i not in self.byte_of and i not in self.silent and i != self.unknown]
        if any(processor.is_unused(i) for i in usual) or any(p.type == p.USER_DEFINED for p in proto.pieces):
            raise ValueError(f"{path}: unused or user-defined pieces")
        self.id_of = {self.texts[i]: i for i in usual}
        runs = {p for p in self.id_of if len(p) > 1 and set(p) == {BLANK}}
        if any(BLANK in p[1:] for p in self.id_of if p not in runs) or BLANK not in self.id_of:
            raise ValueError(f"{path}: pieces that hold a blank inside")
        #: When BPE makes a piece: the higher its score, the earlier. A character is always there.
        self.rank = {p: -processor.get_score(i) for p, i in self.id_of.items() if len(p) > 1 and p not in runs}
        ranks = self.rank.values()
        if len(set(ranks)) < len(ranks) or any(-processor.get_score(self.id_of[p]) <= max(ranks) for p in runs):
            raise ValueError(f"{path}: pieces with equal scores")
        self.run_lengths = {len(p) for p in runs} | {1}
        #: Neighbours that some piece holds; between any others a text can be cut.
        self.joint = {p[k : k + 2] for p in self.rank for k in range(len(p) - 1)}
        alone = "" if any("\n" in p for p in self.joint) else "\n"
        self.cuts = re.compile(f"{BLANK}*[^{BLANK}{alone}]+|{BLANK}+" + ("|\n+" if alone else ""))
        self.automaton = None
        self._decoding()

    def _merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """Plain BPE on a short text: its pieces, and the two that were joined last."""
        parts, pair = list(text), None
        while len(parts) > 1:
            rank, at = min((self.rank.get(a + b, NEVER), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == NEVER:
                break
            pair = (parts[at], parts[at + 1])
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts, pair

    def grow(self) -> None:
        """Automaton of the pieces that BPE can make, and what stands at their edges as they grow.

        Only encoding needs them. ``rights[id]`` lists (piece, rank) that end where the piece ends, the character first;
        ``lefts[id]`` those that start where it starts.
        """
        if self.automaton is not None:
            return
        self.automaton = ahocorasick.Automaton()
        self.lengths = [len(t) for t in self.texts]
        split: dict[str, tuple[str, str]] = {}
        #: Ids whose parts are all made before them; for others pairs are tried out.
        self.plain = [True] * self.n
        reached = []
        for piece in sorted(self.id_of, key=len):
            if len(piece) > 1:
                if piece not in self.rank:  # a run of blanks
                    continue
                parts, pair = self._merged(piece)
                if len(parts) > 1:  # no text has it
                    continue
                split[piece] = pair
            self.automaton.add_word(piece, self.id_of[piece])
            reached.append(piece)
        self.automaton.make_automaton()
        self.rights: list[list] = [[] for _ in range(self.n)]
        self.lefts: list[list] = [[] for _ in range(self.n)]
        for piece in reached:
            i = self.id_of[piece]
            for side, out in ((1, self.rights), (0, self.lefts)):
                at, chain_ = piece, []
                while at in split:
                    chain_.append((at, self.rank[at]))
                    at = split[at][side]
                chain_.append((at, -1))
                out[i] = chain_[::-1]
            inside = [piece]
            while inside and self.plain[i]:
                whole = inside.pop()
                for part in split.get(whole, ()):
                    if part in split:
                        self.plain[i] = self.plain[i] and self.rank[part] < self.rank[whole]
                        inside.append(part)

    def side_by_side(self, a: int, b: int) -> bool:
        """Whether BPE leaves these two pieces apart when one follows the other.

        Both grow from characters in the order of ranks. They stay apart if at no time what stands
        left and right of the border can be joined before one of the two grows on. Of equal ranks
        the one further left is first: growth of ``a``, then a join over the border, then ``b``.
        """
        if not (self.plain[a] and self.plain[b]):
            return self._merged(self.texts[a] + self.texts[b])[0] == [self.texts[a], self.texts[b]]
        left, right, i, j = self.rights[a], self.lefts[b], 0, 0
        while True:
            grow_a = left[i + 1][1] if i + 1 < len(left) else NEVER
            grow_b = right[j + 1][1] if j + 1 < len(right) else NEVER
            over = self.rank.get(left[i][0] + right[j][0], NEVER)
            if over < NEVER and over < grow_a and over <= grow_b:
                return False
            if grow_a == grow_b == NEVER:
                return True
            if grow_a <= grow_b:
                i += 1
            else:
                j += 1

    def run(self, n: int) -> list[int]:
        """Ids of ``n`` blanks that no word takes: joined from the left as far as there are pieces."""
        held: list[int] = []
        for _ in range(n):
            held.append(1)
            while len(held) > 1 and held[-2] + held[-1] in self.run_lengths:
                held[-2:] = [held[-2] + held[-1]]
        return [self.id_of[BLANK * k] for k in held]

    def _decoding(self) -> None:
        self.shown = [t.replace(BLANK, " ") for t in self.texts]
        for i in self.silent:
            self.shown[i] = ""
        for i, byte in self.byte_of.items():
            self.shown[i] = bytes([byte]).decode("utf-8", "each_byte")
        self.shown[self.unknown] = self.unknown_text
        self.is_byte = np.zeros(self.n, dtype=bool)
        self.is_byte[list(self.byte_of)] = True

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids. The blank that encoding put in front goes; bytes that are no character become U+FFFD each."""
        known = ids.tolist()
        parts = list(map(self.shown.__getitem__, known))
        places = np.nonzero(self.is_byte[ids])[0]
        together = np.nonzero(np.diff(places) == 1)[0]
        if len(together):  # characters of several bytes
            for run in np.split(places, np.nonzero(np.diff(places) != 1)[0] + 1):
                if len(run) > 1:
                    first, last = int(run[0]), int(run[-1]) + 1
                    raw = bytes(self.byte_of[i] for i in known[first:last])
                    parts[first:last] = [raw.decode("utf-8", "each_byte"), *[""] * (last - first - 1)]
        for k, (i, part) in enumerate(zip(known, parts)):  # up to the first that shows
            if self.texts[i].startswith(BLANK):
                parts[k] = part[1:]
                break
            if part:
                break
        return "".join(parts)


class PieceEncoder:
    """Encodes texts through the prefix table, remembering words and tested pairs."""

    def __init__(self, model: PieceModel):
        self.model = model
        model.grow()
        #: Words met lately, and those of the time before, with their ids as bytes.
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}

    def prefix_ids(self, text: str) -> list[int]:
        """Ids of a word with at most one blank, which stands in front."""
        model, pairs = self.model, self.pairs
        lengths, n = model.lengths, model.n
        last = array("i", [-1]) * len(text)
        done = -1
        for end, piece in model.automaton.iter(text):
            if end == done:
                continue
            before = end - lengths[piece]
            if before >= 0 and (left := last[before]) >= 0:
                key = left * n + piece
                fits = pairs.get(key)
                if fits is None:
                    fits = pairs[key] = model.side_by_side(left, piece)
                if not fits:
                    continue
            last[end] = piece
            done = end
        ids: list[int] = []
        at = len(text) - 1
        while at >= 0:
            piece = last[at]
            if piece < 0:  # a character without a piece
                ids += [model.byte_id[b] for b in reversed(text[at].encode("utf-8", "surrogatepass"))]
                at -= 1
            else:
                ids.append(piece)
                at -= lengths[piece]
        ids.reverse()
        return ids

    def chunk_ids(self, chunk: str) -> list[int]:
        """Ids of blanks with the word behind them, if any."""
        word = chunk.lstrip(BLANK)
        blanks = len(chunk) - len(word)
        if not word:
            return self.model.run(blanks)
        ids = self.prefix_ids(BLANK + word if blanks else word)
        if blanks < 2:
            return ids
        if ids[0] == self.model.id_of[BLANK]:  # the word takes none of the blanks
            return self.model.run(blanks) + ids[1:]
        return self.model.run(blanks - 1) + ids

    def known_ids(self, chunk: str) -> bytes:
        """``chunk_ids``, remembered. A last character that no piece joins to the one before is taken by itself."""
        ids = self.words.get(chunk)
        if ids is None:
            ids = self.older.get(chunk)
            if ids is None:
                if len(chunk) > 1 and chunk[-2] != BLANK and chunk[-2:] not in self.model.joint:
                    ids = self.known_ids(chunk[:-1]) + self.known_ids(chunk[-1]) if len(chunk) <= LONGEST else None
                if ids is None:
                    ids = array("i", self.chunk_ids(chunk)).tobytes()
            if len(chunk) <= LONGEST:
                self.words[chunk] = ids
        return ids

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; NULL is empty."""
        if not text:
            return np.zeros(0, dtype=np.int32)
        if len(self.words) > REMEMBERED:
            self.words, self.older = {}, self.words
        if len(self.pairs) > 2 * REMEMBERED:
            self.pairs = {}
        chunks = self.model.cuts.findall(BLANK + text.replace(" ", BLANK))
        out: list = list(map(self.words.get, chunks))
        at = 0
        for _ in range(out.count(None)):
            at = out.index(None, at)
            out[at] = self.known_ids(chunks[at])
        return np.frombuffer(b"".join(out), dtype=np.int32)


_MODELS: dict[str, PieceModel] = {}
_ENCODERS: dict[str, PieceEncoder] = {}


def model(path: str) -> PieceModel:
    """One per worker process and file, kept for its later tasks."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(model(path))
    return _ENCODERS[path]


def _listed(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))


def encoded(docs: DataFrame, text: str = "text", name: str = "ids", path: str | None = None) -> DataFrame:
    """``docs`` with ``name`` (array of int), the ids of ``text``, in place of it.

    NULL and empty texts have no ids; every row stays, repeated ones too.
    """
    path = path or vocabulary_path(MODEL)
    others = [c for c in docs.columns if c != text]
    rows = docs.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{text}`").cast("string").alias("text" if text == "text" else free_name(docs, "text")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path)
        for batch in batches:
            named = pa.RecordBatch.from_arrays(batch.columns, names=[*map(str, range(len(others))), "text"])
            for part in text_batches([named], BATCH):
                ids = [known.encode(t) for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], _listed(ids)], names=[*others, name])

    schema = T.StructType([docs.schema[c] for c in others] + [T.StructField(name, T.ArrayType(T.IntegerType(), False))])
    return rows.mapInArrow(work, schema)


def decoded(rows: DataFrame, ids: str = "ids", name: str = "decoded", path: str | None = None) -> DataFrame:
    """``rows`` with ``name``, the text of ``ids``, in place of them; no ids are an empty text."""
    path = path or vocabulary_path(MODEL)
    others = [c for c in rows.columns if c != ids]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model(path)
        for batch in batches:
            lists = batch.column(len(others))
            counts = np.diff(lists.offsets.to_numpy())
            block = np.cumsum(counts, dtype=np.int64) * 4 // BATCH
            cuts = [0, *(np.nonzero(np.diff(block))[0] + 1).tolist(), len(lists)]
            for first, last in zip(cuts, cuts[1:]):
                part = lists.slice(first, last - first)
                flat, ends = part.flatten().to_numpy(), np.cumsum(counts[first:last])
                texts = [known.decode(flat[e - n : e]) for e, n in zip(ends, counts[first:last])]
                kept = [c.slice(first, last - first) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], names=[*others, name])

    schema = T.StructType([rows.schema[c] for c in others] + [T.StructField(name, T.StringType())])
    return rows.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{ids}`")).mapInArrow(work, schema)


def piece_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document, from its ids and its decoded text.

    NULL and empty texts have no ids and decode to an empty text. Rows with one doc_id are
    documents of their own.
    """
    rows = encoded(docs.select("doc_id", "text"), path=path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        "ids",
    )
    return decoded(rows, path=path).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
