"""Collocations by set-oriented mining of occurrence relations (SETM).

R1 holds every occurrence of a frequent word as (place, word), sorted by place; a place is the
number of a word in its text, and the end of a piece takes a number as well, so what stands in two
pieces is never adjacent. R(k-1), the occurrences of frequent phrases by the place where they
start, is merge-joined with R1 on the place k - 1 further on; the phrases so found are counted, and
the occurrences of those that are frequent enough are R(k). Each relation is written, sorted, in
blocks of a bounded part of a text, and a block also holds the few words of R1 that follow it, so a
join never leaves its block and no text is too long for a task.

Counts are summed per batch of blocks, then per task, then over all tasks. The semi-join with
frequent phrases looks them up in memory while their number is below LOOKUP, which is checked, and
is a shuffled join beyond that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import number_rows, written
from .tokens import text_batches

#: Characters that end a piece, each run of which becomes one word of its own, and that word.
ENDS, END = r"[.,;:!?\x0A-\x0D]+", "."
#: Words of a phrase at most, and occurrences of a candidate at least.
LONGEST, LEAST = 4, 30
#: A candidate goes where a longer one around it has this share, in percent, of its occurrences.
COVERED = 80
SCALE, TOP = 2_000_000, 2000
#: Words of a text in one block, and occurrences that are joined at once.
BLOCK, JOINED = 10_000, 500_000
#: Frequent words or phrases that are looked up in memory, and bytes of such words.
LOOKUP, LOOKUP_BYTES = 1_000_000, 32_000_000
#: Bytes of text that are split at once.
BATCH = 8_000_000

_BLOCKS = "block bigint, until int, places array<int>, words array<bigint>, at array<int>, found array<bigint>"
_LISTS = pa.schema(
    [("block", pa.int64()), ("until", pa.int32()), ("places", pa.list_(pa.int32())), ("words", pa.list_(pa.int64())),
     ("at", pa.list_(pa.int32())), ("found", pa.list_(pa.int64()))]
)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of texts in a row with END where pieces end, and how many each text has."""
    spaced = pc.replace_substring_regex(pc.ascii_lower(pc.fill_null(texts, "")), ENDS, f" {END} ")
    lists = pc.ascii_split_whitespace(spaced)
    flat = lists.flatten()
    owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    return flat.filter(pa.array(real)), np.bincount(owner[real], minlength=len(lists))


def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array]]:
    """Texts of one language each, in order."""
    for part in text_batches(batches, BATCH):
        pa.default_memory_pool().release_unused()
        for lang in part["lang"].unique().to_pylist():
            yield lang, part["text"].filter(pc.equal(part["lang"], lang))


def word_counts(texts: DataFrame) -> DataFrame:
    """lang, word, f of all words; ``f`` of a NULL word is the number of all words of the language."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("f", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, own in by_language(batches):
            found = split_words(own)[0].value_counts()
            words, f = found.field("values"), found.field("counts")
            usual = pc.not_equal(words, END)
            words, f = words.filter(usual), f.filter(usual)
            total = pa.array([pc.sum(f).as_py() or 0], pa.int64())
            words = pa.concat_arrays([words, pa.array([None], pa.string())])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words)), words, pa.concat_arrays([f, total])], schema=schema)

    counted = texts.mapInArrow(count, "lang string, word string, f bigint")
    return counted.groupBy("lang", "word").agg(F.sum("f").alias("f"))


def _lists(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(flat, kind))


def _blocks_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where blocks of texts with ``counts`` words start and end in the row of all words, and the text's start."""
    first = np.cumsum(counts) - counts
    n = np.maximum(-(-counts // BLOCK), 1)
    text = np.repeat(np.arange(len(counts)), n)
    number = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    start = first[text] + number * BLOCK
    return start, np.minimum(start + BLOCK, (first + counts)[text]), first[text]


def _relation(ids: np.ndarray, counts: np.ndarray, next_block: int) -> pa.RecordBatch:
    """R1 of texts whose words have ``ids``, -1 for what is not frequent or ends a piece.

    ``at`` and ``found`` are NULL: a word's own occurrences are those in front of ``until``.
    """
    start, end, first = _blocks_of(counts)
    total = np.repeat(np.cumsum(counts), np.maximum(-(-counts // BLOCK), 1))
    beyond = np.minimum(end + LONGEST - 1, total)  # the words that follow a block
    width = beyond - start
    where = np.arange(width.sum()) + np.repeat(start - (np.cumsum(width) - width), width)
    owner = np.repeat(np.arange(len(start)), width)
    kept = ids[where] >= 0
    where, owner = where[kept], owner[kept]
    places, words, until = where - first[owner], ids[where], end - first
    per, none = np.bincount(owner, minlength=len(start)), pa.nulls(len(start))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(next_block, next_block + len(start))), pa.array(until, pa.int32()), _lists(places, per, pa.int32()),
         _lists(words, per, pa.int64()), none.cast(pa.list_(pa.int32())), none.cast(pa.list_(pa.int64()))], schema=_LISTS
    )


def _task_base() -> int:
    context = TaskContext.get()
    return (context.partitionId() if context else 0) << 33


def first_relation(texts: DataFrame, words: DataFrame) -> DataFrame:
    """R1 in blocks: block, until (the first place behind it), places and words, with what follows
    the block. ``words`` has lang, word, id."""
    n, size = words.agg(F.count(F.lit(1)), F.sum(F.octet_length("word"))).first()
    if n <= LOOKUP and (size or 0) <= LOOKUP_BYTES:
        known: dict = {}
        for r in words.select("lang", "word", "id").collect():  # LOOKUP rows at most
            known.setdefault(r.lang, ([], []))[0].append(r.word)
            known[r.lang][1].append(r.id)
        known = {lang: (pa.array(w, pa.string()), np.array(i, dtype=np.int64)) for lang, (w, i) in known.items()}
        shared = texts.sparkSession.sparkContext.broadcast(known)

        def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = _task_base()
            for lang, own in by_language(batches):
                flat, counts = split_words(own)
                value_set, ids = shared.value.get(lang, (pa.array([], pa.string()), np.zeros(0, dtype=np.int64)))
                coded = flat.dictionary_encode()
                at = pc.fill_null(pc.index_in(coded.dictionary, value_set), -1).to_numpy(zero_copy_only=False)
                known_ids = np.append(ids, -1)[at]
                out = _relation(known_ids[coded.indices.to_numpy()], counts, block)
                block += out.num_rows
                yield out

        return written(texts.mapInArrow(look_up, _BLOCKS), "occurrences")

    spelled = pa.schema([("block", pa.int64()), ("until", pa.int32()), ("lang", pa.string()), ("place", pa.int32()), ("word", pa.string())])

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _task_base()
        for lang, own in by_language(batches):
            flat, counts = split_words(own)
            every = _relation(np.arange(len(flat)), counts, block)
            per = pc.list_value_length(every["places"]).to_numpy()
            word = flat.take(every["words"].flatten())
            block += every.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(every["block"].to_numpy(), per)), pa.array(np.repeat(every["until"].to_numpy(), per)),
                 pa.array([lang] * len(word)), every["places"].flatten(), word], schema=spelled
            )

    rows = texts.mapInArrow(spell, "block bigint, until int, lang string, place int, word string")
    met = rows.join(words.select("lang", "word", "id"), ["lang", "word"])
    lists = met.groupBy("block", "until").agg(F.sort_array(F.collect_list(F.struct("place", F.col("id").alias("word")))).alias("all"))
    none = [F.lit(None).cast(f"array<{kind}>").alias(n) for n, kind in (("at", "int"), ("found", "bigint"))]
    return written(lists.select("block", "until", F.col("all.place").alias("places"), F.col("all.word").alias("words"), *none), "occurrences")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut to about JOINED occurrences; memory of earlier ones is given back."""
    for batch in batches:
        pa.default_memory_pool().release_unused()
        part = np.cumsum(pc.list_value_length(batch["places"]).to_numpy(), dtype=np.int64) // JOINED
        cuts = [0, *(np.nonzero(np.diff(part))[0] + 1).tolist(), batch.num_rows]
        for first, last in zip(cuts, cuts[1:]):
            if last > first:
                yield batch.slice(first, last - first)


class Joined:
    """Merge-join of R(k-1) and R1 in the blocks of a batch: occurrences that go on with a frequent word.

    Places are moved apart block by block, so one pass serves all blocks.
    """

    def __init__(self, batch: pa.RecordBatch, k: int):
        self.wide = pc.list_value_length(batch["places"]).to_numpy()
        self.places, self.words = batch["places"].flatten().to_numpy(), batch["words"].flatten().to_numpy()
        base = np.arange(batch.num_rows, dtype=np.int64) << 32
        owner = np.repeat(np.arange(batch.num_rows), self.wide)
        if k == 2:  # words are their own occurrences, where they start in the block
            own = self.places < batch["until"].to_numpy()[owner]
            starts, found, block = self.places[own], self.words[own], owner[own]
        else:
            starts, found = batch["at"].flatten().to_numpy(), batch["found"].flatten().to_numpy()
            block = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch["at"]).to_numpy())
        wanted, there = starts + (k - 1) + base[block], self.places + base[owner]
        if len(there):
            to = np.minimum(np.searchsorted(there, wanted), len(there) - 1)
            met = there[to] == wanted
        else:
            to, met = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
        #: Per occurrence: where it starts, the phrase so far, the word that follows (its number in R1 and id), its block.
        self.at, self.found, self.to, self.block = starts[met], found[met], to[met], block[met]
        self.next = self.words[self.to]


def _pairs(found: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs and how many there are of each."""
    numbers, a = np.unique(found, return_inverse=True)
    names, b = np.unique(words, return_inverse=True)
    keys, n = np.unique(a * max(len(names), 1) + b, return_counts=True)
    return numbers[keys // max(len(names), 1)], names[keys % max(len(names), 1)], n


def phrase_counts(blocks: DataFrame, k: int) -> DataFrame:
    """prefix, last, f: phrases of ``k`` words by their first k - 1 (id) and their last word (id)."""
    schema = pa.schema([("prefix", pa.int64()), ("last", pa.int64()), ("f", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            joined = Joined(part, k)
            if len(joined.at):
                columns = _pairs(joined.found, joined.next)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    return blocks.mapInArrow(count, "prefix bigint, last bigint, f bigint").groupBy("prefix", "last").agg(F.sum("f").alias("f"))


class Lookup:
    """Ids of (prefix, last) pairs."""

    def __init__(self, prefix: np.ndarray, last: np.ndarray, ids: np.ndarray):
        self.prefix, a = np.unique(prefix, return_inverse=True)
        self.last, b = np.unique(last, return_inverse=True)
        keys = a * max(len(self.last), 1) + b
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], ids[order]

    def __call__(self, prefix: np.ndarray, last: np.ndarray) -> np.ndarray:
        """-1 for pairs that are not there."""
        if not len(self.keys):
            return np.full(len(prefix), -1, dtype=np.int64)
        a = np.minimum(np.searchsorted(self.prefix, prefix), len(self.prefix) - 1)
        b = np.minimum(np.searchsorted(self.last, last), len(self.last) - 1)
        key = a * len(self.last) + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        there = (self.prefix[a] == prefix) & (self.last[b] == last) & (self.keys[at] == key)
        return np.where(there, self.ids[at], -1)


def next_relation(blocks: DataFrame, phrases: DataFrame, k: int, longest: int = LONGEST) -> DataFrame:
    """R(k): the occurrences of ``phrases`` (prefix, last, id), which are the frequent ones.

    Of R1 only the words stay that may follow an occurrence in a phrase of ``longest`` words.
    """
    if phrases.count() <= LOOKUP:
        rows = phrases.select("prefix", "last", "id").toPandas()  # LOOKUP rows at most
        shared = blocks.sparkSession.sparkContext.broadcast(Lookup(*[rows[c].to_numpy(dtype=np.int64) for c in ("prefix", "last", "id")]))

        def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in _parts(batches):
                joined, n = Joined(part, k), part.num_rows
                ids = shared.value(joined.found, joined.next)
                kept = ids >= 0
                after = np.zeros(len(joined.words), dtype=bool)
                # What is adjacent to an occurrence, if frequent, stands right behind its last word in R1.
                for step in range(1, longest - k + 1):
                    behind = joined.to[kept] + step
                    after[behind[behind < len(after)]] = True
                many = np.bincount(joined.block[kept], minlength=n)
                wide = np.bincount(np.repeat(np.arange(n), joined.wide)[after], minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [part["block"], part["until"], _lists(joined.places[after], wide, pa.int32()), _lists(joined.words[after], wide, pa.int64()),
                     _lists(joined.at[kept], many, pa.int32()), _lists(ids[kept], many, pa.int64())], schema=_LISTS
                )

        return written(blocks.mapInArrow(look_up, _BLOCKS), "occurrences")

    starts = pa.schema([("of", pa.int64()), ("start", pa.int32()), ("prefix", pa.int64()), ("last", pa.int64())])

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            joined = Joined(part, k)
            columns = [part["block"].to_numpy()[joined.block], joined.at, joined.found, joined.next]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, starts)], schema=starts)

    rows = blocks.mapInArrow(spell, "of bigint, start int, prefix bigint, last bigint")
    met = rows.join(phrases.select("prefix", "last", "id"), ["prefix", "last"])
    lists = met.groupBy("of").agg(F.sort_array(F.collect_list(F.struct("start", "id"))).alias("all"))
    return written(
        blocks.drop("at", "found").join(lists, F.col("block") == F.col("of")).select(
            "block", "until", "places", "words", F.col("all.start").alias("at"), F.col("all.id").alias("found")
        ),
        "occurrences",
    )


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``longest`` words with at least ``least`` occurrences, and lang, n.

    A phrase has lang, k (words), ids (of its words), phrase (text), f, and lefts: the occurrences
    of its first 1, 2, ... k - 1 words.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    counted = written(word_counts(texts).where((F.col("f") >= least) | F.col("word").isNull()), "word_counts")
    totals = counted.where("word is null").select("lang", F.col("f").alias("n"))
    words = written(number_rows(counted.where("word is not null"), [F.col("lang"), F.col("word")], "id"), "frequent")
    known = words.select(
        "id", "lang", F.lit(1).alias("k"), F.array("id").alias("ids"), F.col("word").alias("phrase"), "f", F.array().cast("array<bigint>").alias("lefts")
    )
    all_ = known.drop("id")
    blocks = first_relation(texts, words)
    last_words = words.select(F.col("id").alias("last"), F.col("word").alias("last_word"))
    for k in range(2, longest + 1):
        counts = written(phrase_counts(blocks, k).where(F.col("f") >= least), "phrase_counts")
        phrases = written(number_rows(counts, [F.col("prefix"), F.col("last")], "id"), "frequent")
        before = known.select(F.col("id").alias("prefix"), "lang", "ids", "phrase", F.col("f").alias("f_prefix"), "lefts")
        known = written(
            phrases.join(before, "prefix").join(last_words, "last").select(
                "id", "lang", F.lit(k).alias("k"), F.concat("ids", F.array("last")).alias("ids"), F.concat_ws(" ", "phrase", "last_word").alias("phrase"),
                "f", F.concat("lefts", F.array("f_prefix")).alias("lefts"),
            ),
            "phrases",
        )
        all_ = all_.unionByName(known.drop("id"))
        if k < longest:
            blocks = next_relation(blocks, phrases, k, longest)
    return all_, totals


def score(a: Column, left: Column, right: Column) -> Column:
    """SCALE * a / (left + right), rounded down; exact, as decimals hold products of any two counts."""
    wide = "decimal(20,0)"
    product = F.lit(SCALE).cast("decimal(7,0)") * a.cast(wide)
    total = left.cast(wide) + right.cast(wide)
    return ((product - product % total) / total).cast("bigint")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, longest: int = LONGEST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language.

    NULL texts are empty, a NULL lang is ``und`` (and one language with it), repeated rows count
    each, and a language without candidates, like an empty table, has no row.
    """
    phrases, totals = frequent_phrases(docs, least, longest)
    phrases = written(phrases, "all_phrases")
    candidates = phrases.where("k > 1")
    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    rights = cuts.select("lang", "phrase", "ids", "k", F.col("f").alias("a"), F.element_at("lefts", F.col("cut")).alias("l"), "cut",
                         F.slice("ids", F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"))
    cut = rights.join(phrases.select(F.col("ids").alias("rest"), F.col("f").alias("r")), "rest")
    lowest = cut.groupBy("ids").agg(
        F.min(F.struct(score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "cut", "lang", "phrase", "a", "l", "r")).alias("best")
    )
    scored = lowest.select("ids", "best.*")
    # Every proper part of two words or more, with the most occurrences of a candidate around it.
    parts = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("k") - m + 1), lambda i: F.slice("ids", i, m))))
    around = candidates.where("k > 2").select("f", F.explode(F.array_distinct(parts)).alias("part"))
    around = around.groupBy("part").agg(F.max("f").alias("most"))
    alone = scored.join(around, F.col("ids") == F.col("part"), "left").where(
        F.col("most").isNull() | (F.lit(100).cast("decimal(3,0)") * F.col("most") < F.lit(COVERED).cast("decimal(3,0)") * F.col("a"))
    )
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = alone.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL = rf"""
WITH pieces AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS text FROM documents)
), words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces
), grams AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM words, range(1, {LONGEST + 1}) t(k) WHERE len(ws) >= k)
), counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang
), cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM counts WHERE k > 1 AND f >= {LEAST}
), cuts AS (
  SELECT lang, k, phrase, a, cut, array_to_string(ws[1:cut], ' ') AS lp, array_to_string(ws[cut + 1:k], ' ') AS rp
  FROM cand, range(1, {LONGEST}) t(cut) WHERE cut < k
), scored AS (
  SELECT c.lang, c.k, c.phrase, c.a, cut, x.f AS l, y.f AS r, CAST((CAST({SCALE} AS HUGEINT) * c.a) // (x.f + y.f) AS BIGINT) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.lp JOIN counts y ON y.lang = c.lang AND y.phrase = c.rp
), lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), around AS (
  SELECT lang, part, max(a) AS most FROM (
    SELECT lang, a, array_to_string(ws[i:i + m - 1], ' ') AS part
    FROM cand, range(2, {LONGEST}) t(m), range(1, {LONGEST}) s(i) WHERE m < k AND i + m - 1 <= k)
  GROUP BY lang, part
), alone AS (
  SELECT w.* FROM lowest w LEFT JOIN around o ON o.lang = w.lang AND o.part = w.phrase
  WHERE o.most IS NULL OR 100 * CAST(o.most AS HUGEINT) < {COVERED} * CAST(w.a AS HUGEINT)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM alone JOIN totals USING (lang)
QUALIFY rank <= {TOP}
"""
