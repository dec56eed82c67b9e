"""SimHash near-duplicates: fingerprints compared exactly, tile against tile.

Equal fingerprints are one class. Classes are cut into tiles by the number of set bits; two tiles
are compared only if these numbers can differ by no more than the radius, since two fingerprints
differ in at least as many bits as their counts do. Two tiles are work of a bounded size:
exclusive-or and bit counts on arrays. Inside them smaller blocks are skipped in the same way by
the counts of four quarters. Only links that join separate parts leave a pair of tiles, so a dense
group of near copies sends one link per class and pair of tiles, not all its pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_PY, free_name, written
from .components import components

SHINGLE, RADIUS, SEED = 4, 4, 42
#: Classes of a tile on average.
TILE = 32_768
#: Rows and columns compared at once.
ROWS, COLUMNS = 256, 4096

_WORDS = re.compile(WORD_PY)
_LOWER = {c: c + 32 for c in range(65, 91)}


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text as a signed number; no words: 0."""
    words = _WORDS.findall(text) if text else []
    if not words:
        return 0
    joined = " ".join(words)
    words = (joined.lower() if joined.isascii() else joined.translate(_LOWER)).split(" ")
    if len(words) <= shingle:
        shingles = [" ".join(words)]
    else:
        shingles = list(map(" ".join, zip(*(words[k : len(words) - shingle + 1 + k] for k in range(shingle)))))
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(shingles), 1 << 16):
        part = shingles[at : at + (1 << 16)]
        hashes = np.array([digest(s, SEED) for s in part], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(shingles), bitorder="little")
    return int(bits.view("<i8")[0])


def with_fingerprint(docs: DataFrame, name: str, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint of ``text`` in a column ``name``; NULL counts as empty."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint(t, shingle) for t in batch], dtype="int64")

    return docs.withColumn(name, of(F.col("text").cast("string")))


def _bounds(prints: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and most set bits per quarter in each block of ``step`` fingerprints."""
    quarters = np.bitwise_count(prints.view("<u2").reshape(-1, 4)).astype(np.int16)
    at = np.arange(0, len(prints), step)
    return np.minimum.reduceat(quarters, at), np.maximum.reduceat(quarters, at)


def _arranged(prints: np.ndarray) -> np.ndarray:
    """Sorted by the set bits of each quarter, so that blocks have narrow bounds."""
    quarters = np.bitwise_count(prints.view("<u2").reshape(-1, 4))
    return prints[np.lexsort(quarters.T[::-1])]


def links_between(first: np.ndarray, second: np.ndarray | None, radius: int) -> np.ndarray:
    """Links (pairs of fingerprints) that span every part joined within ``radius`` bits.

    ``second`` None compares ``first`` with itself.
    """
    first = _arranged(first)
    second, same = (first, True) if second is None else (_arranged(second), False)
    if not len(first) or not len(second):
        return np.zeros((0, 2), dtype=np.uint64)
    low_a, high_a = _bounds(first, ROWS)
    low_b, high_b = _bounds(second, COLUMNS)
    # Whole-number part labels; columns stand behind rows unless both are the same.
    shift = 0 if same else len(first)
    label = np.arange(shift + len(second))
    out = []
    for i in range(len(low_a)):
        apart = np.maximum(low_a[i] - high_b, low_b - high_a[i])
        near = np.nonzero(np.maximum(apart, 0).sum(axis=1) <= radius)[0]
        a = i * ROWS
        rows = first[a : a + ROWS]
        for j in near.tolist():
            b = j * COLUMNS
            if same and b + COLUMNS <= a:
                continue  # compared from the other side
            columns = second[b : b + COLUMNS]
            linked = np.bitwise_count(rows[:, None] ^ columns[None, :]) <= radius
            if same and b < a + ROWS:
                linked &= np.arange(a, a + len(rows))[:, None] != np.arange(b, b + len(columns))[None, :]
            # While a link joins two parts, take one per row, join, and look again.
            while linked.any():
                has = np.nonzero(linked.any(axis=1))[0]
                to = linked[has].argmax(axis=1)
                for r, c in zip((a + has).tolist(), (shift + b + to).tolist()):
                    if label[r] != label[c]:
                        out.append((r, c))
                        gone, kept = max(label[r], label[c]), min(label[r], label[c])
                        label[label == gone] = kept
                linked &= label[a : a + len(rows), None] != label[shift + b : shift + b + len(columns)][None, :]
    if not out:
        return np.zeros((0, 2), dtype=np.uint64)
    pairs = np.array(out)
    return np.stack([first[pairs[:, 0]], second[pairs[:, 1] - shift]], axis=1)


def _strata(counts: dict[int, int], tile: int) -> list[tuple[int, int, int]]:
    """(least, most set bits, tiles): neighbouring counts share a tile while they are few."""
    out: list[list[int]] = []
    for bits in sorted(counts):
        if out and out[-1][2] + counts[bits] <= tile:
            out[-1][1:] = [bits, out[-1][2] + counts[bits]]
        else:
            out.append([bits, bits, counts[bits]])
    return [(low, high, -(-n // tile)) for low, high, n in out]


def near_links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``fingerprint``) within ``radius``.

    Not every pair is listed, but all that are linked directly or over others are connected.
    """
    bits = F.bit_count("fingerprint")
    # At most 65 rows: counts of set bits.
    counts = {r.bits: r.n for r in prints.groupBy(bits.alias("bits")).agg(F.count(F.lit(1)).alias("n")).collect()}
    strata = _strata(counts, tile)
    ends = np.cumsum([0, *(s[2] for s in strata)])

    def per_bits(value) -> F.Column:
        """A value of the stratum that a row's number of set bits belongs to."""
        of = {b: int(value(k)) for k, (low, high, _) in enumerate(strata) for b in range(low, high + 1)}
        return F.element_at(F.array(*[F.lit(of.get(b, -1)) for b in range(65)]), bits + 1)

    def near(k: int) -> list[int]:
        low, high, _ = strata[k]
        return [m for m, (lo, hi, _) in enumerate(strata) if max(lo - high, low - hi) <= radius]

    # Tiles within the radius follow one another, so a row's partners are a range of numbers.
    salt = F.pmod(F.xxhash64(F.lit("tile"), "fingerprint"), per_bits(lambda k: strata[k][2]).cast("long"))
    tiled = prints.select(
        "fingerprint",
        (per_bits(lambda k: ends[k]) + salt).alias("tile"),
        per_bits(lambda k: ends[near(k)[0]]).alias("first"),
        per_bits(lambda k: ends[near(k)[-1] + 1] - 1).alias("last"),
    ) if strata else prints.select("fingerprint", *[F.lit(0).cast("long").alias(c) for c in ("tile", "first", "last")])
    # A tile travels as one row, so its copies for its partners are few and large.
    blocks = tiled.groupBy("tile", "first", "last").agg(F.collect_list("fingerprint").alias("prints"))
    paired = blocks.withColumn("partner", F.explode(F.sequence(F.col("first").cast("long"), F.col("last").cast("long")))).select(
        F.least("tile", "partner").alias("x"), F.greatest("tile", "partner").alias("y"), "prints"
    )

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        tiles = [np.asarray(p, dtype="<i8").view("<u8") for p in frame["prints"]]
        found = links_between(tiles[0], tiles[1] if len(tiles) > 1 else None, radius)
        return pd.DataFrame(found.astype("<u8").view("<i8").reshape(-1, 2), columns=["a", "b"])

    # Every pair of tiles costs about the same, so they are spread by number, not by bytes.
    pairs = sum(s[2] * (ends[near(k)[-1] + 1] - ends[near(k)[0]]) for k, s in enumerate(strata)) // 2
    tasks = min(max(1, pairs), 4 * int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = paired.repartition(int(tasks), "x", "y")
    return spread.groupBy("x", "y").applyInPandas(compare, "a bigint, b bigint")


def classes(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``fingerprint, root`` for the distinct fingerprints that are linked with others."""
    return components(near_links(prints, radius)).withColumnsRenamed({"node": "fingerprint"})


def duplicate_documents(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id of every document.

    A text without words has fingerprint 0 and is linked like any other. The component id is the
    smallest doc_id reachable; rows without id take part, and have NULL only if no row of their
    component has one.
    """
    rows = written(with_fingerprint(docs.select(F.col("doc_id"), F.col("text")), "fingerprint").drop("text"), "fingerprints")
    grouped = written(_grouped(rows), "groups").withColumnRenamed("fingerprint", "of")
    return rows.join(grouped, F.col("fingerprint") == F.col("of")).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _grouped(rows: DataFrame) -> DataFrame:
    """``fingerprint, component_id`` (smallest doc_id of the component) of every fingerprint."""
    prints = written(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "prints")
    found = classes(prints.select("fingerprint")).withColumnRenamed("fingerprint", "of")
    joined = prints.join(found, F.col("fingerprint") == F.col("of"), "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    rooted = written(joined, "rooted")
    smallest = written(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
    return rooted.join(smallest, "root").select("fingerprint", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents of which no near copy is kept: one of each component, the smallest doc_id.

    Among rows with that id, or where no row has an id, the first in the written table stays, so
    exactly one row of a component stays in every case.
    """
    mark, uid = free_name(docs, "fingerprint_"), free_name(docs, "uid_")
    marked = written(
        with_fingerprint(docs, mark).withColumn(uid, F.monotonically_increasing_id()), "marked"
    )
    order = F.struct(F.col("doc_id").isNull(), "doc_id", uid).alias("first")
    rows = marked.select(F.col(mark).alias("fingerprint"), order)
    prints = written(rows.groupBy("fingerprint").agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("n")), "prints")
    found = classes(prints.select("fingerprint")).withColumnRenamed("fingerprint", "of")
    rooted = written(
        prints.join(found, F.col("fingerprint") == F.col("of"), "left").where("n > 1 or root is not null").select(
            "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
        ),
        "rooted",
    )
    kept = written(rooted.groupBy("root").agg(F.min("first").getField(uid).alias("stays")), "stays")
    decided = written(rooted.join(kept, "root").select(F.col("fingerprint").alias("of"), "stays"), "decided")
    joined = marked.join(decided, F.col(mark) == F.col("of"), "left")
    return joined.where(F.col("stays").isNull() | (F.col("stays") == F.col(uid))).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
