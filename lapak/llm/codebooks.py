"""Product codes of vectors by Lloyd's algorithm with members that stay where they are.

A vector is cut into parts, and each part position has a codebook. The parts are the members of
codebook entries: they lie partitioned by (position, entry, salt), the salt so that an entry which
holds a third of all parts is many owners' work. In a round every owner sums the members that lie
with it, which gives the new entries; then each member looks for its nearest entry where it lies,
and only those that change to another entry move in the next shuffle, to that entry's owners.
The others are rewritten in place.

All arithmetic is in whole numbers, so results do not depend on the order of sums.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_folder
from .common import written

#: A component x counts as floor(SCALE * x).
SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Pairs of part and entry whose distances are held at once.
PAIRS = 2_000_000
_SPLIT = 1 << 16

_ASSIGNED = "uid bigint, position int, salt int, entry int, error bigint, moved boolean, x array<bigint>"


def sound(vector: Column) -> Column:
    """Whether a vector is there and all of its components are finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(vector.isNotNull() & F.forall(vector, finite), F.lit(False))


def largest(width: int) -> int:
    """Components beyond this, either side of 0, count as this, so that squared distances fit 64 bits."""
    return math.isqrt((1 << 62) // width) // 2


def whole_vectors(table: DataFrame, parts: int = PARTS) -> tuple[DataFrame, int]:
    """uid, vec_id, label and x (whole components) of the vectors that are kept, and their length.

    Kept are vectors with finite components only, of the commonest length that can be cut into
    parts (the shorter one of two equally common).
    """
    vector = F.col("embedding").cast("array<double>")
    rows = table.select(F.monotonically_increasing_id().alias("uid"), "vec_id", "label", vector.alias("v")).where(sound(F.col("v")))
    fits = (F.size("v") > 0) & (F.size("v") % parts == 0)
    # As many rows as there are lengths.
    common = rows.where(fits).groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), "width").first()
    width = common.width if common else parts
    limit = float(largest(width))
    x = F.transform("v", lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(limit)), F.lit(-limit))).cast("bigint"))
    return written(rows.where(F.size("v") == width).select("uid", "vec_id", "label", x.alias("x")), "vectors"), width


def first_codebooks(vectors: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """The parts of the smallest vec_ids (NULL last, equal ones by their components), by position, entry and place."""
    rows = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    return np.array([r.x for r in rows], dtype=np.int64).reshape(len(rows), parts, width // parts).transpose(1, 0, 2)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each row's nearest entry, the lower number of two."""
    top = 2 * max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)), 1)
    # As doubles the same numbers come out as long as all of them are below 2 ** 53.
    kind = np.float64 if x.shape[1] * top * top < 1 << 52 else np.int64
    x, book = x.astype(kind), book.astype(kind)
    own = (book * book).sum(axis=1)
    entry, least = np.empty(len(x), dtype=np.int32), np.empty(len(x), dtype=np.int64)
    step = max(1, PAIRS // max(len(book), 1))
    for at in range(0, len(x), step):
        rows = x[at : at + step]
        away = own[None, :] - 2 * (rows @ book.T)
        best = np.argmin(away, axis=1)
        entry[at : at + step] = best
        least[at : at + step] = away[np.arange(len(rows)), best] + (rows * rows).sum(axis=1)
    return entry, least


def assigned(members: DataFrame, books: np.ndarray) -> DataFrame:
    """Members with their nearest entry, its squared distance, and whether it is another than before."""
    shared = members.sparkSession.sparkContext.broadcast(books)  # parts * entries * places, all parameters
    each = books.shape[2]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            position, before = batch["position"].to_numpy(), batch["entry"].to_numpy()
            x = batch["x"].flatten().to_numpy().reshape(-1, each)
            entry, error = np.empty(len(x), dtype=np.int32), np.empty(len(x), dtype=np.int64)
            for p in np.unique(position):
                own = position == p
                entry[own], error[own] = nearest(x[own], shared.value[p])
            yield pa.RecordBatch.from_arrays(
                [batch["uid"], batch["position"], batch["salt"], pa.array(entry), pa.array(error), pa.array(entry != before), batch["x"]],
                names=["uid", "position", "salt", "entry", "error", "moved", "x"],
            )

    return members.select("uid", "position", "salt", "entry", "x").mapInArrow(work, _ASSIGNED)


def settle(members: DataFrame, books: np.ndarray) -> DataFrame:
    """Members with their nearest entries: those that keep it as they lie, the others at its owners."""
    found = assigned(members, books)
    path = scratch_folder(members.sparkSession, "members")
    found.write.partitionBy("moved").option("compression", "zstd").parquet(path)
    found = members.sparkSession.read.schema(found.schema).parquet(path)
    arrived = written(found.where("moved").drop("moved").repartition("position", "entry", "salt"), "arrived")
    return found.where("not moved").drop("moved").unionByName(arrived)


def updated(members: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks with every entry that has members at their mean, rounded down."""
    each = books.shape[2]
    # High and low halves are summed apart: no sum passes 64 bits.
    x = [F.col("x")[i] for i in range(each)]
    high = F.array(*[F.sum(F.shiftright(c, 16)) for c in x])
    low = F.array(*[F.sum(c.bitwiseAND(F.lit(_SPLIT - 1))) for c in x])
    sums = members.groupBy("position", "entry").agg(F.count(F.lit(1)).alias("n"), high.alias("high"), low.alias("low"))
    books = books.copy()
    for r in sums.collect():  # one row per position and entry
        books[r.position, r.entry] = [(h * _SPLIT + w) // r.n for h, w in zip(r.high, r.low)]
    return books


def product_codes(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """The kept vectors (uid, vec_id, label, x), their codes (uid, entries, error), and the codebooks.

    ``entries`` is the array of entry numbers by position; ``error`` the squared distance.
    """
    vectors, width = whole_vectors(table, parts)
    books = first_codebooks(vectors, width, parts, entries)
    spread = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = width // parts
    pieces = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.slice("x", p * each + 1, F.lit(each)))
    salt = F.pmod(F.xxhash64("uid"), F.lit(spread)).cast("int").alias("salt")
    members = vectors.select("uid", salt, F.posexplode(pieces).alias("position", "x")).withColumn("entry", F.lit(-1))
    for _ in range(rounds):
        members = settle(members, books)
        books = updated(members, books)
    found = assigned(members, books).groupBy("uid").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("position", "entry"))), lambda s: s["entry"]).alias("entries"),
        F.sum("error").alias("error"),
    )
    return vectors, written(found, "codes"), books


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress_vectors(table: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every vector that is kept.

    Vectors that are NULL or hold a NULL or non-finite component are dropped, and so are those of
    another length than the commonest that can be cut into parts. Scaled components are held within
    ``largest(width)`` (131,072 before scaling, for 64 components). Equal rows get equal codes, and rows with
    one vec_id are vectors of their own. With fewer vectors than entries, there are as many entries
    as vectors. A label's error beyond 64 bits is the largest number. An empty table gives no row.
    """
    vectors, codes, books = product_codes(table)
    code = F.concat(*[F.lpad(F.lower(F.hex(F.col("entries")[p])), 2, "0") for p in range(PARTS)])
    rows = written(vectors.select("uid", "vec_id", "label").join(codes, "uid").select("vec_id", "label", code.alias("code"), "error"), "coded")
    total = F.least(F.sum(F.col("error").cast("decimal(19,0)")), F.lit((1 << 63) - 1).cast("decimal(38,0)")).cast("bigint")
    labels = rows.groupBy(F.col("label").alias("of")).agg(total.alias("label_error"))
    return rows.join(labels, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )


def _sql() -> str:
    def assign(k: int) -> str:
        # Distance and entry in one number: the smallest is the nearest entry, the lower one of two.
        return f"""a{k} AS MATERIALIZED (
  SELECT uid, p, CAST(min(d * {ENTRIES} + e) % {ENTRIES} AS BIGINT) AS e, CAST(min(d * {ENTRIES} + e) // {ENTRIES} AS BIGINT) AS d
  FROM (SELECT m.uid, m.p, b.e, CAST(sum((m.x - b.c) * (m.x - b.c)) AS BIGINT) AS d FROM comp m JOIN b{k} b ON b.p = m.p AND b.i = m.i GROUP BY ALL)
  GROUP BY uid, p)"""

    def update(k: int) -> str:
        return f"""b{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, b.i, coalesce((s - (((s % n) + n) % n)) // n, b.c) AS c
  FROM b{k} b LEFT JOIN (
    SELECT a.p, a.e, m.i, CAST(sum(m.x) AS BIGINT) AS s, count(*) AS n FROM a{k} a JOIN comp m ON m.uid = a.uid AND m.p = a.p GROUP BY ALL
  ) u ON u.p = b.p AND u.e = b.e AND u.i = b.i)"""

    steps = ",\n".join(f"{assign(k)},\n{update(k)}" for k in range(ROUNDS))
    return f"""
WITH src AS MATERIALIZED (
  SELECT row_number() OVER () AS uid, vec_id, label, embedding AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), comp AS MATERIALIZED (
  SELECT uid, vec_id, (j - 1) // w AS p, (j - 1) % w AS i, CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT uid, vec_id, len(v) // {PARTS} AS w, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM src)
), firsts AS (SELECT uid, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM src QUALIFY e < {ENTRIES}
), b0 AS MATERIALIZED (SELECT p, e, i, x AS c FROM comp JOIN firsts USING (uid)
), {steps},
{assign(ROUNDS)}
, codes AS (SELECT uid, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY uid
), digest AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM src JOIN codes USING (uid), digest
"""


SQL = _sql()
