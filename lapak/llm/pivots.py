"""Near-duplicate vectors by a pivot-permutation index.

Equal vectors are one class. A class is described by its nearest reference points (pivots), in
order of nearness; inverted lists hold, per pivot, the classes that name it. Two classes are
candidates if they share at least SHARED pivots, which is counted inside the lists, and candidates
are verified by cosine in double precision.

A pair is handled in one list only, that of its smallest shared pivot. A long list is divided by
the second smallest pivot a pair may share, and what is still long by tiles of bounded size, tile
against tile: all of it exact, so no list is too long and no candidate is lost. Links leave a list
as counts per class and as the links that join separate parts, never as all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components, spanning_links

#: Pivots: this many times the root of the number of classes, between the bounds. They are drawn
#: from the vectors by hash and broadcast, so the upper bound also bounds what is broadcast.
PIVOTS, LEAST, MOST = 4, 64, 4096
#: Length of a description, and pivots that candidates share.
NEAREST, SHARED = 12, 2
#: Classes of a list that are compared at once; longer lists are divided.
LIST = 2048
COSINE = 0.9


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision. Divided by their largest component first, no square
    is too large or too small for a double."""
    rows = np.asarray(vectors, dtype=np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def pivot_sample(classes: DataFrame, seed: int = 3) -> dict[int, np.ndarray]:
    """Unit pivots per number of components."""
    n = classes.count()
    wanted = min(MOST, max(LEAST, PIVOTS * math.isqrt(n)))
    rows = classes.select("vec").orderBy(F.xxhash64(F.lit(seed), "vec")).limit(wanted).collect()
    out: dict[int, list] = {}
    for r in rows:
        out.setdefault(len(r.vec), []).append(r.vec)
    return {d: unit(vs) for d, vs in out.items()}


def describe(vectors: np.ndarray, pivots: np.ndarray, nearest: int = NEAREST) -> np.ndarray:
    """Numbers of each vector's nearest pivots, nearest first."""
    k = min(nearest, len(pivots))
    near = vectors @ pivots.T
    top = np.argpartition(-near, k - 1, axis=1)[:, :k]
    order = np.argsort(-np.take_along_axis(near, top, axis=1), axis=1, kind="stable")
    return np.take_along_axis(top, order, axis=1).astype(np.int32)


def described(classes: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """``classes`` with ``pivots``: the description, nearest first.

    Where a number of components has fewer than SHARED pivots in the sample, all such vectors share
    two made-up ones, so they are compared with each other.
    """
    shared = classes.sparkSession.sparkContext.broadcast(pivots)

    @F.pandas_udf("array<int>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = shared.value
        for batch in batches:
            out: list = [None] * len(batch)
            sizes = np.array([len(v) for v in batch])
            for d in set(sizes.tolist()):
                at = np.nonzero(sizes == d)[0]
                if len(known.get(d, ())) < SHARED:
                    rows = [[-2 * d - 1, -2 * d - 2]] * len(at)
                else:
                    rows = describe(unit(np.stack([batch.iloc[i] for i in at])), known[d]).tolist()
                for i, row in zip(at.tolist(), rows):
                    out[i] = row
            yield pd.Series(out)

    return classes.withColumn("pivots", of("vec"))


def _lists(rows: DataFrame, longest: int) -> DataFrame:
    """Postings ``p, q, x, y`` (pivot, second pivot or NULL, tile pair) with the class's columns.

    A class has none under its largest pivot, which is never the smallest of two shared ones.
    """
    columns = [F.col(c) for c in rows.columns]
    first = rows.select(*columns, F.explode(F.array_remove("pivots", F.array_max("pivots"))).alias("p"))
    # One row per pivot: bounded by the number of pivots.
    sizes = written(first.groupBy("p").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "lists")
    sized = first.join(sizes, "p")
    short = sized.where(F.col("size") <= longest).select(*columns, "p", F.lit(None).cast("int").alias("q"), F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(0).alias("tile"))
    later = F.filter("pivots", lambda v: v > F.col("p"))
    second = sized.where(F.col("size") > longest).select(*columns, "p", F.explode(later).alias("q"))
    sizes2 = written(
        second.groupBy("p", "q").agg(F.count(F.lit(1)).alias("size")).where("size > 1").withColumnsRenamed({"p": "p_", "q": "q_"}), "lists"
    )
    sized2 = second.join(sizes2, (F.col("p") == F.col("p_")) & (F.col("q") == F.col("q_")))
    tiles = F.ceil(F.col("size") / longest).cast("int")
    tiled = sized2.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("uid", "q"), F.col("tiles")).cast("int"))
    paired = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    long_ = paired.select(*columns, "p", "q", F.least("tile", "other").alias("x"), F.greatest("tile", "other").alias("y"), "tile")
    return short.unionByName(long_)


def compare_list(vectors: np.ndarray, pivots: list[np.ndarray], weight: np.ndarray, p: int, q: int | None, second: np.ndarray | None, least: float):
    """Links within a list, or between its two parts where ``second`` marks the second part.

    Returns how many vectors each class is linked with, and the positions of spanning links.
    """
    n = len(vectors)
    names, flat = np.unique(np.concatenate(pivots), return_inverse=True)
    lengths = np.array([len(v) for v in pivots])
    words = -(-len(names) // 64)
    held = np.zeros((n, words * 64), dtype=bool)
    held[np.repeat(np.arange(n), lengths), flat] = True
    bits = np.packbits(held, axis=1, bitorder="little").view("<u8")
    # Pivots that a pair of another list would share: all below the list's, but the first itself.
    lower = np.zeros(words * 64, dtype=bool)
    lower[: len(names)] = names < p if q is None else (names < q) & (names != p)
    before = np.packbits(lower, bitorder="little").view("<u8")
    directions = unit(vectors)
    links = np.zeros(n, dtype=np.int64)
    joined: list = []
    label = list(range(n))
    step = max(1, 1_000_000 // n)
    for at in range(0, n, step):
        rows = bits[at : at + step]
        shared = np.zeros((len(rows), n), dtype=np.uint8)
        for w in range(words):
            shared += np.bitwise_count(rows[:, w, None] & bits[None, :, w])
        candidate = shared >= SHARED
        if second is None:
            candidate &= np.arange(at, at + len(rows))[:, None] < np.arange(n)[None, :]
        else:
            candidate &= ~second[at : at + len(rows), None] & second[None, :]
        i, j = np.nonzero(candidate)
        i += at
        mine = ~((bits[i] & bits[j]) & before).any(axis=1)
        i, j = i[mine], j[mine]
        near = np.empty(len(i), dtype=bool)
        for k in range(0, len(i), 100_000):
            part = slice(k, k + 100_000)
            near[part] = np.einsum("ij,ij->i", directions[i[part]], directions[j[part]]) >= least
        i, j = i[near], j[near]
        links += np.bincount(i, weights=weight[j], minlength=n).astype(np.int64) + np.bincount(j, weights=weight[i], minlength=n).astype(np.int64)
        joined += spanning_links(i, j, label)
    return links, joined


_FOUND = pa.schema([("uid", pa.int64()), ("links", pa.int64()), ("to", pa.int64())])


def index_links(rows: DataFrame, least: float = COSINE, longest: int = LIST) -> DataFrame:
    """``uid, links, to``: per class and list its links, and separately links that join parts.

    ``rows`` has uid, n (vectors of the class), vec and pivots.
    """

    def compare(group: pa.Table) -> pa.Table:
        first = {c: group[c][0].as_py() for c in ("p", "q", "x", "y")}
        uid, weight = group["uid"].to_numpy(), group["n"].to_numpy()
        second = (group["tile"].to_numpy() == first["y"]) if first["x"] != first["y"] else None
        pivots = [np.array(v) for v in group["pivots"].to_pylist()]
        flat = group["vec"].combine_chunks()
        ends = np.cumsum([len(v) for v in flat])
        parts = np.split(flat.flatten().to_numpy(), ends[:-1])
        out: list = [[], [], []]
        for d in {len(v) for v in parts}:  # vectors of different length are not compared
            at = np.array([k for k, v in enumerate(parts) if len(v) == d])
            links, joined = compare_list(
                np.stack([parts[k] for k in at]), [pivots[k] for k in at], weight[at], first["p"], first["q"], None if second is None else second[at], least
            )
            linked = np.nonzero(links)[0]
            out[0] += uid[at][linked].tolist() + [int(uid[at][a]) for a, _ in joined]
            out[1] += links[linked].tolist() + [0] * len(joined)
            out[2] += [None] * len(linked) + [int(uid[at][b]) for _, b in joined]
        return pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip(out, _FOUND)], schema=_FOUND)

    lists = _lists(rows, longest)
    return written(lists.groupBy("p", "q", "x", "y").applyInArrow(compare, "uid bigint, links bigint, to bigint"), "found")


def near_vectors(table: DataFrame, least: float = COSINE, longest: int = LIST) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``table`` (vec_id, embedding).

    Vectors that are NULL, empty or zero, or hold NULL or non-finite components, have no link and
    are their own component; so is every vector without link. A component's id is its smallest
    vec_id that is not NULL. Repeated rows are linked with one another.
    """
    # Single precision stays as it is stored, half as large when it is moved; sums are of doubles.
    kind = "float" if table.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    rows = written(
        table.select(
            F.monotonically_increasing_id().alias("uid"),
            F.col("vec_id"),
            F.col("embedding").cast(f"array<{kind}>").alias("vec"),
        ).withColumn("usable", usable(F.col("vec"))),
        "vectors",
    )
    classes = written(
        rows.where("usable").groupBy("vec").agg(F.min("uid").alias("uid"), F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n")), "classes"
    )
    index = written(described(classes.select("uid", "n", "vec"), pivot_sample(classes)), "index")
    found = index_links(index, least, longest)
    direct = written(found.where("to is null").groupBy("uid").agg(F.sum("links").alias("links")), "direct")
    roots = components(found.where("to is not null").select(F.col("uid").alias("a"), F.col("to").alias("b")))
    rooted = written(
        classes.join(direct.withColumnRenamed("uid", "u"), F.col("uid") == F.col("u"), "left")
        .join(roots, F.col("uid") == F.col("node"), "left")
        .select("vec", "first", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("root", "uid").alias("root")),
        "rooted",
    )
    smallest = written(rooted.groupBy(F.col("root").alias("r")).agg(F.min("first").alias("component_id")), "smallest")
    known = written(rooted.join(smallest, F.col("root") == F.col("r")).select(F.col("vec").alias("v"), "links", "component_id"), "known")
    own = F.when(F.col("links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return rows.join(known, F.col("usable") & (F.col("vec") == F.col("v")), "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.col("vec_id").eqNullSafe(own).alias("kept")
    )


def usable(vec):
    """Whether a vector has a direction: all components are finite, and one at least is not 0."""
    sound = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x))
    largest = F.array_max(F.transform(vec, F.abs))
    return F.coalesce(sound & (largest > 0) & (largest < float("inf")), F.lit(False))


SQL = f"""
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_max(list_transform(embedding, lambda x: abs(x))) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}
), reached AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
), smallest AS (SELECT a, min(b) AS b FROM reached GROUP BY a
), degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id, vec_id <= coalesce(b, vec_id) AS kept
FROM embeddings e LEFT JOIN smallest s ON s.a = e.vec_id LEFT JOIN degrees d ON d.a = e.vec_id
"""
