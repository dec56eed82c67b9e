"""Quality rules: robust multivariate outliers per language and source.

Counts of every whole text become a vector of transformed statistics. For each language and source
the minimum-covariance-determinant estimate (the centre and scatter of the three quarters of the
rows that lie closest together) is found by concentration steps over all rows, and rows too far
from it by Mahalanobis distance are rejected. One step is one aggregate: rows are summed per pool
and distance bucket, and the closest buckets that hold three quarters of the rows make the next
estimate, so neither a large pool nor its quantile passes through one task.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_PY, free_name, written

_WORDS = re.compile(WORD_PY)
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: Statistics and the least standard deviation each can have. The estimate counts wherever it is
#: larger; a floor stands in where three quarters of a source's documents have one and the same value
#: (mostly no symbols, no repeated lines, no repeated words), whose estimate is zero.
FLOORS = {"length": 0.25, "word_length": 0.02, "symbols": 0.05, "dup_lines": 0.05, "repeats": 0.1}
#: Correlations count this much, so that two statistics that go together do not make the determinant vanish.
HELD = 0.99
P = len(FLOORS)
#: Statistics are rounded to this grid, which keeps sums exact and reruns equal.
GRID = 1024
#: Share of rows that an estimate rests on, and the chance of a normal row beyond the limit.
CORE, REJECT = 0.75, 1e-6
#: Rows a pool needs; smaller sources of a language are pooled, then smaller languages.
POOL = 200
STEPS = 12
#: Distance buckets per doubling.
FINE = 16


def text_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text; NULL: zeros."""
    words = _WORDS.findall(text) if text else []
    if not words:
        return 0, 0, sum(map(text.count, SYMBOLS)) if text else 0, 0, 0
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif _WORDS.search(line):
            seen.add(line)
    return len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), dup, _repeated(words)


def _repeated(words: list[str]) -> int:
    """Words that stand in a three-word window which the text has twice or more."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[str, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=n)
    if len(known) == n:
        return 0
    pairs = ids[:-1] * len(known) + ids[1:]
    if len(known) > 2_000_000:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(known) + ids[2:]
    order = np.argsort(windows, kind="stable")
    equal = windows[order][1:] == windows[order][:-1]
    if not equal.any():
        return 0
    twice = np.zeros(n - 2, dtype=bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    covered = np.zeros(n, dtype=bool)
    for k in range(3):
        covered[k : n - 2 + k] |= twice
    return int(covered.sum())


def with_counts(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a struct column ``name`` of COUNTS."""

    @F.pandas_udf(", ".join(f"{c} bigint" for c in COUNTS))
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(list(map(text_counts, batch)), columns=COUNTS, dtype="int64")

    return docs.withColumn(name, count(F.col("text").cast("string")))


def base_failed(counts: Column) -> Column:
    n = counts["n_words"]
    return (n < 50) | (100 * counts["n_repeat_words"] > 50 * n)


def statistics(counts: Column) -> list[Column]:
    """The transformed statistics, in the order of FLOORS, as whole multiples of 1 / GRID."""
    n = F.greatest(counts["n_words"], F.lit(1)).cast("double")
    raw = (
        F.log1p(counts["n_words"].cast("double")),
        F.log(F.greatest(counts["word_chars"], F.lit(1)) / n),
        F.log1p(10 * counts["n_symbols"] / n),
        F.sqrt(counts["n_dup_lines"] / n),
        F.sqrt(counts["n_repeat_words"] / n),
    )
    return [F.round(x * GRID) for x in raw]


def chi2_cdf(x: float, k: int) -> float:
    """Chi-squared distribution function, by its series."""
    if x <= 0:
        return 0.0
    term = total = 1 / (k / 2)
    i = 0
    while term > total * 1e-15:
        i += 1
        term *= x / 2 / (k / 2 + i)
        total += term
    return total * math.exp(k / 2 * math.log(x / 2) - x / 2 - math.lgamma(k / 2))


def chi2_quantile(q: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_cdf(middle, k) < q else (low, middle)
    return low


#: Makes the scatter of the core of normal rows that of all rows.
CONSISTENT = CORE / chi2_cdf(chi2_quantile(CORE, P), P + 2)
LIMIT = chi2_quantile(1 - REJECT, P)
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
_PARAMETERS = "pool string, start int, centre array<double>, weights array<double>, determinant double, n bigint"


def _estimate(n: float, sums: np.ndarray, products: np.ndarray, factor: float) -> tuple[list, list, float]:
    """Centre, the inverse scatter's upper triangle (off-diagonal doubled), log determinant."""
    centre = sums / n
    scatter = np.zeros((P, P))
    for (i, j), s in zip(PAIRS, products):
        scatter[i, j] = scatter[j, i] = (s / n - centre[i] * centre[j]) / GRID**2
    scatter *= factor
    own = np.maximum(np.diag(scatter), np.square(list(FLOORS.values())))
    scatter *= HELD
    np.fill_diagonal(scatter, own)
    inverse = np.linalg.inv(scatter)
    weights = [float(inverse[i, j] * (1 if i == j else 2)) for i, j in PAIRS]
    # Rounded, so that the last digits of sums in another order do not matter.
    exact = lambda x: float(f"{x:.12g}")
    return [exact(c / GRID) for c in centre], [exact(w) for w in weights], float(np.linalg.slogdet(scatter)[1])


def _sums() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.array(*[F.sum(f"x{i}") for i in range(P)]).alias("sums"),
            F.array(*[F.sum(F.col(f"x{i}") * F.col(f"x{j}")) for i, j in PAIRS]).alias("products")]


def distance(parameters: str = "") -> Column:
    """Squared Mahalanobis distance of x0 .. from ``centre`` by ``weights``."""
    away = [F.col(f"x{i}") / GRID - F.col("centre")[i] for i in range(P)]
    total = F.lit(0.0)
    for k, (i, j) in enumerate(PAIRS):
        total = total + F.col("weights")[k] * away[i] * away[j]
    return total


def _starts(rows: DataFrame) -> DataFrame:
    """Two first estimates per pool: all rows' moments, and medians with median deviations."""

    def whole(frame: pd.DataFrame) -> pd.DataFrame:
        r = frame.iloc[0]
        found = _estimate(float(r["n"]), np.array(r["sums"]), np.array(r["products"]), 1.0)
        return pd.DataFrame([(r["pool"], 0, *found, int(r["n"]))], columns=["pool", "start", "centre", "weights", "determinant", "n"])

    # Values on the grid are few, so exact percentiles are counts per value, merged before the shuffle.
    middle = [F.percentile(f"x{i}", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))) for i in range(P)]
    quartiles = rows.groupBy("pool").agg(F.count(F.lit(1)).alias("n"), *[m.alias(f"q{i}") for i, m in enumerate(middle)])
    spread = [F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / F.lit(1.349 * GRID), F.lit(0.0)) for i in range(P)]
    scatter = [F.greatest(s * s, F.lit(f * f)) for s, f in zip(spread, FLOORS.values())]
    determinant = F.lit(0.0)
    for s in scatter:
        determinant = determinant + F.log(s)
    robust = quartiles.select(
        "pool",
        F.lit(1).alias("start"),
        F.array(*[F.col(f"q{i}")[1] / GRID for i in range(P)]).alias("centre"),
        F.array(*[(1 / scatter[i]) if i == j else F.lit(0.0) for i, j in PAIRS]).alias("weights"),
        determinant.alias("determinant"),
        "n",
    )
    classical = rows.groupBy("pool").agg(*_sums()).groupBy("pool").applyInPandas(whole, _PARAMETERS)
    return classical.unionByName(robust)


def _concentrated(rows: DataFrame, parameters: DataFrame) -> DataFrame:
    """The next estimates: from the closest rows of each pool."""
    joined = rows.join(parameters.drop("n").withColumnRenamed("pool", "of"), F.col("pool") == F.col("of"))
    bucket = F.floor(F.log2(distance() + F.lit(1e-6)) * FINE).cast("int")
    parts = joined.groupBy("pool", "start", bucket.alias("bucket")).agg(*_sums())

    def core(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("bucket")
        counts = frame["n"].to_numpy()
        n = int(counts.sum())
        last = int(np.searchsorted(np.cumsum(counts), math.ceil(CORE * n))) + 1
        near = frame.iloc[:last]
        found = _estimate(float(counts[:last].sum()), np.sum(near["sums"].tolist(), axis=0), np.sum(near["products"].tolist(), axis=0), CONSISTENT)
        r = frame.iloc[0]
        return pd.DataFrame([(r["pool"], int(r["start"]), *found, n)], columns=["pool", "start", "centre", "weights", "determinant", "n"])

    # A group has one row per distance bucket.
    return parts.groupBy("pool", "start").applyInPandas(core, _PARAMETERS)


def pool_estimates(rows: DataFrame) -> DataFrame:
    """``pool, centre, weights``: the estimate of least determinant, for pools with enough rows.

    ``rows`` has ``pool`` and x0, x1, ...; pools with fewer than 2 (P + 1) rows have no estimate.
    """
    parameters = written(_starts(rows), "estimates")
    before = None
    for _ in range(STEPS):
        parameters = written(_concentrated(rows, parameters), "estimates")
        now = parameters.agg(F.sum("determinant"), F.count(F.lit(1))).first()
        if before is not None and abs((now[0] or 0.0) - before) <= 1e-6 * max(1, now[1]):
            break
        before = now[0] or 0.0
    best = parameters.where(F.col("n") >= 2 * (P + 1)).groupBy("pool").agg(
        F.min_by(F.struct("centre", "weights"), F.struct("determinant", "start")).alias("best")
    )
    return written(best.select("pool", "best.centre", "best.weights"), "best")


def judge(docs: DataFrame, counts: str, distance_name: str, kept_name: str) -> DataFrame:
    """``docs`` (with the struct ``counts``, ``lang``, ``source``; a written table) with the verdict.

    Documents that fail the base rules take no part in the estimates. NULL is a language and a
    source of its own. The distance is NULL where a pool is too small for an estimate, and such
    documents are kept.
    """
    c = F.col(counts)
    place = F.struct(F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    good = docs.where(~base_failed(c)).select(place.alias("place"), *[x.alias(f"x{i}") for i, x in enumerate(statistics(c))])
    sizes = good.groupBy("place").agg(F.count(F.lit(1)).alias("n"))
    by_language = sizes.groupBy(F.col("place.lang").alias("l")).agg(
        F.sum(F.when(F.col("n") < POOL, F.col("n")).otherwise(0)).alias("rest")
    )
    own = F.to_json("place")
    name = F.when(F.col("n") >= POOL, own).when(
        F.col("rest") >= POOL, F.concat(F.lit("language "), F.coalesce(F.col("l"), F.lit("")), F.col("l").isNull().cast("string"))
    ).otherwise(F.lit("rest"))
    pools = written(
        sizes.join(by_language, F.col("place.lang").eqNullSafe(F.col("l"))).select(own.alias("at"), name.alias("pool")), "pools"
    )
    rows = written(good.withColumn("at", F.to_json("place")).join(pools, "at").drop("place", "at"), "statistics")
    known = written(
        pools.join(pool_estimates(rows), "pool").select(F.col("at").alias("at_"), "centre", "weights"), "known"
    )
    wide = [F.col(f"`{x}`") for x in docs.columns]
    all_ = F.struct(*wide).alias("all")
    placed = docs.select(all_, F.to_json(place).alias("at"), *[x.alias(f"x{i}") for i, x in enumerate(statistics(c))])
    far = F.when(base_failed(F.col(f"all.{counts}")), F.lit(None)).otherwise(distance())
    judged = placed.join(known, F.col("at") == F.col("at_"), "left").select("all", far.alias("far"))
    failed = base_failed(F.col(f"all.{counts}"))
    return judged.select(
        "all.*", F.col("far").alias(distance_name), (~failed & F.coalesce(F.col("far") <= LIMIT, F.lit(True))).alias(kept_name)
    )


def judge_documents(docs: DataFrame) -> DataFrame:
    """doc_id, COUNTS, base_failed, kept and the squared distance of every document."""
    narrow = docs.select("doc_id", "lang", "source", "text")
    counted = written(with_counts(narrow, "counts").drop("text"), "counts")
    return judge(counted, "counts", "distance", "kept").select(
        "doc_id", "counts.*", base_failed(F.col("counts")).alias("base_failed"), "kept", "distance"
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, unchanged."""
    counts = free_name(docs, "counts_")
    far, kept = free_name(docs, "distance_"), free_name(docs, "kept_")
    counted = written(with_counts(docs, counts), "counted")
    return judge(counted, counts, far, kept).where(F.col(kept)).select(*[F.col(f"`{c}`") for c in docs.columns])
