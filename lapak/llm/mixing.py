"""Mixing sources to target weights by hash thresholds.

Every row has a hash; a source's share of a budget is the set of its rows below a threshold. The
threshold is found from sums per source and hash bucket: the bucket in which the running sum
passes the budget is the boundary, and only its rows are divided again. No row is sorted, and a
larger budget always takes a superset of a smaller one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, number_rows, written

#: Hash bits in use, and bits per level of the histogram.
BITS, LEVEL = 60, 12
WEIGHTS = (5, 2, 1)


def source_targets(sizes: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """``source, source_size`` with ``target``: the whole size shared by weight.

    Sources take the weights in turn, by code point, NULL last. No target exceeds ``most`` times
    the source's size; what it cannot take is shared again by weight among the others, until none
    is above. Each round is one aggregate over the sources, and a round caps a source or is the last.
    """
    order = [F.col("source").isNull(), F.col("source")]
    listed = F.array(*[F.lit(float(w)) for w in weights])
    numbered = number_rows(sizes, order, "rank")
    weighed = written(
        numbered.select(
            "source",
            "source_size",
            F.element_at(listed, (F.col("rank") % len(weights) + 1).cast("int")).alias("weight"),
            (F.col("source_size") * float(most)).alias("limit"),
        ),
        "weighed",
    )
    whole = weighed.agg(F.sum("source_size")).first()[0] or 0
    per_weight, done = 0.0, False
    while not done:
        # A source whose limit is below its share at the present rate is full.
        full = F.col("limit") <= F.col("weight") * per_weight
        held, open_ = weighed.agg(
            F.sum(F.when(full, F.col("limit")).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))),
        ).first()
        rate = (whole - (held or 0.0)) / open_ if open_ else per_weight
        done, per_weight = rate <= per_weight * (1 + 1e-12), max(rate, per_weight)
    return weighed.select(
        "source",
        "source_size",
        F.least(F.col("limit"), F.col("weight") * per_weight).alias("target"),
    )


def _thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """``source, threshold``: rows with a hash below it come nearest to the source's budget."""
    running = Window.partitionBy("source").orderBy("bucket")
    open_rows = rows.where("size > 0").select("source", "hash", "size")
    state = budgets.select("source", "budget")
    found = None
    for shift in range(BITS - LEVEL, -1, -LEVEL):
        bucket = F.shiftright("hash", shift).alias("bucket")
        sums = open_rows.groupBy("source", bucket).agg(F.sum("size").alias("held"), F.count("hash").alias("n"))
        # At most 2**LEVEL buckets per source stand in a window.
        passed = sums.withColumn("upto", F.sum("held").over(running)).join(
            state.withColumnRenamed("source", "at"), F.col("source").eqNullSafe(F.col("at"))
        )
        edge = written(
            passed.where("upto > budget and upto - held <= budget").select(
                "source",
                "bucket",
                "held",
                "n",
                (F.col("budget") - (F.col("upto") - F.col("held"))).alias("budget"),
            ),
            "edge",
        )
        # What is left of the budget against a bucket that cannot be divided: the nearer side.
        whole = (F.col("budget") * 2 >= F.col("held")).cast("long")
        final = F.lit(shift == 0) | (F.col("n") == 1)
        settled = edge.where(final).select(
            "source", F.shiftleft(F.col("bucket") + whole, shift).alias("threshold")
        )
        found = settled if found is None else found.unionByName(settled)
        state = edge.where(~final)
        if state.isEmpty():
            break
        kept = state.select(F.col("source").alias("at"), F.col("bucket").alias("only"))
        inside = F.col("source").eqNullSafe(F.col("at")) & (F.shiftright("hash", shift) == F.col("only"))
        open_rows = written(open_rows.join(kept, inside).select("source", "hash", "size"), "boundary")
        state = state.select("source", "budget")
    return written(found, "thresholds")


def mix_plan(rows: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = 3) -> DataFrame:
    """``of, source_size, target, times, threshold`` per source of ``rows`` (source, size, hash).

    A source with a target of 2.3 times its size gives every row twice, and a third time those
    with a hash below the threshold.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(sizes, weights, most), "targets")
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    shares = targets.withColumn("times", times.cast("long")).withColumn(
        "budget", F.col("target") - F.col("times") * F.col("source_size")
    )
    thresholds = _thresholds(rows, shares).withColumnRenamed("source", "of")
    joined = shares.join(thresholds, F.col("source").eqNullSafe(F.col("of")), "left")
    return written(joined.select(F.col("source").alias("of"), "source_size", "target", "times", "threshold"), "plan")


def _copies(hash_: Column) -> Column:
    return F.col("times") + F.coalesce((hash_ < F.col("threshold")).cast("long"), F.lit(0))


def mix(rows: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = 3) -> DataFrame:
    """``rows`` (``source``, ``size``, ``hash`` of BITS bits) with source_size, target, copies.

    Rows with equal hashes go together. Sources without words give no copies; an empty table gives
    an empty one.
    """
    plan = mix_plan(rows, weights, most)
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("of")), "left")
    return joined.withColumn("copies", _copies(F.col("hash"))).drop("of", "times", "threshold")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(*columns: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *columns).bitwiseAND(F.lit((1 << BITS) - 1))


def measured(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, source, size, hash of every document, written."""
    narrow = docs.select(
        F.col("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
        row_hash(F.col("doc_id"), F.col("text"), seed=seed).alias("hash"),
    )
    return written(narrow, "sizes")


def mix_documents(docs: DataFrame, seed: int = 7) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document.

    Size is the number of words (NULL text: none). A document's hash is of its id and text, so
    runs agree whatever the partitions, and repeated rows are taken together. NULL is a source.
    """
    return mix(measured(docs, seed)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def take(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The mixed documents themselves: each as many times as the mix takes it."""
    plan = mix_plan(measured(docs, seed))
    wide = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("all"),
        F.col("source").cast("string").alias("from"),
        row_hash(F.col("doc_id"), F.col("text"), seed=seed).alias("hash"),
    )
    placed = wide.join(plan, F.col("from").eqNullSafe(F.col("of")), "left")
    return placed.select(F.explode(F.array_repeat("all", _copies(F.col("hash")).cast("int"))).alias("all")).select("all.*")
