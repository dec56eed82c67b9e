"""Connected components of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``links`` (a, b: bigint); a root is one node of its component.

    In each round every node points to the first of itself and its neighbours, in an order that is
    drawn anew by hashing; links are rewritten to what their ends point to, and those that fell
    together vanish. A fixed share of the nodes vanishes per round whatever the shape, long chains
    and large stars alike. Minima are aggregated before the shuffle; every joined side is a
    written table, so a hot node's links can be split over tasks.
    """
    ends = links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    live = written(ends.distinct(), "links")
    labels = written(
        live.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node")),
        "labels",
    )
    step = 0
    while not live.isEmpty():
        def drawn(c: str):
            return F.struct(F.xxhash64(F.lit(step), c).alias("rank"), F.col(c).alias("to"))

        both = live.select(F.col("a").alias("of"), drawn("b").alias("next")).unionByName(
            live.select(F.col("b").alias("of"), drawn("a").alias("next"))
        )
        best = both.groupBy("of").agg(F.min("next").alias("next"))
        moves = written(best.where(F.col("next") < drawn("of")).select("of", F.col("next.to").alias("to")), "moves")
        for end in ("a", "b"):
            live = live.join(moves, F.col(end) == F.col("of"), "left").withColumn(end, F.coalesce("to", end)).drop("of", "to")
        live = written(
            live.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
        )
        labels = written(
            labels.join(moves, F.col("root") == F.col("of"), "left").select("node", F.coalesce("to", "root").alias("root")),
            "labels",
        )
        step += 1
    return labels


def spanning_links(rows, columns, label):
    """Links that join what ``label`` keeps apart, at most one fewer than there are labels.

    ``rows`` and ``columns`` are numpy arrays of linked positions, ``label`` a list of parents
    (union-find with path halving) that is updated.
    """
    out = []
    for i, j in zip(rows.tolist(), columns.tolist()):
        a, b = i, j
        while label[a] != a:
            label[a] = label[label[a]]
            a = label[a]
        while label[b] != b:
            label[b] = label[label[b]]
            b = label[b]
        if a != b:
            label[max(a, b)] = min(a, b)
            out.append((i, j))
    return out
