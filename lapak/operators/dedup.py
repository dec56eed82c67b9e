"""First / last row per key, de-repeated measures, numbering, duplicates.

Every choice between rows takes an explicit order. Ties on it are broken by the remaining
columns, so results do not depend on how rows were distributed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .joining import attach_totals, keep_facts

#: Rows that ``number_rows`` sorts in one task, about.
PIECE_ROWS = 1_000_000


def _ranked_one(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    # ``row_number() = 1`` is applied on each input partition before the shuffle too
    # (window group limit), so a hot key sends one row per task, not all its rows.
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(window)).where("__n = 1").drop("__n")


def _ties(df: DataFrame, used: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in used]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key by ``order`` (NULLs first); a NULL key is a key."""
    names = [*order, *_ties(df, [*keys, *order])]
    return _ranked_one(df, keys, [F.col(f"`{c}`").desc_nulls_last() for c in names])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key by ``order`` (NULLs last)."""
    names = [*order, *_ties(df, [*keys, *order])]
    return _ranked_one(df, keys, [F.col(f"`{c}`").asc_nulls_last() for c in names])


def latest_two_stage(
    df: DataFrame, first_key: str, second_key: str, order: Sequence[str]
) -> DataFrame:
    """Latest row per variant, then per barcode."""
    return latest_per_key(latest_per_key(df, [first_key], order), [second_key], order)


def derepeat(
    df: DataFrame,
    measures: Mapping[str, Sequence[str]],
    order: Sequence[str],
    spread: Sequence[str] = (),
) -> DataFrame:
    """Keep each measure on the first row of its group, put 0 on the others.

    ``measures`` maps a measure to the columns of its group; name the measure among them where
    it is not the same throughout. ``order`` must identify a row.

    ``spread`` splits large groups: the first row of each sub-group is found beforehand, and
    only these leaders are compared within the whole group, while the other rows stay in their
    sub-groups. A window then holds one sub-group, or one leader per sub-group.
    """

    def first_of(*partition: str | Column, known: Sequence[str]) -> Column:
        by = [F.col(f"`{c}`") for c in order if c not in known]
        return F.row_number().over(Window.partitionBy(*partition).orderBy(*(by or [F.lit(1)]))) == 1

    for measure, group in measures.items():
        finer = [c for c in spread if c not in group]
        first = first_of(*group, *finer, known=[*group, *finer])
        if finer:
            df = df.withColumn("__lead", first)
            place = [F.when(~F.col("__lead"), F.col(c)) for c in finer]
            whole = first_of(*group, "__lead", *place, known=group)
            first = F.col("__lead") & whole
        zero = F.lit(0).cast(df.schema[measure].dataType)
        df = df.withColumn(measure, F.when(first, F.col(measure)).otherwise(zero)).drop("__lead")
    return df


def with_duplicate_flag(
    df: DataFrame, keys: Sequence[str], count: str = "total_files", flag: str = "is_duplicated"
) -> DataFrame:
    """Rows per key on every row, and whether there is more than one."""
    counted = attach_totals(df, keys, {count: F.count(F.lit(1))})
    return counted.withColumn(
        flag, F.when(F.col(count) > 1, F.lit("Duplicated")).otherwise(F.lit("Not Duplicated"))
    )


def number_rows(
    df: DataFrame, order: Sequence[str], group: Sequence[str] = (), name: str = "no"
) -> DataFrame:
    """Consecutive numbers from 1 within each group, in ``order``, without a one-task window.

    Rows are written, range-partitioned on the full order into pieces of a bounded size, sorted there
    and written again with their places, so a piece's content is fixed and its rows are not shuffled a
    second time; a row's number follows from its place, where its group begins in the piece, and the
    number of rows the group has in earlier pieces.
    """
    keys = [*group, *order]
    rows = stored(df, "unnumbered")
    # The count comes from the files' footers.
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = max(usual, rows.count() // PIECE_ROWS + 1)
    by = [F.col(f"`{k}`") for k in keys]
    ranged = rows.repartitionByRange(pieces, *by).sortWithinPartitions(*by)
    # Within a partition these ids are consecutive.
    placed = {"__piece": F.spark_partition_id(), "__place": F.monotonically_increasing_id()}
    ranged = stored(ranged.withColumns(placed), "pieces")
    # One row per piece and group: at most ``pieces`` rows in any window partition.
    earlier = Window.partitionBy(*[F.col(f"`{g}`") for g in group] or [F.lit(1)]).orderBy("__piece").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counts = ranged.groupBy("__piece", *[F.col(f"`{g}`") for g in group]).agg(
        F.count(F.lit(1)).alias("__rows"), F.min("__place").alias("__first")
    )
    before = F.coalesce(F.sum("__rows").over(earlier), F.lit(0))
    # Written, so Spark knows how few they are.
    shifts = stored(
        counts.select("__piece", *[F.col(f"`{g}`") for g in group], (before - F.col("__first") + 1).alias("__shift")), "shifts"
    )
    joined = keep_facts(ranged, shifts, ["__piece", *group], null_safe=True)
    return joined.withColumn(name, F.col("__place") + F.col("__shift")).drop("__piece", "__place", "__shift")
