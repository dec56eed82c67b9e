"""File-drop ingest: newly landed deliveries replace the dates they carry, within their scope."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.joining import keep_facts
from ..session import stored


def delivery_of(path: str) -> Column:
    """The delivery that a file belongs to.

    A file is a delivery of its own, but part files of one Spark write, which differ only in
    their part number, are one.
    """
    return F.regexp_replace(F.regexp_replace(path, r"/part-[0-9]+-", "/part-"), r"-c[0-9]+(?=\.)", "")


def newest_delivery(
    df: DataFrame,
    date: str,
    scope: Sequence[str] = (),
    arrived: str = "arrived_at",
    delivery: str = "delivery",
) -> DataFrame:
    """Of several deliveries carrying the same date keep the rows of the newest one.

    ``scope`` names what a delivery is complete for, such as brand and marketplace: another
    scope's rows of that date stay. A delivery is as new as its newest file; of two equally new
    ones the last by name counts. The choice is made on aggregated keys; rows are never gathered.
    """
    keys = [*scope, date]
    each = df.groupBy(*keys, delivery).agg(F.max(arrived).alias("__at"))
    newest = each.groupBy(*keys).agg(F.max(F.struct("__at", delivery)).alias("__newest"))
    marked = keep_facts(df, newest, keys, null_safe=True)
    return marked.where(F.col(delivery) == F.col(f"__newest.{delivery}")).drop("__newest")


def ledger_schema(keys: Sequence[T.StructField]) -> T.StructType:
    known = T.StructType([T.StructField("at", T.TimestampType()), T.StructField("delivery", T.StringType())])
    return T.StructType([*keys, T.StructField("known", known), T.StructField("batch", T.LongType())])


def read_ledger(path: str, keys: DataFrame, before: int) -> DataFrame:
    """Newest delivery accepted per scope and date (``known``: arrival and name) by earlier batches.

    Only entries of the dates in ``keys`` are looked at.
    """
    earlier = keys.sparkSession.read.schema(ledger_schema(keys.schema.fields)).parquet(path).where(F.col("batch") < before)
    same = [F.col(f"e.{c}").eqNullSafe(F.col(f"k.{c}")) for c in keys.columns]
    met = earlier.alias("e").join(keys.alias("k"), same, "left_semi")
    return met.groupBy(*keys.columns).agg(F.max("known").alias("known"))


def accept(
    batch: DataFrame,
    known: DataFrame,
    date: str,
    scope: Sequence[str] = (),
    arrived: str = "arrived_at",
    delivery: str = "delivery",
) -> DataFrame:
    """Rows of a batch that replace what is held: of each scope and date the newest delivery, unless
    ``known`` has one that is newer, or just as new with a later name."""
    newest = newest_delivery(batch, date, scope, arrived, delivery)
    marked = keep_facts(newest, known, [*scope, date], null_safe=True)
    here = F.struct(F.col(arrived).cast("timestamp").alias("at"), F.col(delivery).alias("delivery"))
    return marked.where(F.col("known").isNull() | (here >= F.col("known"))).drop("known")


def ingest(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    schema: T.StructType,
    date: str,
    file_format: str = "csv",
    scope: Sequence[str] = (),
    ledger: str | None = None,
    arrived: Column | None = None,
) -> StreamingQuery:
    """Process every file not seen before, then stop.

    ``table`` is partitioned by ``scope`` and ``date``; overwriting only the partitions present in
    a batch is the replace-by-date rule, and leaves other scopes' rows of a date alone.

    A delivery may be seen late, after a newer one of the same scope and date. ``ledger`` (by
    default beside the table) keeps what each batch accepted, a row per scope and date and batch,
    and an older delivery is left out whenever it comes. ``arrived`` tells a delivery's time where
    that of its file does not, as on stores that give a moved file a new one. A delivery has to
    land whole: of one whose files are seen in two batches the later batch's rows stay.

    A batch repeated after a failure looks at the entries of earlier batches only and writes the
    same partitions and the same entries again, so table and ledger end up the same.
    """
    ledger = ledger or table.rstrip("/") + "_ledger"
    reader = spark.readStream.schema(schema).format(file_format)
    if file_format == "csv":
        reader = reader.option("header", True)
    stream = reader.load(landing).withColumns(
        {
            "arrived_at": F.col("_metadata.file_modification_time") if arrived is None else arrived.cast("timestamp"),
            "delivery": delivery_of("_metadata.file_path"),
        }
    )
    keys = [*scope, date]
    empty = spark.createDataFrame([], ledger_schema([schema[c] for c in keys]))
    empty.write.mode("ignore").partitionBy("batch").parquet(ledger)

    def replace_dates(batch: DataFrame, number: int) -> None:
        known = read_ledger(ledger, batch.select(*keys).distinct(), number)
        kept = stored(accept(batch, known, date, scope), "accepted")
        (
            kept.drop("arrived_at", "delivery").write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*keys)
            .parquet(table)
        )
        entries = kept.groupBy(*keys).agg(F.max(F.struct(F.col("arrived_at").alias("at"), "delivery")).alias("known"))
        # One folder per batch: a repeated batch replaces its own entries.
        numbered = entries.withColumn("batch", F.lit(number).cast("long"))
        numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(ledger)

    return (
        stream.writeStream.foreachBatch(replace_dates)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def compact_ledger(spark: SparkSession, ledger: str) -> None:
    """One entry per scope and date: the newest accepted. Its batch number stays, so a batch that is
    repeated afterwards still sees the earlier ones only."""
    entries = spark.read.parquet(ledger)
    keys = [c for c in entries.columns if c not in ("known", "batch")]
    last = stored(entries.groupBy(*keys).agg(F.max(F.struct("known", "batch")).alias("m")).select(*keys, "m.known", "m.batch"), "ledger")
    last.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("batch").parquet(ledger)
