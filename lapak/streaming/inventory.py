"""The inventory of a landing folder, kept as a table to which each run adds the new files only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import latest_per_key

SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def list_new_files(spark: SparkSession, landing: str, table: str, checkpoint: str, pattern: str = "*") -> StreamingQuery:
    """Add the files that landed since the last run: path, modified, length, listed_in (the run's number).

    The stream's checkpoint knows what was listed before, and contents are not read. Each run writes
    a folder of its own, so a run that is repeated after a failure replaces its own rows. A file
    that is written again under its old name is not a new file to the stream: drops carry their day
    or a number in their names.
    """
    stream = (
        spark.readStream.format("binaryFile").schema(SCHEMA).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(landing)
    ).select("path", F.col("modificationTime").alias("modified"), "length")

    def add(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("listed_in", F.lit(number).cast("long"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("listed_in").parquet(table)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def inventory(spark: SparkSession, table: str) -> DataFrame:
    """All files listed so far, one row per path."""
    rows = spark.read.schema("path string, modified timestamp, length bigint, listed_in bigint").parquet(table)
    return latest_per_key(rows, ["path"], ["modified", "listed_in"])
