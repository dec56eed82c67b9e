"""Session settings the operators rely on, and tables written between steps."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings only: they may be changed on a running session and leave
# cluster sizing (executors, shuffle partitions, memory) to the operator of the cluster.
RUNTIME_SETTINGS = {
    # All timestamps are stored in UTC; local time is derived explicitly.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot store, order or barcode is split over tasks instead of landing in one.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A window or aggregate per store and day must not run on data clustered by store alone,
    # where one store can be a third of all rows.
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    # A rewrite of one month must not delete the other months.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "lapak", cores: int | str = "*", **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Whether rows must be put together by all keys of a grouping, and of a join.
ALL_KEYS = ("spark.sql.requireAllClusterKeysForDistribution", "spark.sql.requireAllClusterKeysForCoPartition")


@contextmanager
def grouped_where_they_are(spark: SparkSession) -> Iterator[None]:
    """Plans run within group and join rows where some of the keys have put them together already.

    For plans that name these keys themselves (``repartition``), none of which may be hot.
    """
    before = {name: spark.conf.get(name) for name in ALL_KEYS}
    for name in ALL_KEYS:
        spark.conf.set(name, "false")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names in ``spark.checkpoint.dir``.

    Where that is unset it is a folder below the warehouse. On a cluster the warehouse must then be
    on a shared file system: on a local disk of the driver no executor would find what another wrote.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/lapak-scratch"
        require_shared(folder, context.master)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def require_shared(folder: str, master: str) -> None:
    """Refuse a folder on local disks where executors run on other machines."""
    if folder.startswith("file:") and not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"spark.checkpoint.dir is not set, and {folder} is on local disks: name a shared folder")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: computed once however often it is
    used, and Spark knows its size."""
    path = scratch_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
