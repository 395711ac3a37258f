"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app_name: str = "ordermill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are tuned for.

    Shuffle partitions are left to AQE: a high initial number is coalesced to
    the advisory size at run time, so the same job fits 1 GB and 100 TB.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        # Static sizes are those of compressed files, several times too small;
        # sides that are really small are found at run time.
        "spark.sql.autoBroadcastJoinThreshold": "2m",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Timestamps are instants; every calendar rule (hour, date) is in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


#: What one task of the table queries reads and is dealt, in compressed bytes. Rows of events and items take ten
#: times as much in memory, and a task sorts or folds all of them: more would be spilled however many tasks there are.
TASK_SIZES = {
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Event text and digests: half the bytes of the default codec.
    "spark.sql.parquet.compression.codec": "zstd",
    # Rows of a block of a kept table. Memory is only asked for every 16 blocks, and messages with their
    # events take kilobytes a row: with 10 000 rows two tasks would hold more than a gigabyte unasked.
    "spark.sql.inMemoryColumnarStorage.batchSize": "500",
}


def use_bounded_tasks(spark: SparkSession) -> None:
    """A task's share is bounded by its size, whatever the tables' sizes, so that it fits its memory. Smaller sizes
    that a session has stay."""
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, value in TASK_SIZES.items():
        if key.endswith("codec") or size(spark.conf.get(key)) > size(value):
            spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset, on a
    local master (tests, a laptop), a folder of the warehouse stands in for it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path below the session's own part of the shared folder."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def work_dir(spark: SparkSession) -> str:
    """The session's own part of the shared folder."""
    return f"{shared_dir(spark)}/ordermill/{spark.sparkContext.applicationId}"


def drop_work(spark: SparkSession) -> None:
    """Removes what this session left in the shared folder; call it when no result is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(work_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def bounded_batches(spark: SparkSession, size: str = "8m") -> Iterator[None]:
    """For tables whose rows may have megabytes: an Arrow batch ends by its bytes, both here and in the workers."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def many_writers(spark: SparkSession) -> Iterator[None]:
    """For writes that are partitioned by day after a ``rebalance`` by day.

    There a day's rows are already together, so merging shuffle partitions saves
    no file; it only makes one task write many days. Splitting of hot days stays on.
    """
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key, "true")
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)
