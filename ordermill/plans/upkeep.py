"""Table upkeep: retention, landing prune, orphan report."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.timestamps import days_before
from ordermill.operators import bronze
from ordermill.operators.landing import read_manifest
from ordermill.sources.files import list_files

RAW_RETENTION_DAYS = 30
BRONZE_RETENTION_DAYS = 90
ORPHAN_GRACE_DAYS = 3


def kept(table: DataFrame, today: Column, days: int = BRONZE_RETENTION_DAYS) -> DataFrame:
    """Rows inside the retention; 0 or less keeps everything. The predicate is on
    the bare partition column, so old days are pruned, not read."""
    return table if days <= 0 else table.where(F.col("_event_date") >= F.date_sub(today, days))


def expired_days(table: DataFrame, today: Column, days: int = BRONZE_RETENTION_DAYS) -> DataFrame:
    """Days past the retention and how many rows they hold."""
    if days <= 0:
        return table.where(F.lit(False)).groupBy("_event_date").agg(F.count(F.lit(1)).alias("rows"))
    old = table.where(F.col("_event_date") < F.date_sub(today, days))
    return old.groupBy("_event_date").agg(F.count(F.lit(1)).alias("rows"))


def drop_expired(spark: SparkSession, path: str, today: date, days: int = BRONZE_RETENTION_DAYS) -> int:
    """Removes whole date partitions older than the retention; no row is rewritten."""
    if days <= 0:
        return 0
    cutoff = (today - timedelta(days=days)).isoformat()
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    root = hadoop_path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    dropped = 0
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("_event_date=") and name[12:] < cutoff:
            dropped += bool(fs.delete(status.getPath(), True))
    return dropped


def prune_candidates(ledger: DataFrame, listing: DataFrame, now: Column,
                     days: int = RAW_RETENTION_DAYS) -> DataFrame:
    """Landing files that were synced, are old enough and still exist.

    A file the ledger does not know is never a candidate.
    """
    old = ledger.where(F.col("source_path").isNotNull())
    old = old.where(F.col("file_created_at") < days_before(now, days)) if days > 0 else old.where(F.lit(False))
    return old.select(F.col("source_path").alias("path"), "file_created_at").join(
        listing.select("path"), "path", "left_semi"
    )


def orphans(listing: DataFrame, referenced: DataFrame, now: Column,
            grace_days: int = ORPHAN_GRACE_DAYS) -> DataFrame:
    """Files nobody refers to, older than the grace period."""
    old = listing.where(F.col("modified_at") < days_before(now, grace_days))
    return old.join(referenced.select("path"), "path", "left_anti")


DELETES_PER_TASK = 1_000


def _delete(batches):
    from pyarrow import fs

    for batch in batches:
        gone = []
        for path in batch["path"]:
            store, inner = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
            there = store.get_file_info(inner).type == fs.FileType.File
            if there:  # a repeated task finds nothing left to do
                store.delete_file(inner)
            gone.append(there)
        yield batch.assign(deleted=gone)


def delete_files(candidates: DataFrame, dry_run: bool = True) -> int:
    """Deletes the listed files, spread over tasks; returns how many were there."""
    if dry_run:
        return 0
    paths = candidates.select("path")
    spread = paths.repartition(max(1, -(-paths.count() // DELETES_PER_TASK)), "path")
    return spread.mapInPandas(_delete, "path string, deleted boolean").where("deleted").count()


def with_columns_of(table: DataFrame, newer: DataFrame) -> DataFrame:
    """An old table read in a newer schema: missing columns are NULL."""
    return newer.limit(0).unionByName(table, allowMissingColumns=True)


def run(spark: SparkSession, bronze_path: str, landing_root: str, ledger_path: str, today: date,
        prune_dry_run: bool = False, orphan_dry_run: bool = True) -> dict[str, int]:
    """Retention, landing prune, orphan report, in this order."""
    if not bronze._exists(spark, bronze_path):
        return {}
    now = F.lit(today.isoformat()).cast("timestamp")
    done = {"expired_days": drop_expired(spark, bronze_path, today)}
    listing = list_files(spark, f"{landing_root}/data")
    ledger = bronze.read_ledger(spark, ledger_path)
    done["pruned"] = delete_files(prune_candidates(ledger, listing, now), prune_dry_run)
    unreferenced = orphans(
        list_files(spark, f"{landing_root}/data"), read_manifest(spark, f"{landing_root}/manifest"), now
    )
    done["orphans"] = unreferenced.count()
    delete_files(unreferenced, orphan_dry_run)
    return done
