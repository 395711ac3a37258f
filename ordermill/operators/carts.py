"""Carts: the fold of cart events, and snapshots of open carts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions import cart_blob
from ordermill.functions.timestamps import days_before
from ordermill.operators.dedupe import first_by
from ordermill.schemas import SNAPSHOTS

RETENTION_DAYS = 7


def fold(events: DataFrame) -> DataFrame:
    """Cart lines per user: adds after the user's last empty, summed per product.

    The last empty is one row per user. A user with very many events skews only
    the add side. The join goes by the text of the user id and the aggregations
    around it by the id, so that each has its own exchange and AQE may split the
    user in the join; the sums are folded before they are shuffled.
    """
    at = F.struct("ts", "event_id")
    last_empty = (
        events.where(F.col("action") == "empty")
        .groupBy("user_id")
        .agg(F.max(at).alias("emptied"))
        .select(F.col("user_id").cast("string").alias("_user"), "emptied")
    )
    live = (
        events.where(F.col("action") == "add")
        .withColumn("_user", F.col("user_id").cast("string"))
        .join(last_empty, "_user", "left")
        .where(F.col("emptied").isNull() | (at > F.col("emptied")))
    )
    summed = live.groupBy("user_id", "product_id").agg(F.sum("quantity").cast("bigint").alias("quantity"))
    return summed.withColumn("user_id", F.col("user_id").cast("string"))


def decode_blobs(dump: DataFrame) -> DataFrame:
    """(key, items, malformed) of a cart dump; absent values are left out."""
    return (
        dump.where(F.length("value") > 0)
        .select("key", cart_blob.decode(F.col("value")).alias("cart"))
        .select("key", "cart.items", "cart.malformed")
    )


def blob_lines(decoded: DataFrame) -> DataFrame:
    """Usable cart lines: a product and a positive quantity."""
    return (
        decoded.where(~F.col("malformed"))
        .select("key", F.explode("items").alias("i"))
        .select("key", "i.product_id", "i.quantity")
        .where((F.col("product_id") != "") & (F.col("quantity") > 0))
    )


def scan_report(decoded: DataFrame) -> DataFrame:
    return decoded.agg(
        F.count_if(~F.col("malformed")).alias("carts"),
        F.count_if(F.col("malformed")).alias("skipped"),
    )


def snapshot(lines: DataFrame, snapshot_ts: Column) -> DataFrame:
    """Units per product and how many cart lines hold it, at one moment."""
    return lines.groupBy("product_id").agg(
        F.sum("quantity").cast("bigint").alias("units_in_cart"),
        F.count(F.lit(1)).alias("carts_with_product"),
    ).select(snapshot_ts.alias("snapshot_ts"), "product_id", "units_in_cart", "carts_with_product")


def upsert_snapshots(stored: DataFrame, new: DataFrame, now: Column,
                     retention_days: int = RETENTION_DAYS) -> DataFrame:
    """New values replace stored ones per (snapshot_ts, product_id); rows strictly
    older than the retention go."""
    cutoff = days_before(now, retention_days)
    both = stored.withColumn("_age", F.lit(1)).unionByName(new.withColumn("_age", F.lit(0)))
    kept = both.where(F.col("snapshot_ts") >= cutoff)
    return first_by(kept, ["snapshot_ts", "product_id"], ["_age"]).select(*SNAPSHOTS.fieldNames())


def store_snapshot(spark: SparkSession, path: str, new: DataFrame, snapshot_ts: str,
                   retention_days: int = RETENTION_DAYS) -> None:
    """Keeps one folder per snapshot time: writing one replaces just that time,
    and retention removes whole folders, so no other snapshot is rewritten."""
    (
        new.withColumn("taken", F.date_format("snapshot_ts", "yyyyMMddHHmmss"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("taken")
        .parquet(path)
    )
    oldest = spark.sql(
        f"select date_format(timestamp'{snapshot_ts}' - interval '{retention_days}' day, 'yyyyMMddHHmmss') c"
    ).first()["c"]
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(hadoop_path(path)):
        name = status.getPath().getName()
        if name.startswith("taken=") and name[6:] < oldest:
            fs.delete(status.getPath(), True)
