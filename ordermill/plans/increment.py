"""Silver and gold kept from deltas of bronze: only the periods are written that a delta changes.

The stored silver holds the arrival of every row, so that an earlier copy that comes late takes the place of the one
that is there, on whatever day that lies. Both tables are split by period, a day or another calendar unit where days are small;
a delta reads the keys of silver and the rows of the touched periods; only rows of its own orders are shuffled. Gold is written before silver, so after a crash the same delta, applied again, finds what it found
before; a delta that is there already leaves the same rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.operators.bronze import _exists
from ordermill.operators.dedupe import first_by
from ordermill.plans import models
from ordermill.session import fresh_dir, many_writers

KEYS = ("order_id", "product_id")
PLACE = (*models.ARRIVAL, "item_pos")
#: A delta of at most so many orders is met by the hashes of their ids, 8 bytes each, on every executor.
BROADCAST_ORDERS = 2_000_000


def _staged(rows: DataFrame, name: str) -> DataFrame:
    path = fresh_dir(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _write(rows: DataFrame, path: str) -> None:
    """``rows`` hold all that their periods have from now on; the others are not written."""
    with many_writers(rows.sparkSession):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(path)


def _remove(spark: SparkSession, path: str, periods: set[date]) -> None:
    """Removes periods that have no rows any more."""
    for period in sorted(periods):
        gone = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/period={period}")
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)


def _first(items: DataFrame, root: str, period: Column) -> list[date]:
    """Both tables from their first delta. There is no row whose place could be lost, so silver is dealt by period and
    written once, and gold reads it; after a crash between them the same delta finds all of its rows and writes them anew."""
    _write(first_by(items, list(KEYS), list(PLACE)).hint("rebalance", "period"), f"{root}/silver")
    stored = items.sparkSession.read.schema(items.schema).parquet(f"{root}/silver")
    _write(models.gold_fact(stored).withColumn("period", period), f"{root}/gold")
    return sorted(r[0] for r in stored.select("period").distinct().collect())  # at most the calendar


def apply(spark: SparkSession, root: str, delta: DataFrame, unit: str = "day") -> list[date]:
    """Brings the tables below ``root`` up to bronze with ``delta``; returns the periods that were written.

    All deltas of a table must name the same ``unit``. An empty delta, or one whose items all come later than those
    stored, writes nothing.
    """
    period = F.date_trunc(unit, "event_date").cast("date")
    items = models.exploded_items(delta).select(*models.SILVER_COLUMNS, *PLACE).withColumn("period", period)
    path = f"{root}/silver"
    if not _exists(spark, path):
        return [] if items.isEmpty() else _first(items, root, period)
    arrived = _staged(first_by(items, list(KEYS), list(PLACE)), "delta-items")
    stored = spark.read.schema(arrived.schema).parquet(path)
    # Hashes of the delta's orders: while they are few, all of the stored rows stay where they lie but those they name.
    orders = _staged(arrived.select(F.xxhash64("order_id").alias("_order")).distinct(), "delta-orders")
    few = orders.count() <= BROADCAST_ORDERS
    named = lambda rows, how: rows.join(F.broadcast(orders), F.xxhash64("order_id") == F.col("_order"), how)
    place = F.struct(*PLACE)
    held = (
        (named(stored, "left_semi") if few else stored)
        .select(*KEYS, *PLACE, "period")
        .join(arrived.select(*KEYS), list(KEYS), "left_semi")
        .groupBy(*KEYS)
        .agg(F.min(place).alias("held"), F.collect_set("period").alias("held_in"))  # one period, two after a crash
    )
    # A row that is there already wins again: what a crash left behind is written anew.
    met = arrived.join(held, list(KEYS), "left").where(F.col("held").isNull() | (place <= F.col("held")))
    none = F.array().cast("array<date>")
    winning = _staged(met.withColumn("periods", F.array_union(F.array("period"), F.coalesce("held_in", none))).drop("held", "held_in"), "delta-winners")
    periods = sorted(r[0] for r in winning.select(F.explode("periods")).distinct().collect())  # at most the calendar
    if not periods:
        return []
    names = arrived.columns
    touched = stored.where(F.col("period").isin(periods))
    kept = (named(touched, "left_semi") if few else touched).join(winning.select(*KEYS), list(KEYS), "left_anti")
    near = _staged(kept.select(*names).unionByName(winning.select(*names)).hint("rebalance", "period"), "delta-rows")
    # A stored file holds one period, so what stays where it lies is not dealt anew.
    far = named(touched, "left_anti").select(*names) if few else near.limit(0)
    whole = far.unionByName(near) if few else near
    lost = set(periods) - {r["period"] for r in near.select("period").distinct().collect()}
    lost -= {r["period"] for r in far.where(F.col("period").isin(sorted(lost))).select("period").distinct().collect()} if lost else set()
    _write(models.gold_fact(whole).withColumn("period", period), f"{root}/gold")
    _remove(spark, f"{root}/gold", lost)
    _write(whole, path)
    _remove(spark, path, lost)
    return periods


def gold(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/gold").drop("period")
