"""Sliding processing metrics as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.operators.monitoring import STEP, WINDOW, WINDOW_SECONDS


def _windowed(outcomes: DataFrame, late: str, *by: str) -> DataFrame:
    """Counts per 15-second step, then per 5-minute window; the second aggregation
    reads folded steps, so a row is not copied into its twenty windows."""
    steps = (
        outcomes.withWatermark("ts", late)
        .groupBy(F.window("ts", STEP).alias("step"), *by)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        steps.groupBy(F.window(F.window_time("step"), WINDOW, STEP).alias("w"), *by)
        .agg(F.sum("n").cast("bigint").alias("n"))
        .select(F.col("w.start").alias("window_start"), *by, "n")
    )


def increase(outcomes: DataFrame, status: str, late: str = "1 minute") -> DataFrame:
    return _windowed(outcomes.where(F.col("status") == status), late)


def rate_by_status(outcomes: DataFrame, late: str = "1 minute") -> DataFrame:
    counted = _windowed(outcomes, late, "status")
    return counted.withColumn("per_second", F.col("n") / F.lit(float(WINDOW_SECONDS))).drop("n")


def run(metric: DataFrame, fmt: str, checkpoint: str, **options: str):
    """Appends finished windows to a sink."""
    return (
        metric.writeStream.format(fmt)
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
