"""Processing metrics: lag, sliding counts, freshness, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW, STEP = "5 minutes", "15 seconds"
WINDOW_SECONDS, STEP_SECONDS = 300, 15
LAG_LIMIT = 300
FRESHNESS_SECONDS = 3_600


def lag(end_offsets: DataFrame, committed: DataFrame, topics: DataFrame) -> DataFrame:
    """Unread messages per topic. A partition without a commit counts from 0, a
    topic without partitions has no lag."""
    behind = end_offsets.join(committed, ["topic", "partition"], "left").groupBy("topic").agg(
        F.sum(
            F.greatest(F.lit(0), F.col("end_offset") - F.coalesce("committed", F.lit(0)))
        ).cast("bigint").alias("lag")
    )
    return topics.join(behind, "topic", "left").select(
        "topic", F.coalesce("lag", F.lit(0).cast("bigint")).alias("lag")
    )


def _ticks(outcomes: DataFrame, *by: str, **aggregates: Column) -> DataFrame:
    """Folds rows to one per 15-second step before they are spread over windows."""
    return outcomes.groupBy(F.window("ts", STEP)["start"].alias("tick"), *by).agg(
        *(c.alias(n) for n, c in aggregates.items())
    )


def increase(outcomes: DataFrame, status: str) -> DataFrame:
    """Messages with ``status`` in each 5-minute window, sliding by 15 seconds."""
    ticks = _ticks(outcomes.where(F.col("status") == status), n=F.count(F.lit(1)))
    return ticks.groupBy(F.window("tick", WINDOW, STEP)["start"].alias("window_start")).agg(
        F.sum("n").cast("bigint").alias("n")
    )


def alert_dead_letters(outcomes: DataFrame) -> DataFrame:
    """Windows in which any message was dead-lettered."""
    return increase(outcomes, "dlq").where(F.col("n") > 0)


def rate_by_status(outcomes: DataFrame) -> DataFrame:
    """Messages per second and status over sliding 5-minute windows."""
    ticks = _ticks(outcomes, "status", n=F.count(F.lit(1)))
    return ticks.groupBy(
        F.window("tick", WINDOW, STEP)["start"].alias("window_start"), "status"
    ).agg((F.sum("n") / F.lit(float(WINDOW_SECONDS))).alias("per_second"))


def freshness(outcomes: DataFrame, now: Column, limit_seconds: int = FRESHNESS_SECONDS) -> DataFrame:
    """Seconds since the last success per topic, and whether that is in the SLA."""
    last = outcomes.where(F.col("status") == "success").groupBy("topic").agg(F.max("ts").alias("last_ts"))
    age = (F.unix_micros(now) - F.unix_micros("last_ts")) / F.lit(1e6)
    return last.withColumn("age_seconds", age).withColumn("in_sla", F.col("age_seconds") < limit_seconds)


def alert_lag(samples: DataFrame, limit: int = LAG_LIMIT) -> DataFrame:
    """Windows of 5 minutes in which a topic's lag was above the limit throughout.

    ``samples`` has (ts, topic, lag); a topic's lag at one step is its largest. A step
    without a sample says nothing; the first and the last step of a window must have
    one, so that the lag is seen to have held for the whole time.
    """
    ticks = _ticks(samples, "topic", lag=F.max("lag"))
    spread = F.window("tick", WINDOW, STEP)
    held = ticks.groupBy(spread["start"].alias("window_start"), "topic").agg(
        F.min("lag").alias("min_lag"), F.min("tick").alias("first"), F.max("tick").alias("last")
    )
    whole = F.unix_micros("last") - F.unix_micros("first") == (WINDOW_SECONDS - STEP_SECONDS) * 1_000_000
    return held.where((F.col("min_lag") > limit) & whole).select("window_start", "topic", "min_lag")
