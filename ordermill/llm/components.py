"""Connected components of a link table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import saved


def contracted(links: DataFrame, rounds: int = 2) -> DataFrame:
    """(a, b) links, a < b, that connect the same nodes with about one link for each.

    Where many tasks tied one node to different nodes, it keeps the smallest and the others are tied to
    that one; mostly the same few of them, so that they fall together. A node has at most one
    link from each task, which bounds the rows that meet. Turned round, the same holds for what is left.
    """
    pairs = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    for _ in range(rounds):
        low = pairs.withColumn("low", F.min("a").over(Window.partitionBy("b")))
        ends = F.when(F.col("a") == F.col("low"), F.array(F.struct("a", "b"))).otherwise(F.array(F.struct(F.col("low").alias("a"), F.col("a").alias("b"))))
        pairs = low.select(F.explode(ends).alias("end")).select("end.a", "end.b").distinct()
    return pairs


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) for every node of a link; ``component`` is the smallest node it reaches.

    Labels only fall, and each round also takes the label of the label, so rounds grow with the
    logarithm of a component's diameter. Every round ends as a table in the shared folder. Joins stand
    on one column and the sums after them on another, so that a hub's rows can be split. Null ends are
    left out; links to oneself are allowed; no links give no rows.
    """
    there = links.select(F.col(left).alias("a"), F.col(right).alias("b"))
    back = links.select(F.col(right).alias("a"), F.col(left).alias("b"))
    both = saved(there.unionByName(back).dropna().distinct(), "links")
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("component")), "labels")
    while True:
        # A node's own label carries on beside its neighbours'; ``was`` is null in theirs.
        own = labels.select("node", F.col("component").alias("low"), F.col("component").alias("was"))
        near = both.join(labels, both.b == labels.node).select(F.col("a").alias("node"), F.col("component").alias("low"), F.lit(None).cast("bigint").alias("was"))
        lower = own.unionByName(near).groupBy("node").agg(F.min("low").alias("low"), F.max("was").alias("was"))
        aim = labels.select(F.col("node").alias("aim"), F.col("component").alias("beyond"))
        component = F.least("low", "beyond")
        jumped = saved(
            lower.join(aim, F.col("low") == F.col("aim")).select("node", component.alias("component"), (component < F.col("was")).alias("moved")), "labels"
        )
        labels = jumped.select("node", "component")
        if not jumped.where("moved").take(1):
            return labels
