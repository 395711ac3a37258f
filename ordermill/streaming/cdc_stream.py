"""Change events as a stream, applied to the table they come from.

A connector first reads the table as it is (``r``), then its log (``c``, ``u``, ``d``), at least once and in no
order across partitions. What counts is the log position: a change takes effect if it lies behind the one that its
key holds. A deleted key keeps its position, so that a late older change does not bring it back.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ordermill.functions.steps import computed_once
from ordermill.operators.cdc import route_topic
from ordermill.operators.dedupe import first_by
from ordermill.streaming.cart_stream import ROCKSDB

MESSAGE = "key string, value string, topic string"
CHANGE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("position", T.LongType()),
        T.StructField("op", T.StringType()),
        T.StructField("after", T.StringType()),
    ]
)
OPS = ("r", "c", "u", "d")


def positioned(messages: DataFrame) -> DataFrame:
    """(topic, key, position, op, after) of change messages; tombstones, other text and events without a position drop out."""
    envelope = F.from_json("value", "op string, after string, source struct<lsn: bigint>")
    return (
        computed_once(messages, {"_e": envelope})
        .where(F.col("_e.op").isin(*OPS) & F.col("_e.source.lsn").isNotNull() & F.col("key").isNotNull())
        .select(route_topic(F.col("topic")).alias("topic"), "key", F.col("_e.source.lsn").alias("position"), F.col("_e.op").alias("op"), F.col("_e.after").alias("after"))
    )


def _latest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The last change per key of each batch of rows: a key that changes all the time is folded before it is sent."""
    for frame in frames:
        yield frame.sort_values("position").drop_duplicates(["topic", "key"], keep="last")


#: Groups that keys are dealt to by hash: what a batch pays per state key does not grow with the keys of the table.
GROUPS = 1024
KEY = T.StructType([T.StructField("topic", T.StringType()), T.StructField("key", T.StringType())])


class ChangeProcessor(StatefulProcessor):
    """State per group: for each key the position of the change that holds. Emits changes that take effect, one per
    key and batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._positions = handle.getMapState("positions", KEY, T.StructType([T.StructField("position", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = pd.concat([frame[CHANGE.fieldNames()] for frame in rows])
        best = best.sort_values("position", kind="stable").drop_duplicates(["topic", "key"], keep="last")
        effective = [self._takes_effect((topic, name), int(position)) for topic, name, position in zip(best["topic"], best["key"], best["position"].tolist())]
        if any(effective):
            yield best[effective]

    def _takes_effect(self, key: tuple, position: int) -> bool:
        if self._positions.containsKey(key) and position <= self._positions.getValue(key)[0]:
            return False
        self._positions.updateValue(key, (position,))
        return True

    def close(self) -> None:
        pass


def applied(changes: DataFrame) -> DataFrame:
    """Of a stream of positioned changes those that take effect, in update mode."""
    folded = changes.mapInPandas(_latest, CHANGE).withColumn("part", F.pmod(F.xxhash64("topic", "key"), F.lit(GROUPS)))
    return folded.groupBy("part").transformWithStateInPandas(
        statefulProcessor=ChangeProcessor(), outputStructType=CHANGE, outputMode="Update", timeMode="None"
    )


def run_available(spark: SparkSession, messages_path: str, root: str, max_files: int | None = None) -> None:
    """Applies what is there; effective changes are kept below ``root/changes``, a folder per batch."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    reader = spark.readStream.schema(MESSAGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{root}/changes/batch={batch_id}")

    writer = applied(positioned(reader.parquet(messages_path))).writeStream.foreachBatch(store).option("checkpointLocation", f"{root}/checkpoint")
    writer.outputMode("update").trigger(availableNow=True).start().awaitTermination()


def current(spark: SparkSession, root: str) -> DataFrame:
    """The table as the changes leave it: topic, key, position, op, after of every key that is not deleted."""
    kept = spark.read.schema(CHANGE).option("recursiveFileLookup", "true").parquet(f"{root}/changes")
    return first_by(kept, ["topic", "key"], [F.desc("position")]).where("op <> 'd'")
