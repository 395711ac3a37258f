"""The ingest stream: messages to order items, retries and dead letters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.operators import ingest, landing
from ordermill.operators.bronze import _exists
from ordermill.operators.dedupe import first_by
from ordermill.operators.keyed import KeyedTable, Layout
from ordermill.schemas import MESSAGE, ORDER_ITEMS
from ordermill.sources import streams

KEY = ["order_id", "product_id"]
ITEMS_LAYOUT = Layout(tuple(KEY), "event_date", period="month")
TRIGGER = "60 seconds"
# First arrival: by the broker's time, then by place, then by position in the event.
ARRIVAL = ("timestamp", "topic", "partition", "offset", "item_pos")


def read_order_items(spark: SparkSession, path: str) -> DataFrame:
    if not _exists(spark, path):
        return spark.createDataFrame([], ORDER_ITEMS)
    return spark.read.schema(ORDER_ITEMS).parquet(path).select(*ORDER_ITEMS.fieldNames())


def insert_absent(items: DataFrame, path: str, same_day: bool = False, layout: Layout = ITEMS_LAYOUT) -> None:
    """Appends the items whose (order_id, product_id) the table lacks.

    The first arrival in the batch wins. Running the same batch again adds
    nothing. The table's filters tell which of its periods may hold a key; with
    ``same_day`` only the batch's own are looked at: exact as long as every copy
    of an order states the same timestamp.
    """
    first = first_by(items, KEY, list(ARRIVAL))
    rows = ingest.order_item_rows(first).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        KeyedTable(items.sparkSession, path, ORDER_ITEMS, layout).insert_absent(rows, F.lit(same_day))
    finally:
        rows.unpersist()


def publish_files(rows: DataFrame, path: str, topic: str, batch_id: int) -> None:
    """File stand-in of a topic, in message layout; a replay replaces its batch."""
    have = set(rows.columns)
    (
        rows.select(
            "key",
            "value",
            F.lit(topic).alias("topic"),
            F.lit(0).alias("partition"),
            F.monotonically_increasing_id().alias("offset"),
            F.current_timestamp().alias("timestamp"),
            *(["headers"] if "headers" in have else []),
        )
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .parquet(f"{path}/{topic}/batch={batch_id}")
    )


def publish_kafka(servers: str) -> Callable[[DataFrame, str, int], None]:
    """Sink for a broker; rows carry key, value and, for retries, headers."""

    def publish(rows: DataFrame, topic: str, batch_id: int) -> None:
        (
            rows.write.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("kafka.acks", "all")
            .option("includeHeaders", "true")
            .option("topic", topic)
            .save()
        )

    return publish


def process_batch(items_path: str, publish: Callable[[DataFrame, str, int], None],
                  transient: Column | None = None, max_attempt: int = ingest.RETRY_MAX_ATTEMPT,
                  outcomes_path: str | None = None, same_day: bool = False):
    """``foreachBatch`` function. The routed batch is kept while its three
    destinations are written, so the messages are parsed once; the checkpoint
    moves on only after all writes are done."""

    def run(batch: DataFrame, batch_id: int) -> None:
        routed = ingest.outcome(batch, transient, max_attempt=max_attempt)
        routed = routed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            accepted = routed.where(F.col("route") == "ok")
            insert_absent(ingest.flatten(accepted, *ARRIVAL[:-1]), items_path, same_day)
            publish(ingest.retries(routed), streams.RETRY, batch_id)
            publish(ingest.dead_letters(routed), streams.DEAD_LETTER, batch_id)
            if outcomes_path:
                (
                    ingest.count_outcomes(routed, "topic")
                    .withColumn("ts", F.current_timestamp())
                    .coalesce(1)
                    .write.mode("overwrite")
                    .option("partitionOverwriteMode", "static")
                    .parquet(f"{outcomes_path}/batch={batch_id}")
                )
        finally:
            routed.unpersist()

    return run


def start(messages: DataFrame, checkpoint: str, handler, available_now: bool = False,
          interval: str = TRIGGER):
    """Starts the stream: every interval, or once through what is there."""
    writer = (
        messages.writeStream.foreachBatch(handler)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def file_topics(spark: SparkSession, root: str, topics: str = "{orders,orders_retry}",
                max_files: int | None = None) -> DataFrame:
    """The order and retry topics below ``root``, replayed from files as one stream."""
    reader = spark.readStream.schema(MESSAGE).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(f"{root}/{topics}")


def run_available(spark: SparkSession, root: str, transient: Column | None = None,
                  max_attempt: int = ingest.RETRY_MAX_ATTEMPT, max_files: int | None = None,
                  handler=None) -> None:
    """Drains the file topics below ``root`` once. Retries land in the retry topic
    and are read by the next run."""
    publish = lambda rows, topic, batch_id: publish_files(rows, f"{root}/topics", topic, batch_id)
    handler = handler or process_batch(
        f"{root}/order_items", publish, transient, max_attempt, f"{root}/outcomes"
    )
    messages = file_topics(spark, f"{root}/topics", max_files=max_files)
    start(messages, f"{root}/checkpoint", handler, available_now=True).awaitTermination()


def land_stream(messages: DataFrame, root: str, checkpoint: str, available_now: bool = False,
                interval: str = TRIGGER):
    """Lands a message stream: one folder and manifest entry set per micro-batch."""

    def land(batch: DataFrame, batch_id: int) -> None:
        landing.land_batch(streams.to_landing_columns(batch), root, batch_id)

    return start(messages, checkpoint, land, available_now, interval)
