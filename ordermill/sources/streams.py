"""Message streams: one column layout for a broker and for a file replay."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.schemas import MESSAGE

ORDERS, RETRY, DEAD_LETTER = "orders", "orders_retry", "orders_dlq"


def kafka_options(servers: str, topics: Sequence[str], start: str = "latest",
                  max_offsets: int | None = None) -> dict[str, str]:
    """Reader options for the order topics; ``start`` is latest or earliest."""
    if start not in ("latest", "earliest"):
        raise ValueError(f"start must be latest or earliest, got {start!r}")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": start,
        "failOnDataLoss": "true",
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def offset_range_options(servers: str, starts: dict[str, dict[int, int]],
                         ends: dict[str, dict[int, int]] | None = None) -> dict[str, str]:
    """Batch-read options for exact offsets, ``{topic: {partition: offset}}``."""
    text = lambda m: json.dumps({t: {str(p): o for p, o in ps.items()} for t, ps in m.items()})
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(sorted(starts)),
        "startingOffsets": text(starts),
        "endingOffsets": text(ends) if ends else "latest",
    }


def _as_messages(frame: DataFrame) -> DataFrame:
    return frame.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def read_stream(spark: SparkSession, fmt: str, options: dict[str, str],
                path: str | None = None) -> DataFrame:
    """A stream of messages. ``kafka`` in production; parquet or json files in
    the same layout replay a topic."""
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        return _as_messages(reader.load())
    return _as_messages(reader.schema(MESSAGE).load(path))


def read_offsets(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """One bounded batch from exact offsets."""
    return _as_messages(spark.read.format("kafka").options(**options).load())


def to_landing_columns(messages: DataFrame) -> DataFrame:
    """Message layout to the columns the landing job expects."""
    return messages.select(
        F.col("value").alias("raw"),
        F.col("topic").alias("_source_topic"),
        F.col("partition").cast("bigint").alias("_kafka_partition"),
        F.col("offset").alias("_kafka_offset"),
    )


def registry_payload(value: Column) -> Column:
    """Message bytes behind a schema-registry frame (1 magic byte + 4-byte id)."""
    return F.substring(value, 6, 2_147_483_647)


def registry_id(value: Column) -> Column:
    """The schema id inside a schema-registry frame."""
    return F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("int")


def from_registry_avro(value: Column, schema: str) -> Column:
    """Record behind a registry frame as JSON text, the form the change-event
    operators read. Needs the Avro package on the cluster."""
    from pyspark.sql.avro.functions import from_avro

    return F.to_json(from_avro(registry_payload(value), schema))


def write_stream(rows: DataFrame, fmt: str, options: dict[str, str], checkpoint: str):
    """Publishes ``key, value[, headers]`` rows, e.g. to the order topic."""
    return (
        rows.writeStream.format(fmt)
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
