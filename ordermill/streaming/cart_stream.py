"""Carts as a stateful stream, keyed by user."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ordermill.operators.dedupe import first_by

EVENT = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("action", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("event_id", T.LongType()),
    ]
)
LINE = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("slice", T.LongType()),
        T.StructField("quantity", T.LongType()),
    ]
)
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# A user's adds are spread over this many slices by product and event, so that neither a very busy
# user nor a single very busy line is one task's work.
SLICES = 8
#: Groups that users are dealt to by hash. A state key is a slice of a group, so what a batch pays per key does not
#: grow with the users.
GROUPS = 512
#: How much later than the newest event an event may come.
LATE = "2 days"

PLACE = [T.StructField("ts", T.LongType()), T.StructField("event_id", T.LongType())]
ADD = T.StructType([*PLACE, T.StructField("quantity", T.LongType())])
USER = T.StructField("user_id", T.StringType())


class CartProcessor(StatefulProcessor):
    """State per slice of a group of users: for each user when the cart was last emptied and which products have a
    line here, and a map with one entry per line.

    A line holds the adds that late events may still touch one by one, and the sum of those
    behind the watermark. Events count by their own time, whatever batch brings them: an add
    older than the last empty is dropped, a late empty takes only the adds before it, an
    add that is replayed is known by its time and id, and what is behind the watermark comes too late.
    Every empty that is still accepted lies behind all settled adds, so it takes the sum as a whole.
    A batch reads and writes its users and the lines that it adds to; an empty reads its user's lines. Changed lines
    are emitted with their new quantity, 0 when nothing is left."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._lines = handle.getMapState(
            "lines",
            T.StructType([USER, T.StructField("product_id", T.StringType())]),
            T.StructType([T.StructField("settled", T.LongType()), T.StructField("recent", T.ArrayType(ADD))]),
        )
        self._users = handle.getMapState(
            "users", T.StructType([USER]), T.StructType([*PLACE, T.StructField("products", T.ArrayType(T.StringType()))])
        )

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        empties: dict[str | None, tuple[int, int]] = {}
        adds: dict[str | None, dict] = {}
        for chunk in rows:
            chunk = chunk.assign(ts=chunk["ts"].astype("datetime64[us]").astype("int64"))
            if watermark > 0:
                chunk = chunk[chunk["ts"] >= watermark]
            emptied = chunk[chunk["action"] == "empty"]
            for user, *place in zip(emptied["user_id"], emptied["ts"].tolist(), emptied["event_id"].tolist()):
                empties[user] = max(empties.get(user, (place[0], place[1])), (place[0], place[1]))
            added = chunk[chunk["action"] == "add"]
            for user, product, *add in zip(added["user_id"], added["product_id"], added["ts"].tolist(), added["event_id"].tolist(), added["quantity"].tolist()):
                adds.setdefault(user, {}).setdefault(product, {})[tuple(add[:2])] = int(add[2])
        changed = [line for user in adds.keys() | empties.keys() for line in self._folded(user, empties.get(user), adds.get(user, {}), watermark)]
        users, products, quantities = zip(*changed) if changed else ((), (), ())
        yield pd.DataFrame(
            {"user_id": list(users), "product_id": list(products), "slice": int(key[0]) % SLICES, "quantity": list(quantities)}
        ).astype({"user_id": "object", "product_id": "object", "slice": "int64", "quantity": "int64"})

    def _folded(self, user: str | None, empty: tuple[int, int] | None, adds: dict, watermark: int) -> Iterator[tuple]:
        """Brings a user's lines up to date; yields those that changed."""
        known = self._users.getValue((user,)) if self._users.containsKey((user,)) else None
        emptied = (known[0], known[1]) if known is not None and known[0] is not None else None
        before_lines = set(known[2]) if known is not None else set()
        latest = emptied if empty is None else empty if emptied is None else max(emptied, empty)
        read = before_lines if latest != emptied else before_lines & adds.keys()
        held = {p: self._lines.getValue((user, p)) for p in read}
        after_lines = set(before_lines)
        for product in adds.keys() | held.keys():
            settled, recent = held.get(product) or (0, [])
            before = settled + sum(add[2] for add in recent)
            kept = {(add[0], add[1]): add[2] for add in recent} | adds.get(product, {})
            if latest != emptied:
                settled = 0
            if latest is not None:
                kept = {place: quantity for place, quantity in kept.items() if place > latest}
            after = settled + sum(kept.values())
            settled += sum(quantity for place, quantity in kept.items() if place[0] < watermark)
            kept = {place: quantity for place, quantity in kept.items() if place[0] >= watermark}
            if kept or settled:
                after_lines.add(product)
                self._lines.updateValue((user, product), (settled, [(*place, quantity) for place, quantity in sorted(kept.items())]))
            elif product in held:
                after_lines.discard(product)
                self._lines.removeKey((user, product))
            if before != after:
                yield user, product, after
        if latest != emptied or after_lines != before_lines:
            self._users.updateValue((user,), (*(latest or (None, None)), list(after_lines)))

    def close(self) -> None:
        pass


def changes(events: DataFrame, late: str = LATE) -> DataFrame:
    """Changed cart lines of a stream of cart events, per slice. Empties go to every slice of their user's group;
    events without a time or an id are left out."""
    group = F.pmod(F.xxhash64("user_id"), F.lit(GROUPS))
    own = F.array(F.pmod(F.xxhash64("product_id", "event_id"), F.lit(SLICES)))
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(SLICES - 1).cast("bigint"))
    sliced = (
        events.where("ts is not null and event_id is not null")
        .withWatermark("ts", late)
        .withColumn("slice", F.explode(F.when(F.col("action") == "empty", every).otherwise(own)))
        .select((group * SLICES + F.col("slice")).alias("part"), F.col("user_id").cast("string").alias("user_id"), "action", "product_id", "quantity", "ts", "event_id")
    )
    return sliced.groupBy("part").transformWithStateInPandas(
        statefulProcessor=CartProcessor(),
        outputStructType=LINE,
        outputMode="Update",
        timeMode="EventTime",
    )


def current(updates: DataFrame) -> DataFrame:
    """Lines that are in the carts now: the latest change per line and slice, added up, if not 0."""
    latest = first_by(updates, ["user_id", "product_id", "slice"], [F.desc("batch")])
    lines = latest.groupBy("user_id", "product_id").agg(F.sum("quantity").alias("quantity"))
    return lines.where(F.col("quantity") > 0)


def run_available(spark: SparkSession, events_path: str, root: str, max_files: int | None = None, late: str = LATE) -> DataFrame:
    """Runs the stream over what is there and returns the carts after it."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    reader = spark.readStream.schema(EVENT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))

    def store(batch: DataFrame, batch_id: int) -> None:
        # The stateful plan must run exactly once per batch: one write.
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            f"{root}/lines/batch={batch_id}"
        )

    query = (
        changes(reader.parquet(events_path), late)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", f"{root}/checkpoint")
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return current(spark.read.schema(T.StructType([*LINE.fields, T.StructField("batch", T.LongType())])).parquet(f"{root}/lines"))
