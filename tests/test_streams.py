"""Streams run to the end of what is there; running them again changes nothing."""

import datetime
import json
import random

from pyspark.sql import functions as F

from ordermill.operators import bronze, landing
from ordermill.operators.ingest import RETRY_MAX_ATTEMPT
from ordermill.schemas import MESSAGE
from ordermill.streaming import cart_stream, etl, metrics
from test_ingest import item, order


def publish(spark, folder, batch, values, topic="orders"):
    rows = [(None, v if isinstance(v, str) else json.dumps(v), topic, 0, batch * 100 + i, None) for i, v in enumerate(values)]
    spark.createDataFrame(rows, MESSAGE).coalesce(1).write.parquet(f"{folder}/topics/{topic}/batch={batch}")


def test_etl_routes_and_is_idempotent(spark, folder):
    publish(spark, folder, 1000, [order(items=[item("A", 2), item("A", 9), item("B")]), order(order_id=""), "junk"])
    etl.run_available(spark, folder)
    etl.run_available(spark, folder)
    items = f"{folder}/order_items"
    got = lambda: sorted((r["order_id"], r["product_id"], r["quantity"]) for r in etl.read_order_items(spark, items).collect())
    assert got() == [("o-1", "A", 2), ("o-1", "B", 1)]
    # The same order again at a new offset, with one new product.
    publish(spark, folder, 1001, [order(items=[item("A", 7), item("C")])])
    etl.run_available(spark, folder)
    assert got() == [("o-1", "A", 2), ("o-1", "B", 1), ("o-1", "C", 1)]
    dead = spark.read.parquet(f"{folder}/topics/orders_dlq")
    assert dead.count() == 2
    outcomes = spark.read.parquet(f"{folder}/outcomes").groupBy("status").agg(F.sum("n").alias("n"))
    assert {r["status"]: r["n"] for r in outcomes.collect()} == {"success": 2, "invalid": 1, "unexpected": 1}


def test_replayed_micro_batch_changes_nothing(spark, folder):
    frame = spark.createDataFrame([(None, json.dumps(order()), "orders", 0, 1, None), (None, "junk", "orders", 0, 2, None)], MESSAGE)
    send = lambda rows, topic, batch: etl.publish_files(rows, f"{folder}/topics", topic, batch)
    for same_day in (False, True):
        handler = etl.process_batch(f"{folder}/order_items", send, same_day=same_day)
        handler(frame, 0)
        handler(frame, 0)
        assert etl.read_order_items(spark, f"{folder}/order_items").count() == 1
        assert spark.read.parquet(f"{folder}/topics/orders_dlq").count() == 1


def test_retry_loop_ends_in_the_dead_letters(spark, folder):
    publish(spark, folder, 1000, [order()])
    for _ in range(RETRY_MAX_ATTEMPT + 1):
        etl.run_available(spark, folder, transient=F.lit(True))
    retries = spark.read.schema(MESSAGE).parquet(f"{folder}/topics/orders_retry")
    attempts = sorted(json.loads(r["value"])["attempt"] for r in retries.collect())
    assert attempts == [1, 2, 3]
    dead = spark.read.schema(MESSAGE).parquet(f"{folder}/topics/orders_dlq").collect()
    assert [json.loads(d["value"])["attempt"] for d in dead] == [3]
    assert json.loads(dead[0]["value"])["original"] == order()
    assert etl.read_order_items(spark, f"{folder}/order_items").count() == 0


def test_retry_succeeds_later(spark, folder):
    publish(spark, folder, 1000, [order()])
    etl.run_available(spark, folder, transient=F.lit(True))
    etl.run_available(spark, folder)
    assert etl.read_order_items(spark, f"{folder}/order_items").count() == 1


def test_landing_stream_then_bronze(spark, folder):
    publish(spark, folder, 0, [order(), order(order_id="o-2"), order()])
    for _ in range(2):
        messages = etl.file_topics(spark, f"{folder}/topics", max_files=1)
        etl.land_stream(messages, f"{folder}/lake", f"{folder}/ck", available_now=True).awaitTermination()
    assert landing.manifest_totals(landing.read_manifest(spark, f"{folder}/lake/manifest")).first()["rows"] == 3
    bronze.sync(spark, f"{folder}/lake", f"{folder}/bronze", f"{folder}/ledger")
    rows = bronze.read_bronze(spark, f"{folder}/bronze").orderBy("_kafka_offset").collect()
    assert [(r["order_id"], r["_kafka_offset"]) for r in rows] == [("o-1", 0), ("o-2", 1)]


def test_cart_stream_over_several_batches(spark, folder):
    def write(batch, rows):
        frame = spark.createDataFrame(rows, "user_id bigint, action string, product_id string, quantity bigint, t bigint, event_id bigint")
        frame.withColumn("ts", F.timestamp_seconds("t")).drop("t").coalesce(1).write.mode("append").parquet(f"{folder}/events")

    write(0, [(1, "add", "p", 1, 10, 1), (1, "add", "p", 1, 11, 2), (1, "add", "q", 4, 12, 3), (2, "add", "p", 5, 10, 4)])
    lines = lambda: sorted(tuple(r) for r in cart_stream.run_available(spark, f"{folder}/events", folder).collect())
    assert lines() == [("1", "p", 2), ("1", "q", 4), ("2", "p", 5)]
    write(1, [(1, "empty", None, 0, 20, 5), (1, "add", "q", 1, 21, 6), (2, "add", "p", 2, 21, 7)])
    assert lines() == [("1", "q", 1), ("2", "p", 7)]
    assert lines() == [("1", "q", 1), ("2", "p", 7)]


def test_carts_go_by_event_time_and_not_by_batch(spark, folder):
    """A late add from before the empty stays out, a late empty leaves newer adds, a replayed add counts once."""
    batches = [
        [(1, "empty", None, 0, 50, 9), (1, "add", "new", 2, 60, 10)],
        [(1, "add", "old", 7, 40, 8), (1, "add", "new", 1, 70, 11), (2, "add", "kept", 3, 90, 21)],
        [(2, "add", "gone", 5, 10, 20), (1, "add", "new", 1, 70, 11)],
        [(2, "empty", None, 0, 30, 22)],
    ]
    for rows in batches:
        frame = spark.createDataFrame(rows, "user_id bigint, action string, product_id string, quantity bigint, t bigint, event_id bigint")
        frame.withColumn("ts", F.timestamp_seconds("t")).drop("t").coalesce(1).write.mode("append").parquet(f"{folder}/events")
        lines = cart_stream.run_available(spark, f"{folder}/events", folder)
    assert sorted(map(tuple, lines.collect())) == [("1", "new", 3), ("2", "kept", 3)]


def _cart_batches(spark, folder, batches, **how):
    """The lines after all batches, one a trigger."""
    for rows in batches:
        frame = spark.createDataFrame(rows, "user_id bigint, action string, product_id string, quantity bigint, t bigint, event_id bigint")
        frame.withColumn("ts", F.timestamp_seconds("t")).drop("t").coalesce(1).write.mode("append").parquet(f"{folder}/events")
    return {tuple(r) for r in cart_stream.run_available(spark, f"{folder}/events", folder, max_files=1, **how).collect()}


def test_carts_are_the_same_in_any_order_of_batches(spark, folder):
    rng = random.Random(11)
    events = [(rng.randrange(3), rng.choice(["add", "add", "add", "empty"]), rng.choice(["a", "b", None]), rng.randrange(1, 5), t, t) for t in range(100, 160)]
    want: dict = {}
    for user, action, product, quantity, _, _ in events:
        if action == "empty":
            want = {k: q for k, q in want.items() if k[0] != str(user)}
        else:
            want[str(user), product] = want.get((str(user), product), 0) + quantity
    for n, step in enumerate((1, 7)):
        batches = [events[k::4] for k in range(4)] if step == 7 else [events[45:], events[:20] + events[50:], events[20:45]]
        got = _cart_batches(spark, f"{folder}/{n}", batches)
        assert got == {(*k, q) for k, q in want.items()}


def test_cart_state_holds_lines_and_not_the_history(spark, folder):
    """Adds behind the watermark are one sum per line, late ones are dropped, an empty still takes the sums."""
    rounds = [[(1, "add", "p", 1, 1000 * k + j, 1000 * k + j) for j in range(20)] for k in range(1, 6)]
    rounds.insert(4, [(1, "add", "p", 50, 1001, 7), (1, "empty", None, 0, 1002, 8)])  # far too late
    assert _cart_batches(spark, folder, rounds, late="10 seconds") == {("1", "p", 100)}
    state = spark.read.format("statestore").option("stateVarName", "lines").load(f"{folder}/checkpoint")
    held = state.selectExpr("sum(size(user_map_value.recent)) recent", "sum(user_map_value.settled) settled", "count(*) lines").first()
    assert held["recent"] <= 40 and held["settled"] + held["recent"] == 100 and held["lines"] <= cart_stream.SLICES
    assert _cart_batches(spark, folder, [[(1, "empty", None, 0, 6000, 9), (1, "add", "q", 2, 6001, 10)]], late="10 seconds") == {("1", "q", 2)}


def test_first_arrival_is_the_earliest_message(spark, folder):
    """By time, before partition and offset, over both topics."""
    at = lambda minute: datetime.datetime(2031, 5, 17, 6, minute)
    rows = [(None, json.dumps(order(items=[item("A", q)])), topic, part, offset, at(minute))
            for q, topic, part, offset, minute in ((9, "orders", 0, 5, 30), (1, "orders", 3, 70, 2), (4, "orders_retry", 0, 1, 10))]
    etl.process_batch(f"{folder}/order_items", lambda *_: None)(spark.createDataFrame(rows, MESSAGE), 0)
    assert [r["quantity"] for r in etl.read_order_items(spark, f"{folder}/order_items").collect()] == [1]


def test_metric_stream(spark, folder):
    rows = [(5, "dlq"), (6, "dlq"), (3600, "success"), (7200, "dlq")]
    spark.createDataFrame(rows, "t bigint, status string").select(F.timestamp_seconds("t").alias("ts"), "status").write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("ts timestamp, status string").parquet(f"{folder}/in")
    metrics.run(metrics.increase(stream, "dlq"), "parquet", f"{folder}/ck1", path=f"{folder}/out").awaitTermination()
    done = spark.read.parquet(f"{folder}/out")
    assert done.where("window_start < timestamp'1970-01-01 00:30:00'").agg(F.count("n"), F.max("n")).first() == (20, 2)


def test_cart_state_keys_do_not_grow_with_the_users(spark, folder):
    """Many users share a state key, and still none takes another's lines or empties."""
    users = 3 * cart_stream.GROUPS
    adds = [(user, "add", "p", user % 9 + 1, 100 + user, user) for user in range(users)]
    empties = [(user, "empty", None, 0, 5000, users + user) for user in range(0, users, 2)]
    assert _cart_batches(spark, folder, [adds, empties]) == {(str(u), "p", u % 9 + 1) for u in range(1, users, 2)}
    state = spark.read.format("statestore").option("stateVarName", "users").load(f"{folder}/checkpoint")
    assert state.select("key").distinct().count() <= cart_stream.GROUPS * cart_stream.SLICES


def test_cart_lines_of_a_null_user_are_one_cart(spark, folder):
    """A null user beside others in a batch leaves their ids and lines whole."""
    batches = [
        [(None, "add", "p", 2, 100, 1), (7, "add", "p", 3, 101, 2), (8, "add", None, 4, 102, 3), (None, "add", "q", 1, 103, 4)],
        [(None, "add", "p", 5, 110, 5), (8, "empty", None, 0, 111, 6), (7, "add", "q", 1, 112, 7)],
    ]
    assert _cart_batches(spark, folder, batches) == {(None, "p", 7), (None, "q", 1), ("7", "p", 3), ("7", "q", 1)}
