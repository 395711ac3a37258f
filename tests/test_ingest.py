"""Parsing, defaults, validation, constraints and routing of order events."""

import json

from pyspark.sql import functions as F

from ordermill.functions import orders
from ordermill.operators import ingest
from ordermill.plans import models


def order(**changes):
    base = {
        "order_id": "o-1",
        "shipping_tracking_id": "t-1",
        "shipping_cost": {"currency_code": "EUR", "units": 3, "nanos": 250000000},
        "shipping_address": {"street_address": "Quay 7", "city": "Oulu", "state": "NO", "country": "Finland", "zip_code": 90100},
        "items": [
            {
                "item": {"product_id": "KETTLE", "quantity": 7},
                "cost": {"currency_code": "EUR", "units": 41, "nanos": 130000000},
            }
        ],
        "timestamp": "2031-05-17T06:45:00Z",
    }
    base.update(changes)
    return {k: v for k, v in base.items() if v is not ...}


def item(product="MUG", quantity=1, units=1, nanos=0, currency="USD"):
    return {
        "item": {"product_id": product, "quantity": quantity},
        "cost": {"currency_code": currency, "units": units, "nanos": nanos},
    }


def routed(spark, messages, transient=None, **options):
    rows = [(i, m if isinstance(m, str) else json.dumps(m)) for i, m in enumerate(messages)]
    frame = spark.createDataFrame(rows, "id int, value string")
    return ingest.outcome(frame, transient, **options)


def result(spark, messages, *args, **options):
    rows = routed(spark, messages, *args, **options).orderBy("id").collect()
    return [(r["route"], r["status"], r["error"], r["out_attempt"]) for r in rows]


def test_omitted_fields_read_as_defaults(spark):
    text = '{"order_id":"a","items":[{"item":{"product_id":"p"},"cost":{"currency_code":"USD","units":-1}}]}'
    row = ingest.parse(spark.createDataFrame([(text,), ("{}",)], "value string")).select("event.*").collect()
    first, empty = row
    assert first["items"][0]["quantity"] == 0
    assert first["items"][0]["cost"].asDict() == {"currency_code": "USD", "units": -1, "nanos": 0}
    assert first["shipping_address"]["zip_code"] == 0 and first["shipping_cost"]["units"] == 0
    assert empty["order_id"] == "" and empty["items"] == [] and empty["timestamp"] == ""
    assert empty["status"] == "SUCCEED" and not empty["malformed"]


def test_flatten_is_exact(spark):
    rows = ingest.flatten(routed(spark, [order()])).collect()
    assert len(rows) == 1
    assert str(rows[0]["unit_price"]) == "41.130000000"
    assert str(rows[0]["total_price"]) == "287.910000000"


def test_first_failure_wins_in_order(spark):
    got = result(
        spark,
        [
            order(order_id=..., items=[], timestamp=""),
            order(items=[], timestamp=""),
            order(timestamp="", items=[item(product="")]),
            order(items=[item(), item(product="")]),
            order(),
        ],
    )
    assert [g[2] for g in got] == [
        "InvalidOrder: Missing order_id",
        "InvalidOrder: Order o-1 has no items",
        "InvalidOrder: Order o-1 is missing timestamp",
        "InvalidOrder: Order o-1 has item with missing product_id",
        None,
    ]
    assert [g[0] for g in got] == ["dlq"] * 4 + ["ok"]


def test_constraints_refuse_the_whole_order(spark):
    got = result(
        spark,
        [
            order(items=[item(), item(units=10**12)]),
            order(items=[item(product="P" * 300)]),
            order(timestamp="2026-13-40T99:99:99Z"),
            order(items=[item(quantity=3_000_000_000)]),
            order(items=[item(units=9_000_000_000, quantity=2)]),
            order(items=[item(units=9_999_999_999, nanos=994_000_000)]),
            order(items=[item(units=9_999_999_999, nanos=995_000_000)]),
            order(items=[item(currency="ABCDEFGHIJK")]),
            order(order_id="o" * 256),
        ],
    )
    assert [g[1] for g in got] == [
        "non_retryable", "non_retryable", "unexpected", "non_retryable", "non_retryable",
        "success", "non_retryable", "non_retryable", "non_retryable",
    ]


def test_malformed_text_goes_to_the_dead_letters(spark):
    got = result(spark, ["not json", '{"order_id": {"x": 1}, "items": 3}'])
    assert [g[0] for g in got] == ["dlq", "dlq"]
    assert got[0][2] == "Unexpected: malformed JSON"


def test_retry_attempts(spark):
    wrap = lambda attempt: {"original": order(), "error": "e", "attempt": attempt, "timestamp": "t"}
    away = F.lit(True)
    got = result(spark, [order(), wrap(1), wrap(2), wrap(3)], away)
    assert [(g[0], g[3]) for g in got] == [("retry", 1), ("retry", 2), ("retry", 3), ("dlq", 3)]
    assert result(spark, [wrap(0), wrap(1)], away, max_attempt=1)[0][0] == "retry"
    assert result(spark, [wrap(0), wrap(1)], away, max_attempt=1)[1][0] == "dlq"
    # An invalid order is never retried, and no writer means the message is dropped.
    assert result(spark, [order(order_id="")], away)[0][0] == "dlq"
    assert result(spark, [order()], away, has_retry=False)[0][0] == "dropped"


VARIANTS = {
    "valid": (order(), "ok"),
    "missing_order_id": (order(order_id=""), "dlq"),
    "missing_items": (order(items=[]), "dlq"),
    "missing_timestamp": (order(timestamp=""), "dlq"),
    "missing_product_id": (order(items=[item(product="")]), "dlq"),
    "numeric_overflow": (order(items=[item(units=10**12)]), "dlq"),
    "string_too_long": (order(items=[item(product="P" * 300)]), "dlq"),
    "bad_timestamp": (order(timestamp="2026-13-40T99:99:99Z"), "dlq"),
}


def test_traffic_variants(spark):
    plain = [m for m, _ in VARIANTS.values()]
    wrapped = [{"original": m, "error": "simulated", "attempt": 1, "timestamp": "t"} for m in plain]
    want = [route for _, route in VARIANTS.values()]
    assert [g[0] for g in result(spark, plain + wrapped)] == want * 2


def test_letters_can_be_read_again(spark):
    away = F.col("id") == 2
    messages = routed(spark, [order(order_id=""), 'broken "text', order()], away)
    now = F.lit("2026-01-01 00:00:00").cast("timestamp")
    dead = ingest.dead_letters(messages, now).collect()
    retry = ingest.retries(messages, now).collect()
    assert len(dead) == 2 and len(retry) == 1
    document = json.loads(retry[0]["value"])
    assert document["original"] == order() and document["attempt"] == 1
    assert retry[0]["key"] == "o-1"
    assert [(h["key"], bytes(h["value"])) for h in retry[0]["headers"]] == [("x-retry-count", b"1")]
    broken = [json.loads(d["value"]) for d in dead]
    assert 'broken "text' in [b["original"] for b in broken]
    again = ingest.parse(spark.createDataFrame(retry).select("value")).first()
    assert again["attempt"] == 1 and again["event"]["order_id"] == "o-1"


def test_event_text_round_trip_omits_zeros(spark):
    parsed = ingest.parse(spark.createDataFrame([(json.dumps(order(items=[item(nanos=0)])),)], "value string"))
    published = orders.publish(parsed.select("event.*")).first()
    assert published["key"] == "o-1"
    cost = json.loads(published["value"])["items"][0]["cost"]
    assert cost == {"currency_code": "USD", "units": 1}


def test_item_text(spark):
    rows = ingest.order_item_rows(ingest.flatten(routed(spark, [order()])))
    text = rows.select(orders.item_text()).first()[0]
    assert text.startswith("Transformed: order_id=o-1 product_id=KETTLE quantity=7 currency=EUR unit_price=41.13 total_price=287.91")


def test_first_arrival_wins_and_rounding(spark):
    landed = [
        (json.dumps(order(items=[item("A", 3, 0, 5_000_000), item("A", 9)])), "2026-10-11 10:02:00", 1, 7),
        (json.dumps(order(items=[item("A", 5), item("B", 2, 1, 4_900_000)])), "2026-10-11 10:01:00", 1, 9),
        (json.dumps(order(order_id="")), "2026-10-11 10:00:00", 1, 1),
    ]
    bronze = spark.createDataFrame(landed, "raw string, at string, _kafka_partition int, _kafka_offset bigint")
    bronze = bronze.select(
        "raw", F.col("at").cast("timestamp").alias("_ingested_at"),
        F.lit("2026-10-11").cast("date").alias("_event_date"), "_kafka_partition", "_kafka_offset",
    )
    silver = models.silver_items(bronze)
    gold = {r["product_id"]: r for r in models.gold_fact(silver).collect()}
    assert set(gold) == {"A", "B"}
    assert gold["A"]["quantity"] == 5
    # 2 x 1.0049 = 2.0098 rounds to 2.01 although the shown price is 1.00
    assert (str(gold["B"]["unit_price"]), str(gold["B"]["total_price"])) == ("1.00", "2.01")
    assert models.quarantine(bronze).count() == 1
