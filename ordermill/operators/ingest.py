"""Order events to accepted rows, retries and dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions import money, orders
from ordermill.functions.steps import computed_once
from ordermill.functions.timestamps import parse_timestamp

RETRY_MAX_ATTEMPT = 3
INT_MAX = 2_147_483_647

# Column limits of the order_items table.
MAX_ORDER_ID = 255
MAX_PRODUCT_ID = 255
MAX_CURRENCY = 10
PRICE = "decimal(12,2)"
PRICE_LIMIT = "9999999999.995BD"


def parse(messages: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``body`` (message text), ``attempt`` and the parsed ``event``.

    The text is parsed exactly once; later filters work on the parsed columns.
    """
    body, attempt = orders.unwrap(F.col(value))
    parsed = messages.withColumns({"body": body, "attempt": attempt}).withColumn(
        "_parsed", orders.parse_event(F.col("body"))
    )
    fields = [c.alias(n) for n, c in orders.defaults(F.col("_parsed")).items()]
    return computed_once(parsed, {"event": F.struct(*fields)}).drop("_parsed")


def _first_failure(event: Column) -> Column:
    """Missing fields, in the order they are looked at."""
    order_id = event["order_id"]
    about = lambda text: F.concat(F.lit("InvalidOrder: Order "), order_id, F.lit(text))
    return (
        F.when(order_id == "", F.lit("InvalidOrder: Missing order_id"))
        .when(F.size(event["items"]) == 0, about(" has no items"))
        .when(event["timestamp"] == "", about(" is missing timestamp"))
        .when(
            F.exists(event["items"], lambda i: i["product_id"] == ""),
            about(" has item with missing product_id"),
        )
    )


def _item_overflows(item: Column) -> Column:
    price = item["cost"]["units"].cast("decimal(19,0)") + (
        item["cost"]["nanos"].cast("decimal(19,0)") * F.expr("0.000000001BD")
    )
    limit = F.expr(PRICE_LIMIT)
    # Units and quantity are bounded before they are multiplied, so the product
    # itself cannot overflow under ANSI rules.
    return (
        (F.abs(price) >= limit)
        | ~item["quantity"].between(-INT_MAX - 1, INT_MAX)
        | (F.abs(price.cast("double") * item["quantity"].cast("double")) >= 9_999_999_999.995)
    )


def _constraint_failure(event: Column) -> Column:
    """What the target table would refuse. One bad item refuses the whole order."""
    items = event["items"]
    too_long = (F.length(event["order_id"]) > MAX_ORDER_ID) | F.exists(
        items,
        lambda i: (F.length(i["product_id"]) > MAX_PRODUCT_ID)
        | (F.length(i["cost"]["currency_code"]) > MAX_CURRENCY),
    )
    return (
        F.when(
            parse_timestamp(event["timestamp"]).isNull(),
            F.lit("Unexpected: timestamp is not ISO-8601"),
        )
        .when(too_long, F.lit("NonRetryable DB: value too long"))
        .when(
            F.exists(items, _item_overflows),
            F.lit("NonRetryable DB: numeric field overflow"),
        )
    )


def classify(parsed: DataFrame, transient: Column | None = None) -> DataFrame:
    """Adds ``error`` and ``status`` per message.

    ``transient`` marks messages whose write failed for a reason outside the
    message (the target was away); they are retried while attempts remain.
    """
    event = F.col("event")
    broken = F.when(event["malformed"], F.lit("Unexpected: malformed JSON"))
    invalid = _first_failure(event)
    refused = _constraint_failure(event)
    away = F.lit(False) if transient is None else F.coalesce(transient, F.lit(False))
    error = F.coalesce(
        broken, invalid, refused, F.when(away, F.lit("Retryable DB: target not available"))
    )
    return (
        parsed.withColumn("error", error)
        .withColumn(
            "status",
            F.when(F.col("error").isNull(), "success")
            .when(F.col("error").startswith("InvalidOrder"), "invalid")
            .when(F.col("error").startswith("NonRetryable"), "non_retryable")
            .when(F.col("error").startswith("Unexpected"), "unexpected")
            .otherwise("retryable"),
        )
    )


def route(classified: DataFrame, max_attempt: int = RETRY_MAX_ATTEMPT,
          has_retry: bool = True, has_dlq: bool = True) -> DataFrame:
    """Adds ``route`` and the attempt number the outgoing envelope carries."""
    attempts_left = F.col("attempt") < max_attempt
    retryable = F.col("status") == "retryable"
    dead = F.lit("dlq" if has_dlq else "dropped")
    target = (
        F.when(F.col("status") == "success", F.lit("ok"))
        .when(retryable & attempts_left, F.lit("retry" if has_retry else "dropped"))
        .otherwise(dead)
    )
    return (
        classified.withColumn("route", target)
        .withColumn("out_attempt", F.col("attempt") + (F.col("route") == "retry").cast("int"))
        .withColumn("status", F.when(retryable, F.col("route")).otherwise(F.col("status")))
    )


def outcome(messages: DataFrame, transient: Column | None = None, **options) -> DataFrame:
    return route(classify(parse(messages), transient), **options)


def flatten(accepted: DataFrame, *keep: str) -> DataFrame:
    """One row per order item; ``keep`` names message columns to carry along."""
    return (
        accepted.select(
            F.col("event.order_id").alias("order_id"),
            parse_timestamp(F.col("event.timestamp")).alias("event_timestamp"),
            F.col("event.status").alias("status"),
            *keep,
            F.posexplode("event.items").alias("item_pos", "item"),
        )
        .withColumns(orders.flat_item(F.col("item")))
        .withColumn("total_price", money.line_total(F.col("unit_price"), F.col("quantity")))
        .drop("item")
    )


def order_item_rows(flat: DataFrame) -> DataFrame:
    """The row shape of the order_items table, prices rounded to cents."""
    return flat.select(
        "order_id",
        "product_id",
        "quantity",
        "currency_code",
        F.col("unit_price").cast(PRICE).alias("unit_price"),
        F.col("total_price").cast(PRICE).alias("total_price"),
        "event_timestamp",
        "status",
        F.to_date("event_timestamp").alias("event_date"),
    )


def dead_letters(routed: DataFrame, now: Column | None = None) -> DataFrame:
    """Broker rows for the dead-letter topic."""
    return _letters(routed.where(F.col("route") == "dlq"), now)


def retries(routed: DataFrame, now: Column | None = None) -> DataFrame:
    """Broker rows for the retry topic, with the attempt count as a header too."""
    header = F.array(
        F.struct(
            F.lit("x-retry-count").alias("key"),
            F.col("out_attempt").cast("string").cast("binary").alias("value"),
        )
    )
    return _letters(
        routed.where(F.col("route") == "retry").withColumn("headers", header), now, "headers"
    )


def _letters(rows: DataFrame, now: Column | None, *extra: str) -> DataFrame:
    now = F.current_timestamp() if now is None else now
    return rows.select(
        F.nullif(F.col("event.order_id"), F.lit("")).alias("key"),
        orders.envelope(
            F.col("body"), F.col("error"), F.col("out_attempt"), now, F.col("event.malformed")
        ).alias("value"),
        *extra,
    )


def count_outcomes(routed: DataFrame, *by: str) -> DataFrame:
    """Processed messages by status."""
    return routed.groupBy(*by, "status").agg(F.count(F.lit(1)).alias("n"))
