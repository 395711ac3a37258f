"""Order event text <-> columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions import money
from ordermill.schemas import CORRUPT, ORDER_EVENT


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _number(c: Column) -> Column:
    return F.coalesce(c, F.lit(0).cast("bigint"))


def _money(c: Column) -> Column:
    return F.struct(
        _text(c["currency_code"]).alias("currency_code"),
        _number(c["units"]).alias("units"),
        _number(c["nanos"]).alias("nanos"),
    )


def unwrap(value: Column) -> tuple[Column, Column]:
    """(message text, attempt) of a bare message or a retry envelope.

    The envelope is only parsed where the text can hold one.
    """
    envelope = F.when(
        value.contains('"original"'),
        F.from_json(value, "original string, attempt int"),
    )
    wrapped = envelope["original"].isNotNull()
    return (
        F.when(wrapped, envelope["original"]).otherwise(value),
        F.when(wrapped, F.coalesce(envelope["attempt"], F.lit(0))).otherwise(F.lit(0)),
    )


def parse_event(body: Column) -> Column:
    """Parse a message once, with the fixed schema; nothing else reads the text."""
    return F.from_json(body, ORDER_EVENT, {"columnNameOfCorruptRecord": CORRUPT})


def defaults(event: Column) -> dict[str, Column]:
    """Order columns; absent fields read as ``""``, ``0`` or ``[]`` and every
    order that parses succeeded."""
    address = event["shipping_address"]
    items = F.transform(
        F.coalesce(event["items"], F.array()),
        lambda i: F.struct(
            _text(i["item"]["product_id"]).alias("product_id"),
            _number(i["item"]["quantity"]).alias("quantity"),
            _money(i["cost"]).alias("cost"),
        ),
    )
    return {
        "order_id": _text(event["order_id"]),
        "shipping_tracking_id": _text(event["shipping_tracking_id"]),
        "shipping_cost": _money(event["shipping_cost"]),
        "shipping_address": F.struct(
            *(_text(address[f]).alias(f) for f in ("street_address", "city", "state", "country")),
            _number(address["zip_code"]).alias("zip_code"),
        ),
        "items": items,
        "timestamp": _text(event["timestamp"]),
        "status": F.lit("SUCCEED"),
        "malformed": event.isNull() | event[CORRUPT].isNotNull(),
    }


def to_event_json(order_id: Column, tracking_id: Column, shipping_cost: Column,
                  address: Column, items: Column, timestamp: Column) -> Column:
    """Event text as the shop publishes it: numeric zeros are left out."""

    def thin(m: Column) -> Column:
        return F.struct(
            m["currency_code"].alias("currency_code"),
            F.nullif(m["units"], F.lit(0)).alias("units"),
            F.nullif(m["nanos"], F.lit(0)).alias("nanos"),
        )

    thin_items = F.transform(
        items,
        lambda i: F.struct(
            F.struct(
                i["product_id"].alias("product_id"),
                F.nullif(i["quantity"], F.lit(0)).alias("quantity"),
            ).alias("item"),
            thin(i["cost"]).alias("cost"),
        ),
    )
    return F.to_json(
        F.struct(
            order_id.alias("order_id"),
            tracking_id.alias("shipping_tracking_id"),
            thin(shipping_cost).alias("shipping_cost"),
            address.alias("shipping_address"),
            thin_items.alias("items"),
            timestamp.alias("timestamp"),
        )
    )


def publish(orders: DataFrame) -> DataFrame:
    """Broker rows ``(key, value)`` for a DataFrame shaped like :func:`defaults`."""
    return orders.select(
        F.col("order_id").alias("key"),
        to_event_json(
            F.col("order_id"),
            F.col("shipping_tracking_id"),
            F.col("shipping_cost"),
            F.col("shipping_address"),
            F.col("items"),
            F.col("timestamp"),
        ).alias("value"),
    )


def envelope(body: Column, error: Column, attempt: Column, now: Column, malformed: Column) -> Column:
    """Retry / dead-letter text. The message is embedded as is, not re-encoded;
    text that is no JSON is embedded as a JSON string."""
    rest = F.to_json(
        F.struct(
            error.alias("error"),
            attempt.alias("attempt"),
            F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"),
        )
    )
    quoted = F.to_json(F.struct(body.alias("original")))
    return F.concat(
        F.when(malformed, F.regexp_replace(quoted, r"\}$", ""))
        .otherwise(F.concat(F.lit('{"original":'), body)),
        F.lit(","),
        F.substring(rest, 2, 2_147_483_647),
    )


def item_text(row_prefix: str = "") -> Column:
    """One readable line per flattened item."""
    c = lambda name: F.col(row_prefix + name)
    return F.format_string(
        "Transformed: order_id=%s product_id=%s quantity=%d currency=%s "
        "unit_price=%s total_price=%s event_timestamp=%s status=%s",
        c("order_id"),
        c("product_id"),
        c("quantity"),
        c("currency_code"),
        c("unit_price").cast("string"),
        c("total_price").cast("string"),
        c("event_timestamp").cast("string"),
        c("status"),
    )


def flat_item(item: Column) -> dict[str, Column]:
    """Columns of one exploded item; price from units and nanos, unrounded."""
    unit_price = money.amount(item["cost"]["units"], item["cost"]["nanos"])
    return {
        "product_id": item["product_id"],
        "quantity": item["quantity"].cast("int"),
        "currency_code": item["cost"]["currency_code"],
        "unit_price": unit_price,
    }
