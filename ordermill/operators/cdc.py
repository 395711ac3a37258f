"""Change events: topic routing, unwrapping, and matching of inserted rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.steps import computed_once

# Source topic pattern -> published topic.
ROUTES = {
    r"dbserver1\.public\.products": "cdc_product_changes",
    r"orderdb\.analytics\.order_items": "cdc_order_items",
}

# Type names that wrap a nullable value as {"<type>": value}.
WRAPPERS = ("string", "int", "long", "boolean", "float", "double", "bytes")


def route_topic(topic: Column, routes: Mapping[str, str] = ROUTES) -> Column:
    """Published topic; a topic matches a pattern as a whole or stays as it is."""
    for pattern, target in routes.items():
        topic = F.regexp_replace(topic, f"^(?:{pattern})$", target)
    return topic


def unwrap(text: Column) -> Column:
    """Plain text of a field: ``{"string": "x"}`` and ``x`` both give ``x``."""
    wrapped = F.from_json(text, "map<string,string>")
    key = F.element_at(F.map_keys(wrapped), 1)
    return F.when(
        text.startswith("{") & (F.size(wrapped) == 1) & key.isin(*WRAPPERS),
        F.element_at(F.map_values(wrapped), 1),
    ).otherwise(text)


def row_image(after: Column) -> Column:
    """Field map of a row image, with or without its type name around it."""
    outer = F.from_json(after, "map<string,string>")
    only = F.element_at(F.map_values(outer), 1)
    inner = F.when(
        (F.size(outer) == 1) & only.startswith("{"), F.from_json(only, "map<string,string>")
    )
    return F.coalesce(inner, outer)


def changes(messages: DataFrame, op: str = "c") -> DataFrame:
    """Events of one kind with their row image as a map of text fields.

    Text that is no JSON has no ``op`` and drops out.
    """
    envelope = F.from_json("value", "op string, before string, after string, source string")
    return (
        computed_once(messages, {"_e": envelope})
        .where(F.col("_e.op") == op)
        .select(
            route_topic(F.col("topic")).alias("topic"),
            "key",
            row_image(F.col("_e.after")).alias("fields"),
        )
    )


def fields(changed: DataFrame, names: Sequence[str]) -> DataFrame:
    """Named fields of the row images, as text."""
    flat = computed_once(changed, {"_f": F.col("fields")})
    return flat.select(
        "topic", "key", *(unwrap(F.try_element_at(F.col("_f"), F.lit(n))).alias(n) for n in names)
    )


def captured(probes: DataFrame, inserted: DataFrame, names: Sequence[str]) -> DataFrame:
    """Probe rows that some insert event shows with equal values, compared as text."""
    events = inserted.select(*(F.col(n).alias(f"_e_{n}") for n in names))
    same = [F.col(n).cast("string").eqNullSafe(F.col(f"_e_{n}")) for n in names]
    condition = same[0]
    for part in same[1:]:
        condition = condition & part
    return probes.join(events, condition, "left_semi")
