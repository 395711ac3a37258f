"""Business questions on the gold fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions import fx, money

REVENUE = "decimal(18,2)"
HOURS_SHOWN = 168
ROWS_SHOWN = 20


def paid(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("status") == "SUCCEED")


def revenue_by_hour(fact: DataFrame) -> DataFrame:
    """Revenue, units and distinct orders per hour.

    Folded per (hour, order) first, so the distinct count needs no second copy of
    the rows and a busy hour is spread over its orders.
    """
    per_order = (
        paid(fact)
        .groupBy(F.date_trunc("hour", "event_timestamp").alias("event_hour"), "order_id")
        .agg(F.sum("total_price").alias("revenue"), F.sum("quantity").alias("units"))
    )
    return per_order.groupBy("event_hour").agg(
        F.sum("revenue").cast(REVENUE).alias("revenue"),
        F.sum("units").cast("bigint").alias("units"),
        F.count("order_id").alias("orders"),
    )


def newest_hours(by_hour: DataFrame, hours: int = HOURS_SHOWN) -> DataFrame:
    return by_hour.orderBy(F.desc("event_hour")).limit(hours)


def product_sales(fact: DataFrame) -> DataFrame:
    """Units, revenue and distinct orders per product.

    Folded per (product, order) first: right also while the fact holds copies, and a
    product in very many orders is spread over them.
    """
    per_order = (
        paid(fact)
        .groupBy("product_id", "order_id")
        .agg(F.sum("quantity").alias("units"), F.sum("total_price").alias("revenue"))
    )
    return per_order.groupBy("product_id").agg(
        F.sum("units").cast("bigint").alias("units_sold"),
        F.sum("revenue").cast(REVENUE).alias("revenue"),
        F.count("order_id").alias("orders"),
    )


def top_products(sales: DataFrame, rows: int = ROWS_SHOWN) -> DataFrame:
    return sales.orderBy(F.desc("units_sold"), "product_id").limit(rows)


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    return snapshots.agg(F.max("snapshot_ts").alias("snapshot_ts"))


def cart_units(snapshots: DataFrame) -> DataFrame:
    """Units and carts per product in the newest snapshot."""
    newest = F.broadcast(latest_snapshot(snapshots))  # exactly one row
    return (
        snapshots.join(newest, "snapshot_ts", "left_semi")
        .groupBy("product_id")
        .agg(
            F.sum("units_in_cart").cast("bigint").alias("cart_units"),
            F.sum("carts_with_product").cast("bigint").alias("carts"),
        )
    )


def cart_not_paid(snapshots: DataFrame, fact: DataFrame) -> DataFrame:
    """Share of a product's units that sit in open carts."""
    sold = product_sales(fact).select(
        "product_id", F.col("units_sold").alias("paid_units"), F.col("revenue").alias("paid_revenue")
    )
    zero = lambda name: F.coalesce(F.col(name), F.lit(0).cast("bigint"))
    both = cart_units(snapshots).join(sold, "product_id", "full_outer")
    return both.select(
        "product_id",
        zero("cart_units").alias("cart_units"),
        zero("carts").alias("carts"),
        zero("paid_units").alias("paid_units"),
    ).withColumn(
        "cart_not_paid_rate",
        F.col("cart_units").cast("double") / F.nullif(F.col("cart_units") + F.col("paid_units"), F.lit(0)),
    )


def highest_rate(rates: DataFrame, rows: int = ROWS_SHOWN) -> DataFrame:
    return rates.orderBy(F.desc_nulls_last("cart_not_paid_rate"), "product_id").limit(rows)


def revenue_in(fact: DataFrame, currency: str = "USD") -> DataFrame:
    """Revenue per hour after converting each item's total to one currency."""
    total = money.to_money(F.col("total_price").cast(money.TOTAL), F.col("currency_code"))
    converted = fx.with_converted(paid(fact), total, F.lit(currency), "converted")
    amount = money.amount(F.col("converted.units"), F.col("converted.nanos"))
    return converted.groupBy(
        F.date_trunc("hour", "event_timestamp").alias("event_hour")
    ).agg(F.sum(amount).cast(REVENUE).alias("revenue"))
