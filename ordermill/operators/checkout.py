"""Prices of carts and orders: enrichment, totals, shipping quotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions import fx, money

# The flat quote.
QUOTE_UNITS, QUOTE_NANOS, QUOTE_CURRENCY = 8, 990_000_000, "USD"


def quote(rows: DataFrame, *by: str) -> DataFrame:
    """Shipping cost from the total quantity: nothing for 0, else the flat price."""
    counted = rows.groupBy(*by).agg(
        F.coalesce(F.sum("quantity"), F.lit(0)).cast("bigint").alias("quantity")
    )
    some = F.col("quantity") != 0
    return counted.select(
        *by,
        "quantity",
        F.lit(QUOTE_CURRENCY).alias("currency_code"),
        F.when(some, F.lit(QUOTE_UNITS)).otherwise(F.lit(0)).cast("bigint").alias("units"),
        F.when(some, F.lit(QUOTE_NANOS)).otherwise(F.lit(0)).cast("int").alias("nanos"),
    )


def order_total(items: DataFrame) -> DataFrame:
    """Shipping plus the sum of cost x quantity, per order.

    ``items``: order_id, currency_code, amount (decimal cost x quantity or NULL
    for an order without items), shipping (decimal). Folded map-side; an order
    that mixes currencies gets an error instead of a sum.
    """
    folded = items.groupBy("order_id").agg(
        F.min("currency_code").alias("currency_code"),
        F.max("currency_code").alias("_other"),
        (
            F.coalesce(F.sum("amount"), F.lit(0)).cast(money.ADDEND)
            + F.max("shipping").cast(money.ADDEND)
        ).cast(money.TOTAL).alias("total"),
    )
    one_currency = F.col("currency_code") == F.col("_other")
    return folded.select(
        "order_id",
        "currency_code",
        F.when(one_currency, money.units_of(F.col("total"))).alias("units"),
        F.when(one_currency, money.nanos_of(F.col("total"))).alias("nanos"),
        F.when(~one_currency, F.lit(money.ERR_CURRENCY)).alias("error"),
    )


def price_lines(lines: DataFrame, products: DataFrame, currency: Column) -> DataFrame:
    """Cart lines with the product's price in the buyer's currency.

    ``error`` says why a line cannot be priced; its cart must then be refused.
    Catalyst picks the join: a small catalogue is broadcast by its size.
    """
    priced = lines.join(
        products.select(
            F.col("id").alias("product_id"),
            F.struct(
                "currency_code",
                F.col("price_units").alias("units"),
                F.col("price_nanos").cast("bigint").alias("nanos"),
            ).alias("price"),
        ),
        "product_id",
        "left",
    )
    converted = fx.with_converted(priced, F.col("price"), currency, "cost")
    return converted.withColumn(
        "error",
        F.when(
            F.col("price").isNull(),
            F.concat(F.lit('failed to get product #"'), F.col("product_id"), F.lit('"')),
        ).when(
            F.col("cost").isNull(),
            F.concat(F.lit('failed to convert price of "'), F.col("product_id"), F.lit('"')),
        ),
    ).withColumn(
        "amount",
        money.times(money.amount(F.col("cost.units"), F.col("cost.nanos")), F.col("quantity")),
    )


def cart_totals(priced: DataFrame) -> DataFrame:
    """Size and total of each cart, shipping not included; one unpriced line
    fails the cart."""
    folded = priced.groupBy("user_id").agg(
        F.sum("quantity").cast("bigint").alias("cart_size"),
        F.count(F.lit(1)).alias("lines"),
        F.max("cost.currency_code").alias("currency_code"),
        F.sum("amount").cast(money.TOTAL).alias("total"),
        F.min("error").alias("error"),
    )
    good = F.col("error").isNull()
    return folded.select(
        "user_id",
        "cart_size",
        "lines",
        "currency_code",
        F.when(good, money.units_of(F.col("total"))).alias("units"),
        F.when(good, money.nanos_of(F.col("total"))).alias("nanos"),
        "error",
    )
