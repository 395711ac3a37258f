"""Product catalogue: list, search, lookup, and the flat export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE = 20


def with_categories(products: DataFrame, bridge: DataFrame) -> DataFrame:
    """Adds ``categories``: sorted, comma separated, ``''`` when there are none.

    ``bridge`` has (product_id, category); a product has a handful of them.
    """
    joined = (
        bridge.groupBy(F.col("product_id").alias("id"))
        .agg(F.array_join(F.array_sort(F.collect_set("category")), ",").alias("categories"))
    )
    return products.join(joined, "id", "left").withColumn(
        "categories", F.coalesce("categories", F.lit(""))
    )


def named_bridge(bridge: DataFrame, categories: DataFrame) -> DataFrame:
    """(product_id, category_id) with the category's name resolved."""
    return bridge.join(
        categories.select(F.col("id").alias("category_id"), F.col("name").alias("category")),
        "category_id",
    ).select("product_id", "category")


def _categories_of(products: DataFrame, bridge: DataFrame) -> DataFrame:
    """The same, for a few products: only their bridge rows are folded."""
    wanted = bridge.join(products.select(F.col("id").alias("product_id")), "product_id", "left_semi")
    return with_categories(products, wanted)


def page(products: DataFrame, bridge: DataFrame, number: int = 1, size: int = PAGE) -> DataFrame:
    """One page by id plus a look-ahead row; categories are joined to the page only."""
    number = number if number > 0 else 1
    rows = products.orderBy("id").offset((number - 1) * size).limit(size + 1)
    return _categories_of(rows, bridge)


def has_next(rows: DataFrame, size: int = PAGE) -> DataFrame:
    return rows.agg((F.count(F.lit(1)) > size).alias("has_next"))


def matches(query: str, literal: bool = False) -> Column:
    """Name or description holds the query, ignoring case.

    ``%`` and ``_`` in the query act as wildcards unless ``literal``.
    """
    text = query.lower()
    if literal:
        return F.lower("name").contains(text) | F.lower("description").contains(text)
    pattern = f"%{text}%"
    return F.lower("name").like(pattern) | F.lower("description").like(pattern)


def search(products: DataFrame, bridge: DataFrame, query: str, literal: bool = False) -> DataFrame:
    return with_categories(products.where(matches(query, literal)), bridge)


def get(products: DataFrame, bridge: DataFrame, product_id: str) -> DataFrame:
    """One product; no row when the id is unknown. The id predicate reaches the scan."""
    return _categories_of(products.where(F.col("id") == product_id), bridge)


def lookup(requests: DataFrame, products: DataFrame) -> DataFrame:
    """Many lookups at once: requested ids (column ``product_id``) with the product
    and whether it was found. Requests are folded per id before they are joined."""
    asked = requests.groupBy("product_id").agg(F.count(F.lit(1)).alias("requests"))
    found = products.withColumnRenamed("id", "product_id").withColumn("found", F.lit(True))
    return asked.join(found, "product_id", "left").withColumn(
        "found", F.coalesce("found", F.lit(False))
    )


def vector_export(feed: DataFrame) -> DataFrame:
    """Product documents as flat rows for the vector table: price split out,
    single quotes removed, categories joined by commas."""
    return feed.select(
        "id",
        F.replace("name", F.lit("'"), F.lit("")).alias("name"),
        F.replace("description", F.lit("'"), F.lit("")).alias("description"),
        "picture",
        F.col("priceUsd.currencyCode").alias("price_usd_currency_code"),
        F.col("priceUsd.units").alias("price_usd_units"),
        F.col("priceUsd.nanos").alias("price_usd_nanos"),
        F.array_join("categories", ",").alias("categories"),
    )
