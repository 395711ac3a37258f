"""Product feeds: parse, and upsert into products, categories and the bridge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.money import from_price_text
from ordermill.operators.dedupe import absent_from, first_by

PRODUCT_COLUMNS = (
    "id", "name", "description", "picture_url", "price_units", "price_nanos", "currency_code",
)


def image_path(url: Column, product_id: Column) -> Column:
    """``/images/<file>`` of a remote picture; other values stay as they are."""
    file = F.substring_index(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), "/", -1)
    named = F.when(file == "", F.concat(F.lit("img_"), product_id, F.lit(".jpg"))).otherwise(file)
    return F.when(url.startswith("http"), F.concat(F.lit("/images/"), named)).otherwise(url)


def from_json_feed(products: DataFrame) -> DataFrame:
    """Rows of the product document in table shape, with their category names."""
    return products.select(
        "id",
        "name",
        "description",
        F.concat(F.lit("/images/"), F.substring_index("picture", "/", -1)).alias("picture_url"),
        F.coalesce("priceUsd.units", F.lit(0)).cast("bigint").alias("price_units"),
        F.coalesce("priceUsd.nanos", F.lit(0)).cast("int").alias("price_nanos"),
        F.coalesce("priceUsd.currencyCode", F.lit("USD")).alias("currency_code"),
        F.coalesce("categories", F.array().cast("array<string>")).alias("categories"),
    )


def from_csv_feed(rows: DataFrame) -> DataFrame:
    """CSV feed rows in table shape: first image, price text, ``a > b`` categories.

    ``-`` means a missing value; rows without an id are skipped.
    """
    first_image = F.trim(F.element_at(F.split(F.coalesce("imageUrls", F.lit("")), ","), 1))
    image = F.when(F.coalesce("imageUrls", F.lit("")).isin("", "-"), "").otherwise(
        image_path(first_image, F.col("_id"))
    )
    units, nanos = from_price_text(F.coalesce("price", F.lit("0")))
    category = F.coalesce("category", F.lit(""))
    categories = F.when(category == "-", F.array().cast("array<string>")).otherwise(
        F.filter(F.transform(F.split(category, ">"), lambda c: F.trim(c)), lambda c: c != "")
    )
    return rows.where(F.coalesce("_id", F.lit("")) != "").select(
        F.col("_id").alias("id"),
        F.coalesce("title", F.lit("Unknown Product")).alias("name"),
        F.coalesce("description", F.lit("")).alias("description"),
        image.alias("picture_url"),
        units.alias("price_units"),
        nanos.cast("int").alias("price_nanos"),
        F.lit("USD").alias("currency_code"),
        categories.alias("categories"),
    )


def upsert_products(stored: DataFrame, incoming: DataFrame, keep_currency: bool) -> DataFrame:
    """Insert or replace by id. A CSV feed keeps the stored currency of known ids.

    Of feed rows with the same id the last one counts, as when they are loaded
    one after the other.
    """
    placed = incoming.withColumn("_row", F.monotonically_increasing_id())
    last = first_by(placed, ["id"], [F.desc("_row")]).drop("_row")
    old, new = stored.alias("old"), last.alias("new")
    both = old.join(new, F.col("old.id") == F.col("new.id"), "full_outer")
    given = F.col("new.id").isNotNull()

    def value(column: str) -> Column:
        if column == "id" or (keep_currency and column == "currency_code"):
            first, second = ("old", "new")
            return F.coalesce(F.col(f"{first}.{column}"), F.col(f"{second}.{column}"))
        return F.when(given, F.col(f"new.{column}")).otherwise(F.col(f"old.{column}"))

    return both.select(*(value(c).alias(c) for c in PRODUCT_COLUMNS))


def category_id(name: Column) -> Column:
    """Surrogate key of a category. A hash of the name is the same in every run
    and needs no global counter."""
    return F.xxhash64(name)


def new_categories(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """(id, name) of categories the table lacks."""
    names = incoming.select(F.explode("categories").alias("name")).distinct()
    return absent_from(names, stored, ["name"]).select(category_id(F.col("name")).alias("id"), "name")


def new_bridge_rows(stored: DataFrame, incoming: DataFrame, categories: DataFrame) -> DataFrame:
    """(product_id, category_id) pairs the bridge lacks; ids come from the table."""
    pairs = incoming.select(F.col("id").alias("product_id"), F.explode("categories").alias("name")).distinct()
    keyed = pairs.join(categories.withColumnRenamed("id", "category_id"), "name").select(
        "product_id", "category_id"
    )
    return absent_from(keyed, stored, ["product_id", "category_id"])
