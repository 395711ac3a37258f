"""Silver and gold: order events to one row per (order, product)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions import money
from ordermill.operators import ingest
from ordermill.operators.dedupe import first_by

ARRIVAL = ("_ingested_at", "_kafka_partition", "_kafka_offset")
SILVER_COLUMNS = (
    "order_id",
    "product_id",
    "quantity",
    "currency_code",
    "unit_price",
    "event_timestamp",
    "event_date",
    "status",
)


def checked_events(bronze: DataFrame) -> DataFrame:
    """Bronze rows with the parsed event and the reason they are refused, if any."""
    return ingest.classify(ingest.parse(bronze, "raw"))


def quarantine(bronze: DataFrame) -> DataFrame:
    """Bronze rows that silver leaves out, with the reason."""
    return checked_events(bronze).where(F.col("error").isNotNull()).select(*bronze.columns, "error")


def exploded_items(bronze: DataFrame) -> DataFrame:
    """One row per item of every accepted event, replays included."""
    accepted = checked_events(bronze).where(F.col("error").isNull())
    return ingest.flatten(accepted, "_event_date", *ARRIVAL).withColumnRenamed(
        "_event_date", "event_date"
    )


def silver_items(bronze: DataFrame) -> DataFrame:
    """First arrival per (order_id, product_id), then by position in its event."""
    first = first_by(
        exploded_items(bronze).drop("total_price"),
        ["order_id", "product_id"],
        [*ARRIVAL, "item_pos"],
    )
    return first.select(*SILVER_COLUMNS)


def gold_fact(silver: DataFrame) -> DataFrame:
    """Prices to cents; the total comes from the price before it is rounded."""
    return silver.select(
        "order_id",
        "product_id",
        "quantity",
        "currency_code",
        F.col("unit_price").cast(ingest.PRICE).alias("unit_price"),
        money.line_total(F.col("unit_price"), F.col("quantity")).cast(ingest.PRICE).alias("total_price"),
        "event_timestamp",
        "event_date",
        "status",
    )


def schema_name(custom: str | None, target: str) -> str:
    """Schema of a model: its own, else the target's."""
    return custom.strip() if custom and custom.strip() else target


def materialise(spark: SparkSession, model: DataFrame, layer: str | None, name: str,
                target: str = "default") -> str:
    """Full rebuild of a model as table ``<layer>.<name>``."""
    schema = schema_name(layer, target)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    model.write.mode("overwrite").format("parquet").saveAsTable(f"{schema}.{name}")
    return f"{schema}.{name}"


def build_models(spark: SparkSession, bronze: DataFrame, target: str = "default") -> dict[str, str]:
    """Silver, then gold from the stored silver: the events are parsed once."""
    silver = materialise(spark, silver_items(bronze), "silver", "stg_orders_items", target)
    gold = materialise(spark, gold_fact(spark.table(silver)), "gold", "fact_orders_items", target)
    return {"silver": silver, "gold": gold}
