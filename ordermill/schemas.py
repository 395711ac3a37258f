"""Fixed schemas. Streams and feeds are never inferred."""

from pyspark.sql import types as T

MONEY = T.StructType(
    [
        T.StructField("currency_code", T.StringType()),
        T.StructField("units", T.LongType()),
        T.StructField("nanos", T.LongType()),
    ]
)

ITEM = T.StructType(
    [
        T.StructField(
            "item",
            T.StructType(
                [
                    T.StructField("product_id", T.StringType()),
                    # bigint on purpose: a value beyond int must reach the
                    # range check instead of turning into NULL while parsing.
                    T.StructField("quantity", T.LongType()),
                ]
            ),
        ),
        T.StructField("cost", MONEY),
    ]
)

ADDRESS = T.StructType(
    [
        T.StructField("street_address", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("zip_code", T.LongType()),
    ]
)

CORRUPT = "_corrupt_record"

ORDER_EVENT = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("shipping_tracking_id", T.StringType()),
        T.StructField("shipping_cost", MONEY),
        T.StructField("shipping_address", ADDRESS),
        T.StructField("items", T.ArrayType(ITEM)),
        T.StructField("timestamp", T.StringType()),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

# What a message source yields, whether it is a broker or a file replay.
MESSAGE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# One landed row: the message text plus six metadata columns, all as the landing
# files store them (dates and timestamps are ISO text).
LANDING = T.StructType(
    [
        T.StructField("raw", T.StringType()),
        T.StructField("_ingested_at", T.StringType()),
        T.StructField("_event_date", T.StringType()),
        T.StructField("_source_topic", T.StringType()),
        T.StructField("_kafka_partition", T.LongType()),
        T.StructField("_kafka_offset", T.LongType()),
        T.StructField("_schema_version", T.StringType()),
    ]
)

BRONZE = T.StructType(
    [
        T.StructField("raw", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("_ingested_at", T.TimestampType()),
        T.StructField("_event_date", T.DateType()),
        T.StructField("_source_topic", T.StringType()),
        T.StructField("_kafka_partition", T.IntegerType()),
        T.StructField("_kafka_offset", T.LongType()),
        T.StructField("_schema_version", T.StringType()),
        T.StructField("_row_id", T.StringType()),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("source_path", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("file_created_at", T.TimestampType()),
        T.StructField("synced_at", T.TimestampType()),
    ]
)

MANIFEST = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("size_bytes", T.LongType()),
        T.StructField("schema_hash", T.StringType()),
        T.StructField("min_event_date", T.StringType()),
        T.StructField("max_event_date", T.StringType()),
        T.StructField("created_at", T.StringType()),
    ]
)

ORDER_ITEMS = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("currency_code", T.StringType()),
        T.StructField("unit_price", T.DecimalType(12, 2)),
        T.StructField("total_price", T.DecimalType(12, 2)),
        T.StructField("event_timestamp", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("event_date", T.DateType()),
    ]
)

SNAPSHOTS = T.StructType(
    [
        T.StructField("snapshot_ts", T.TimestampType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("units_in_cart", T.LongType()),
        T.StructField("carts_with_product", T.LongType()),
    ]
)

PRODUCTS_JSON = T.StructType(
    [
        T.StructField(
            "products",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.StringType()),
                        T.StructField("name", T.StringType()),
                        T.StructField("description", T.StringType()),
                        T.StructField("picture", T.StringType()),
                        T.StructField(
                            "priceUsd",
                            T.StructType(
                                [
                                    T.StructField("currencyCode", T.StringType()),
                                    T.StructField("units", T.LongType()),
                                    T.StructField("nanos", T.LongType()),
                                ]
                            ),
                        ),
                        T.StructField("categories", T.ArrayType(T.StringType())),
                    ]
                )
            ),
        )
    ]
)
