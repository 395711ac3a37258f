"""The registered queries: every one runs over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions import cart_blob, fx, money
from ordermill.functions.timestamps import ntz, utc_iso
from ordermill.operators import (
    bronze,
    carts,
    catalog,
    cdc,
    checkout,
    feeds,
    ingest,
    keyed,
    landing,
    moneyops,
    monitoring,
    screening,
    substring,
    suggest,
)
from ordermill.operators import vectors as vectors_op
from ordermill.plans import bi, increment, models, quality, store, upkeep
from ordermill.schemas import BRONZE
from ordermill.session import fresh_dir, use_bounded_tasks, use_utc
from ordermill.sources import files, tables
from ordermill.streaming import alerts, cart_stream, cdc_stream, etl

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_utc(spark)
        use_bounded_tasks(spark)
        result = function(spark, sf_dir)
        # Instants leave as plain UTC wall-clock values.
        stamps = [f.name for f in result.schema.fields if f.dataType.typeName() == "timestamp"]
        return result.withColumns({n: ntz(F.col(n)) for n in stamps}) if stamps else result

    _QUERIES[function.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.layers(spark, sf_dir).gold


# --- models and BI ---------------------------------------------------------


@query
def silver_order_items(spark, sf_dir):
    return models.silver_items(store.layers(spark, sf_dir).bronze)


@query
def gold_fact_order_items(spark, sf_dir):
    return models.gold_fact(store.layers(spark, sf_dir).silver)


@query
def gold_from_deltas(spark, sf_dir):
    """Gold kept from two deltas of bronze; the second brings half of the events of every month's first day, among them
    earlier copies of what the first brought."""
    rows = store.layers(spark, sf_dir).bronze
    root = fresh_dir(spark, "increment")
    later = (F.dayofmonth("_event_date") == 1) & (F.pmod(F.xxhash64("_row_id", "_kafka_offset"), F.lit(2)) == 0)
    for delta in (rows.where(~later), rows.where(later)):
        increment.apply(spark, root, delta, unit="month")
    return increment.gold(spark, root)


@query
def order_event_items(spark, sf_dir):
    """Items and units of every event, parsed back from its text."""
    parsed = ingest.parse(store.layers(spark, sf_dir).bronze, "raw")
    units = F.aggregate("event.items", F.lit(0).cast("bigint"), lambda total, i: total + F.coalesce(i["quantity"].cast("bigint"), F.lit(0)))
    return parsed.select("order_id", "_kafka_offset", F.size("event.items").alias("items"), units.alias("units"))


@query
def quarantine(spark, sf_dir):
    """Refused events as stored beside silver, with the reason."""
    return store.layers(spark, sf_dir).quarantine.select("order_id", "_kafka_offset", "error")


@query
def bi_revenue_by_hour(spark, sf_dir):
    return bi.revenue_by_hour(_fact(spark, sf_dir))


@query
def bi_newest_hours(spark, sf_dir):
    return bi.newest_hours(bi.revenue_by_hour(_fact(spark, sf_dir)))


@query
def bi_top_products(spark, sf_dir):
    return bi.top_products(bi.product_sales(_fact(spark, sf_dir)))


@query
def bi_product_sales(spark, sf_dir):
    return bi.product_sales(_fact(spark, sf_dir))


@query
def bi_product_sales_with_copies(spark, sf_dir):
    """Product sales while every tenth order is in the fact twice: orders count once."""
    fact = _fact(spark, sf_dir)
    return bi.product_sales(fact.unionByName(fact.where(F.col("order_id").cast("bigint") % 10 == 0)))


def _rates(spark, sf_dir):
    lines = carts.fold(tables.cart_events(spark, sf_dir))
    return bi.cart_not_paid(tables.cart_snapshots(lines), _fact(spark, sf_dir))


@query
def bi_cart_not_paid(spark, sf_dir):
    return _rates(spark, sf_dir)


@query
def bi_cart_not_paid_top(spark, sf_dir):
    return bi.highest_rate(_rates(spark, sf_dir))


@query
def bi_revenue_usd_by_hour(spark, sf_dir):
    return bi.revenue_in(_fact(spark, sf_dir), "USD")


@query
def bi_metrics(spark, sf_dir):
    by_hour = bi.revenue_by_hour(_fact(spark, sf_dir))
    return by_hour.agg(
        F.sum("revenue").cast(bi.REVENUE).alias("revenue"), F.sum("units").cast("bigint").alias("units")
    )


# --- quality -------------------------------------------------------------------


@query
def reconcile_totals(spark, sf_dir):
    start, end = "1996-01-01", "1999-12-31"
    return quality.reconcile(
        quality.by_event_date(_fact(spark, sf_dir), start, end),
        quality.by_timestamp(tables.reference_items(spark, sf_dir), start, end),
    )


@query
def items_per_day(spark, sf_dir):
    return quality.items_per_day(store.layers(spark, sf_dir).silver)


@query
def duplicate_grain(spark, sf_dir):
    return quality.duplicates(tables.order_lines(spark, sf_dir))


@query
def quality_report(spark, sf_dir):
    """The suites on the stored tables."""
    tables_ = store.layers(spark, sf_dir)
    return quality.checkpoint(
        quality.bronze_suite(tables_.bronze), quality.silver_suite(tables_.silver), quality.gold_suite(tables_.gold)
    )


def _faulty(fact: DataFrame) -> DataFrame:
    """The fact with a fault in some orders, one kind each; one kind is missing, one is there twice."""
    kind = F.col("order_id").cast("bigint") % 97
    broken = fact.where(kind != 18).withColumns(
        {
            "product_id": F.when(kind != 12, F.col("product_id")),
            "quantity": F.when(kind == 11, 0).otherwise(F.col("quantity")),
            "status": F.when(kind == 13, "LOST").when(kind == 14, "CANCELLED").otherwise(F.col("status")),
            "unit_price": F.when(kind == 15, -F.col("unit_price")).otherwise(F.col("unit_price")),
            "total_price": F.when(kind == 16, F.col("total_price") + 1).otherwise(F.col("total_price")),
        }
    )
    return broken.unionByName(broken.where(kind == 17))


@query
def quality_report_faulty(spark, sf_dir):
    """The gold suite where it must fail, and the expected totals of the fact."""
    fact = _faulty(_fact(spark, sf_dir))
    row = quality.totals(fact, "fact", F.count_if(quality.price_mismatch()).alias("fact_price_mismatch_rows"))
    return quality.checkpoint(quality.gold_suite(fact), quality.exact("totals", row, {"fact_price_mismatch_rows": 0, "fact_items": -1}))


@query
def reconcile_differences(spark, sf_dir):
    """Years in which the faulty fact and the reference disagree, and by how much."""
    fact = _faulty(_fact(spark, sf_dir)).withColumn("year", F.year("event_date"))
    reference = tables.reference_items(spark, sf_dir).withColumn("year", F.year("event_timestamp"))
    return quality.differences(quality.reconcile_by(fact, reference, "year"))


# --- ingest --------------------------------------------------------------------


def _routed(spark, sf_dir):
    return ingest.outcome(tables.faulty_messages(spark, sf_dir), transient=F.col("target_away"))


@query
def ingest_routes(spark, sf_dir):
    return _routed(spark, sf_dir).select(
        "o_orderkey", "route", "status", "error", F.col("out_attempt").alias("attempt")
    )


@query
def ingest_outcomes(spark, sf_dir):
    """Outcomes of the messages as a file of JSON lines; envelopes find the target away."""
    root = fresh_dir(spark, "lines")
    tables.faulty_messages(spark, sf_dir).select("value").write.text(f"{root}/messages")
    lines = files.read_jsonl(spark, f"{root}/messages")
    return ingest.count_outcomes(ingest.outcome(lines, transient=F.col("value").startswith('{"original":')))


@query
def ingest_letters(spark, sf_dir):
    """Envelopes of both topics, read back the way the consumer reads them."""
    # Both topics draw on the same refused messages: kept, so that the messages are built and parsed once.
    refused = _routed(spark, sf_dir).where(F.col("route").isin("dlq", "retry")).select("route", "event", "body", "error", "out_attempt")
    path = fresh_dir(spark, "refused")
    refused.write.parquet(path)
    routed = spark.read.schema(refused.schema).parquet(path)
    now = F.lit("2026-01-01").cast("timestamp")
    letters = (
        ingest.dead_letters(routed, now).withColumn("topic", F.lit("orders_dlq"))
        .unionByName(ingest.retries(routed, now).drop("headers").withColumn("topic", F.lit("orders_retry")))
    )
    again = ingest.parse(letters)
    return again.select(
        "topic",
        "key",
        "attempt",
        F.get_json_object("value", "$.error").alias("error"),
        F.size("event.items").alias("items"),
    )


# --- landing and bronze --------------------------------------------------------


@query
def landing_manifest(spark, sf_dir):
    """Days of the landed events' manifest."""
    manifest = landing.read_manifest(spark, f"{store.landed(spark, sf_dir)}/manifest")
    return landing.manifest_totals(manifest).select("event_date", "rows", "min_event_date", "max_event_date")


#: The test tables hold few events a day; months make whole files of them.
BY_MONTH = replace(bronze.BY_DAY, period="month")


@query
def bronze_undated(spark, sf_dir):
    """Events without a usable time, dated by their arrival: copies that land on other days are not added."""
    root = fresh_dir(spark, "lake")
    raw = F.regexp_replace("raw", '"timestamp":"[^"]*"', '"timestamp":"soon"')
    events = tables.order_events(spark, sf_dir, replays=False).withColumn("raw", F.when(F.col("o_orderkey") % 3 == 0, raw).otherwise(F.col("raw")))
    table = keyed.KeyedTable(spark, f"{root}/bronze", BRONZE, BY_MONTH)
    for day, part in (("2026-01-31", events), ("2026-02-01", events.where("o_orderkey % 2 = 0")), ("2026-04-01", events.where("o_orderkey % 5 = 0"))):
        rows = bronze.one_per_row_id(bronze.bronze_rows(landing.decorate(part, F.lit(day).cast("timestamp"))))
        table.insert_absent(rows, bronze.own_date(F.col("raw")))
    return bronze.read_bronze(spark, f"{root}/bronze").groupBy("_event_date").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("order_id").alias("orders"))


@query
def bronze_sync(spark, sf_dir):
    """Two landed batches, the second all replays, each drained into bronze."""
    root = fresh_dir(spark, "lake")
    events = tables.order_events(spark, sf_dir)
    late = F.col("_kafka_offset") % 1_000_000_000_000 >= 1_000_000_000
    stamp = F.lit("2026-01-01").cast("timestamp")
    for batch, part in enumerate((events.where(~late), events.where(late))):
        landing.land_batch(part, f"{root}/landing", batch, ingested_at=stamp)
        while bronze.sync(spark, f"{root}/landing", f"{root}/bronze", f"{root}/ledger", layout=BY_MONTH):
            pass
    table = bronze.read_bronze(spark, f"{root}/bronze")
    return table.select("order_id", "_event_date", "_kafka_partition", "_kafka_offset")


@query
def bronze_first_load(spark, sf_dir):
    """Everything landed into an empty table, then a sync that finds nothing; rows per day."""
    landed, root = store.landed(spark, sf_dir), fresh_dir(spark, "lake")
    bronze.load_full(spark, landed, f"{root}/bronze", f"{root}/ledger", layout=BY_MONTH)
    bronze.sync(spark, landed, f"{root}/bronze", f"{root}/ledger", layout=BY_MONTH)
    table = bronze.read_bronze(spark, f"{root}/bronze")
    return table.groupBy("_event_date").agg(F.count(F.lit(1)).alias("rows"))


@query
def bronze_backfill(spark, sf_dir):
    """Days stored before two columns existed, read with them missing, then filled in."""
    root, rows = fresh_dir(spark, "lake"), store.layers(spark, sf_dir).bronze
    rows = upkeep.with_columns_of(rows.drop("order_id", "_row_id").where("year(_event_date) < 1996"), rows).unionByName(rows.where("year(_event_date) >= 1996"))
    rows.repartition("_event_date").write.partitionBy("_event_date").parquet(f"{root}/bronze")
    before = bronze.read_bronze(spark, f"{root}/bronze").groupBy("_event_date").agg(F.count_if(F.col("_row_id").isNull()).alias("missing")).collect()
    bronze.backfill(spark, f"{root}/bronze")
    missing = spark.createDataFrame(before, "_event_date date, missing bigint")
    after = bronze.read_bronze(spark, f"{root}/bronze").groupBy("_event_date").agg(
        F.count_if(F.col("_row_id").isNull() | F.col("order_id").isNull()).alias("left"), F.count_distinct("_row_id").alias("events")
    )
    return missing.join(after, "_event_date")


@query
def bronze_rows(spark, sf_dir):
    rows = bronze.one_per_row_id(store.layers(spark, sf_dir).bronze)
    return rows.select("order_id", "_event_date", "_kafka_partition", "_kafka_offset", "_ingested_at")


@query
def bronze_health(spark, sf_dir):
    return bronze.health(store.layers(spark, sf_dir).bronze)


@query
def pending_files(spark, sf_dir):
    """Rows that wait in landed files, per day; the files of the days before 1999 have been synced."""
    manifest = landing.read_manifest(spark, f"{store.landed(spark, sf_dir)}/manifest")
    pending = bronze.pending_files(manifest, _ledger(manifest))
    return pending.groupBy(F.col("min_event_date").alias("event_date")).agg(F.sum("rows").alias("rows"))


@query
def pending_files_per_run(spark, sf_dir):
    """Runs over the whole manifest until nothing is pending: every file is entered once, by one run."""
    manifest = landing.read_manifest(spark, f"{store.landed(spark, sf_dir)}/manifest")
    ledger = f"{fresh_dir(spark, 'runs')}/ledger"
    while True:
        run = bronze.next_run(bronze.pending_files(manifest, bronze.read_ledger(spark, ledger)))
        if run.isEmpty():
            break
        bronze.record(run, ledger, F.lit("2026-01-01").cast("timestamp"))
    done = bronze.read_ledger(spark, ledger)
    return done.groupBy(_day_of("source_path").alias("event_date")).agg(F.sum("rows").alias("rows"))


@query
def bronze_without_tests(spark, sf_dir):
    """Events per day without those of the test traffic, known by a prefix of the order id."""
    kept = bronze.without_prefix(store.layers(spark, sf_dir).bronze, "7")
    return kept.groupBy("_event_date").agg(F.count(F.lit(1)).alias("rows"))


def _ledger(manifest: DataFrame) -> DataFrame:
    """Ledger rows of the landed files of days before 1999, each synced the day after."""
    old = manifest.where("min_event_date < '1999-01-01'")
    return old.select(
        F.col("path").alias("source_path"), "rows", F.date_add(F.col("min_event_date").cast("date"), 1).cast("timestamp").alias("file_created_at")
    )


# --- monitoring ----------------------------------------------------------------


@query
def outcome_counts(spark, sf_dir):
    return ingest.count_outcomes(tables.processing_outcomes(spark, sf_dir), "topic")


@query
def dlq_5min(spark, sf_dir):
    return monitoring.alert_dead_letters(tables.processing_outcomes(spark, sf_dir))


@query
def rate_by_status(spark, sf_dir):
    return monitoring.rate_by_status(tables.processing_outcomes(spark, sf_dir))


@query
def topic_freshness(spark, sf_dir):
    return monitoring.freshness(
        tables.processing_outcomes(spark, sf_dir), F.lit("2024-01-31 00:00:00").cast("timestamp")
    )


@query
def topic_lag(spark, sf_dir):
    return monitoring.lag(*tables.message_offsets(spark, sf_dir))


@query
def lag_alert(spark, sf_dir):
    return monitoring.alert_lag(tables.lag_samples(spark, sf_dir))


# --- carts ---------------------------------------------------------------------


def _carts(spark, sf_dir):
    return carts.fold(tables.cart_events(spark, sf_dir))


@query
def cart_fold(spark, sf_dir):
    return _carts(spark, sf_dir)


@query
def cart_snapshot(spark, sf_dir):
    return carts.snapshot(_carts(spark, sf_dir), F.lit("2024-01-31").cast("timestamp"))


@query
def cart_blob_snapshot(spark, sf_dir):
    """The same through encoded carts, one blob per user with all lines; some have
    fields nobody knows, every seventh is cut short."""
    items = F.array_sort(F.collect_list(F.struct("product_id", "quantity")))  # a cart has a line per product
    whole = _carts(spark, sf_dir).groupBy("user_id").agg(items.alias("items"))
    key = F.col("user_id").cast("bigint")
    blob = cart_blob.encode(F.col("user_id"), F.col("items"))
    blob = F.when(key % 5 == 1, F.concat(F.unhex(F.lit("2D00000000")), blob, F.unhex(F.lit("1807")))).otherwise(blob)
    dump = whole.select(F.col("user_id").alias("key"), blob.alias("value")).withColumn(
        "value",
        F.when(F.col("key").cast("bigint") % 7 == 0, F.expr("substring(value, 1, octet_length(value) - 1)")).otherwise(F.col("value")),
    )
    root = fresh_dir(spark, "dump")
    dump.write.parquet(f"{root}/carts")
    dump = files.read_cart_dump(spark, f"{root}/carts")
    return carts.snapshot(carts.blob_lines(carts.decode_blobs(dump)), F.lit("2024-01-31").cast("timestamp"))


@query
def snapshot_upsert(spark, sf_dir):
    """Snapshots of a month, then one taken again: replaced, and old ones dropped."""
    lines = _carts(spark, sf_dir)
    stamp = lambda text: F.lit(text).cast("timestamp")
    once = carts.snapshot(lines, F.lit(None).cast("timestamp")).drop("snapshot_ts")
    days = F.sequence(stamp("2024-01-01"), stamp("2024-01-31"), F.expr("interval 1 day"))
    stored = once.withColumn("snapshot_ts", F.explode(days))
    again = once.withColumns(
        {"snapshot_ts": stamp("2024-01-31"), "units_in_cart": F.col("units_in_cart") + 1}
    )
    return carts.upsert_snapshots(stored, again, stamp("2024-01-31"))


# --- catalogue -----------------------------------------------------------------


@query
def catalog_page(spark, sf_dir):
    return catalog.page(tables.products(spark, sf_dir), tables.product_categories(spark, sf_dir), number=2)


@query
def catalog_search(spark, sf_dir):
    return catalog.search(
        tables.products(spark, sf_dir), tables.product_categories(spark, sf_dir), "RED g_z"
    )


@query
def catalog_search_many(spark, sf_dir):
    """Searches made of every hundredth product's name, with wildcards, over the names of all products."""
    names = tables.products(spark, sf_dir).select("id", F.col("name").alias("text"))
    asked = names.where(F.col("id").cast("bigint") % 100 == 0)
    part = lambda at, size: F.substring("text", at, size)
    kinds = F.array(part(2, 5), F.concat(part(1, 3), F.lit("_"), part(5, 2)), F.concat(part(2, 2), F.lit("%"), F.upper(part(6, 3))), F.concat(part(3, 1), F.lit("_"), part(5, 1)))
    queries_ = asked.select(F.col("id"), F.posexplode(kinds).alias("kind", "query")).select(F.concat_ws("-", "id", "kind").alias("query_id"), "query")
    root = fresh_dir(spark, "letters")
    substring.postings(names).write.parquet(root)
    return substring.search(queries_, names, spark.read.schema("id string, letters string").parquet(root))


@query
def catalog_products(spark, sf_dir):
    return catalog.with_categories(tables.products(spark, sf_dir), tables.product_categories(spark, sf_dir))


@query
def product_lookup(spark, sf_dir):
    requests = tables.page_requests(spark, sf_dir).where(F.col("product_id").isNotNull())
    return catalog.lookup(requests, tables.products(spark, sf_dir)).select(
        "product_id", "requests", "found", "name", "price_units", "price_nanos"
    )


@query
def vector_export(spark, sf_dir):
    return catalog.vector_export(tables.json_feed(spark, sf_dir))


@query
def catalog_upsert(spark, sf_dir):
    """A feed file with header and quoted text, read back and merged into the catalogue."""
    root = fresh_dir(spark, "feed")
    tables.csv_feed(spark, sf_dir).write.option("header", "true").option("escape", '"').csv(f"{root}/feed")
    feed = feeds.from_csv_feed(files.read_products_csv(spark, f"{root}/feed"))
    stored = tables.products(spark, sf_dir).withColumn("currency_code", F.lit("GBP"))
    return feeds.upsert_products(stored, feed, keep_currency=True)


@query
def catalog_upsert_json(spark, sf_dir):
    """Product documents as files, a hundred products each, read back and merged into the catalogue."""
    root = fresh_dir(spark, "feed")
    feed = tables.json_feed(spark, sf_dir)
    documents = feed.groupBy(F.floor(F.col("id").cast("bigint") / 100).alias("n")).agg(F.collect_list(F.struct(*feed.columns)).alias("products"))
    documents.select(F.to_json(F.struct("products")).alias("value")).write.option("maxRecordsPerFile", 1).text(f"{root}/products")
    feed = feeds.from_json_feed(files.read_products_json(spark, f"{root}/products"))
    return feeds.upsert_products(tables.products(spark, sf_dir), feed, keep_currency=False)


@query
def catalog_bridge(spark, sf_dir):
    """Bridge rows a CSV feed adds to an empty bridge, by category name."""
    feed = feeds.from_csv_feed(tables.csv_feed(spark, sf_dir))
    no_categories = spark.createDataFrame([], "id bigint, name string")
    no_bridge = spark.createDataFrame([], "product_id string, category_id bigint")
    categories = feeds.new_categories(no_categories, feed)
    rows = feeds.new_bridge_rows(no_bridge, feed, categories)
    return catalog.named_bridge(rows, categories)


# --- shop ----------------------------------------------------------------------


def _line_money(currency):
    return F.struct(
        currency.alias("currency_code"),
        F.floor(F.col("cents") / 100).cast("bigint").alias("units"),
        ((F.col("cents") % 100) * 10_000_000).alias("nanos"),
    )


@query
def fx_convert(spark, sf_dir):
    """Every line's price in Japanese yen."""
    lines = tables.order_lines(spark, sf_dir)
    converted = fx.with_converted(lines, _line_money(F.col("currency_code")), F.lit("JPY"), "m")
    return converted.select(
        "order_id", "product_id", "line", "supp", "currency_code",
        F.col("m.units").alias("units"), F.col("m.nanos").alias("nanos"),
        money.render(F.lit("JPY"), F.col("m.units"), F.col("m.nanos")).alias("shown"),
    )


@query
def supported_currencies(spark, sf_dir):
    """Orders per supported currency; currencies without orders show 0."""
    used = tables.order_headers(spark, sf_dir).groupBy("currency_code").agg(F.count(F.lit(1)).alias("orders"))
    return fx.supported_currencies(spark).join(used, "currency_code", "left").select(
        "currency_code",
        F.coalesce("orders", F.lit(0).cast("bigint")).alias("orders"),
        F.col("currency_code").isin(*money.SHOP_CURRENCIES).alias("offered"),
    )


@query
def money_sum(spark, sf_dir):
    """Price minus discount per line; mixed signs and currencies give errors."""
    lines = tables.table(spark, sf_dir, "lineitem")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    off = F.round(F.col("l_extendedprice") * F.col("l_discount") * 100).cast("bigint")
    part = lambda c: ((c / 100).cast("bigint"), (c % 100) * 10_000_000)
    u, n = part(cents)
    ou, on = part(off)
    struct = lambda currency, units, nanos: F.struct(
        currency.alias("currency_code"), units.alias("units"), nanos.alias("nanos")
    )
    currency = F.when(F.col("l_returnflag") == "R", "EUR").otherwise("USD")
    nanos = F.when(F.col("l_linenumber") == 7, on + 1).otherwise(-on)
    rows = lines.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        struct(F.lit("USD"), u, n).alias("price"),
        struct(currency, -ou, nanos).alias("discount"),
    )
    return moneyops.add(rows, "price", "discount").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.col("sum.units").alias("units"), F.col("sum.nanos").alias("nanos"), "error",
    )


@query
def order_totals(spark, sf_dir):
    headers = tables.with_shipping(tables.order_headers(spark, sf_dir)).select(
        F.col("o_orderkey").alias("order_id"),
        "currency_code",
        F.lit(None).cast(money.TOTAL).alias("amount"),
        money.amount(F.col("shipping_cost.units"), F.col("shipping_cost.nanos")).alias("shipping"),
    )
    cents = F.round(F.col("l_extendedprice") * 100).cast("decimal(19,0)")
    lines = tables.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.lit(None).cast("string").alias("currency_code"),
        (cents * F.expr("0.01BD") * F.col("l_quantity").cast("decimal(10,0)")).cast(money.TOTAL).alias("amount"),
        F.lit(None).cast(money.AMOUNT).alias("shipping"),
    )
    totals = checkout.order_total(headers.unionByName(lines))
    return totals.withColumn("shown", money.render(F.col("currency_code"), F.col("units"), F.col("nanos")))


@query
def shipping_quote(spark, sf_dir):
    ordered = tables.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.lit(0).alias("quantity")
    )
    lines = tables.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_quantity").cast("int").alias("quantity")
    )
    return checkout.quote(ordered.unionByName(lines), "order_id")


def _priced_carts(spark, sf_dir):
    lines = _carts(spark, sf_dir)
    currency = tables.user_currency(F.col("user_id").cast("bigint").cast("int"))
    return checkout.price_lines(lines, tables.products(spark, sf_dir), currency)


@query
def cart_lines_priced(spark, sf_dir):
    return _priced_carts(spark, sf_dir).select(
        "user_id", "product_id", "quantity",
        F.col("cost.currency_code").alias("currency_code"),
        F.col("cost.units").alias("units"), F.col("cost.nanos").alias("nanos"), "error",
    )


@query
def cart_totals(spark, sf_dir):
    return checkout.cart_totals(_priced_carts(spark, sf_dir))


@query
def recommendations(spark, sf_dir):
    """For every user: products of the catalogue that are not in the cart."""
    users = tables.table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("request_id")).distinct()
    baskets = _carts(spark, sf_dir).select(F.col("user_id").alias("request_id"), "product_id")
    return suggest.recommend(users, baskets, tables.products(spark, sf_dir).select(F.col("id").alias("product_id")), seed=7)


def _ads(spark, sf_dir):
    return suggest.ads_for(tables.ad_requests(spark, sf_dir), tables.advertisements(spark, sf_dir), seed=7)


@query
def ads_for_request(spark, sf_dir):
    return _ads(spark, sf_dir).select("request_id", "key_pos", "redirect_url", "text", "fallback")


@query
def chosen_ads(spark, sf_dir):
    return suggest.choose_ad(_ads(spark, sf_dir), seed=7).select("request_id", "redirect_url")


@query
def vector_topk(spark, sf_dir):
    """The ten products nearest to the mean vector of each label; some vectors are zero, some missing."""
    kind = F.col("vec_id") % 50
    vectors = tables.table(spark, sf_dir, "embeddings").withColumn(
        "embedding",
        F.when(kind == 7, F.transform("embedding", lambda x: F.lit(0.0).cast("float"))).when(kind != 8, F.col("embedding")),
    )
    found = vectors_op.nearest(vectors, vectors_op.centroids(vectors, "label"), 10)
    return found.withColumn("score", F.round("score", 6))


@query
def vector_topk_indexed(spark, sf_dir):
    """The ten vectors nearest to every vector whose id is divisible by 100, by the index."""
    vectors = tables.table(spark, sf_dir, "embeddings")
    asked = vectors.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    found = vectors_op.Index.build(vectors).nearest(asked, 10)
    return found.select("query_id", "vec_id", F.round("score", 6).alias("score"), "rank")


# --- screening -----------------------------------------------------------------


@query
def payload_screen(spark, sf_dir):
    rows = screening.screen(tables.checkouts(spark, sf_dir), screening.checkout_error())
    return rows.select("checkout_id", "first_error")


@query
def card_screen(spark, sf_dir):
    rows = screening.screen(tables.checkouts(spark, sf_dir), screening.card_error(2025, 6))
    return rows.select(
        "checkout_id", "first_error", screening.last_four(F.col("cc_number")).alias("last_four")
    )


@query
def cart_add_screen(spark, sf_dir):
    adds = tables.table(spark, sf_dir, "events").select(
        "event_id",
        F.floor("value").cast("bigint").alias("quantity"),
        F.when(F.col("event_type") == "error", "").otherwise(F.get_json_object("props", "$.k")).alias("product_id"),
    )
    return screening.screen(adds, screening.cart_error()).select("event_id", "first_error")


@query
def currency_screen(spark, sf_dir):
    choices = tables.table(spark, sf_dir, "nation").join(
        tables.table(spark, sf_dir, "customer"), F.col("n_nationkey") == F.col("c_nationkey")
    ).select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "MACHINERY", F.substring("n_name", 1, 3))
        .otherwise(tables.user_currency(F.col("c_nationkey"))).alias("currency"),
    )
    return screening.screen(choices, screening.currency_error())


# --- change events -------------------------------------------------------------

CDC_FIELDS = ("id", "name", "price_units", "price_nanos")


@query
def cdc_inserts(spark, sf_dir):
    return cdc.fields(cdc.changes(tables.change_messages(spark, sf_dir)), CDC_FIELDS)


@query
def cdc_captured(spark, sf_dir):
    """Products whose insert was captured with the values the table holds."""
    events = cdc.fields(cdc.changes(tables.change_messages(spark, sf_dir)), CDC_FIELDS)
    return cdc.captured(tables.products(spark, sf_dir), events, CDC_FIELDS).select("id", "name")


# --- upkeep --------------------------------------------------------------------


def _dated(spark, sf_dir):
    return tables.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("_event_date"))


@query
def retention_kept(spark, sf_dir):
    today = F.lit("2001-08-01").cast("date")
    return upkeep.kept(_dated(spark, sf_dir), today).groupBy("_event_date").agg(F.count(F.lit(1)).alias("rows"))


@query
def retention_expired(spark, sf_dir):
    return upkeep.expired_days(_dated(spark, sf_dir), F.lit("2001-08-01").cast("date"))


def _day_of(path):
    return F.regexp_extract(path, "event_date=([^/]+)/", 1)


@query
def prune_candidates(spark, sf_dir):
    """Days whose landed files were synced, are old enough and still lie there."""
    root = store.landed(spark, sf_dir)
    ledger = _ledger(landing.read_manifest(spark, f"{root}/manifest"))
    gone = spark.createDataFrame([("file:/landing/event_date=1900-01-01/part-0.parquet",)], "source_path string")
    ledger = ledger.unionByName(gone.selectExpr("source_path", "1L as rows", "timestamp'1900-01-02' as file_created_at"))
    listing = files.list_files(spark, f"{root}/data")
    found = upkeep.prune_candidates(ledger, listing, F.lit("1998-12-31").cast("timestamp"))
    return found.select(_day_of("path").alias("event_date"), "file_created_at").distinct()


@query
def orphans(spark, sf_dir):
    """Days of a batch that was written but never entered in a manifest."""
    root = fresh_dir(spark, "lake")
    headers = tables.order_headers(spark, sf_dir).select(
        F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("order_id"), utc_iso(F.col("event_timestamp")).alias("timestamp"))).alias("raw"), "o_orderkey"
    )
    landing.land_batch(headers.where("o_orderkey % 5 > 0"), root, 0)
    landing.write_batch(landing.decorate(headers.where("o_orderkey % 5 = 0")), f"{root}/data", "crashed")
    listing = files.list_files(spark, f"{root}/data")
    later = F.current_timestamp() + F.expr("interval 10 days")
    found = upkeep.orphans(listing, landing.read_manifest(spark, f"{root}/manifest"), later)
    return found.select(_day_of("path").alias("event_date")).distinct()


# --- streams -------------------------------------------------------------------


def _message_files(spark, sf_dir, root):
    """Orders with all kinds of faults as files of the order and the retry topic, in the
    layout of a broker. Every tenth order comes again, hours later with other quantities,
    in another partition, where it has the smaller offset."""
    value = F.col("value")
    again = F.regexp_replace(value, '"quantity":[0-9]+', '"quantity":77')
    at = F.lit("2026-01-01").cast("timestamp") + F.make_dt_interval(mins=(F.col("o_orderkey") % 60).cast("int"))
    first = F.struct(value.alias("value"), (F.col("o_orderkey") % 3 + 1).cast("int").alias("partition"), (F.col("o_orderkey") + F.col("chunk") * 1_000_000_000_000).alias("offset"), at.alias("timestamp"))
    late = F.struct(again.alias("value"), F.lit(0).alias("partition"), F.col("chunk").alias("offset"), (at + F.expr("interval 5 hours")).alias("timestamp"))
    both = F.when(F.col("o_orderkey") % 10 == 0, F.array(first, late)).otherwise(F.array(first))
    messages = tables.faulty_messages(spark, sf_dir).select(F.col("o_orderkey").cast("string").alias("key"), F.explode(both).alias("m")).select(
        "key", "m.value", F.when(F.col("m.value").startswith('{"original":'), "orders_retry").otherwise("orders").alias("topic"), "m.partition", "m.offset", "m.timestamp"
    )
    for topic in ("orders", "orders_retry"):
        messages.where(F.col("topic") == topic).write.parquet(f"{root}/topics/{topic}/batch=first")


def _drained(spark, sf_dir):
    """Both topics through the ingest stream, again and again until no retry is left."""
    root = fresh_dir(spark, "stream")
    _message_files(spark, sf_dir, root)
    for _ in range(ingest.RETRY_MAX_ATTEMPT + 1):
        etl.run_available(spark, root, transient=F.col("attempt") > 0)
    return root


@query
def stream_order_items(spark, sf_dir):
    """What the ingest stream stored: first arrivals of the orders without a fault."""
    return etl.read_order_items(spark, f"{_drained(spark, sf_dir)}/order_items")


@query
def stream_outcomes(spark, sf_dir):
    """How the stream's messages ended, retries counted each time."""
    counted = spark.read.parquet(f"{_drained(spark, sf_dir)}/outcomes")
    return counted.groupBy("status").agg(F.sum("n").cast("bigint").alias("n"))


#: Files that each batch of the cart stream comes in.
FILES_PER_BATCH = 4


@query
def stream_cart_fold(spark, sf_dir):
    """Cart events through the stateful stream; what is left in the carts."""
    root = fresh_dir(spark, "carts")
    batches = tables.late_cart_events(spark, sf_dir)
    for batch in range(tables.CART_BATCHES + 1):
        of_batch = batches.where(F.array_contains("batches", batch)).drop("batches")
        of_batch.repartition(FILES_PER_BATCH).write.mode("append").parquet(f"{root}/events")
    return cart_stream.run_available(spark, f"{root}/events", root, max_files=FILES_PER_BATCH)


@query
def stream_cdc_table(spark, sf_dir):
    """A snapshot and two batches of changes, late and repeated ones among them; the table they leave."""
    root = fresh_dir(spark, "changes")
    log = tables.change_log(spark, sf_dir)
    for batch in range(3):
        log.where(F.array_contains("batches", batch)).select("key", "value", "topic").write.mode("append").parquet(f"{root}/messages")
    cdc_stream.run_available(spark, f"{root}/messages", root, max_files=1)
    rows = cdc_stream.current(spark, root)
    return cdc.fields(rows.withColumn("fields", cdc.row_image(F.col("after"))), CDC_FIELDS)


@query
def stream_lag_alert(spark, sf_dir):
    """The alert on a live stream: lag samples in order of time, a heartbeat after the last."""
    root = fresh_dir(spark, "lag")
    samples = tables.lag_samples(spark, sf_dir)
    last = samples.agg((F.max("ts") + F.expr("interval 1 hour")).alias("ts")).selectExpr("ts", "cast(null as string) as topic", "0L as lag")
    cuts = [F.lit(f"2024-01-{day}").cast("timestamp") for day in (11, 21)]
    for part in (samples.where(F.col("ts") < cuts[0]), samples.where((F.col("ts") >= cuts[0]) & (F.col("ts") < cuts[1])), samples.where(F.col("ts") >= cuts[1]), last):
        part.write.mode("append").parquet(f"{root}/samples")
    alerts.run_available(spark, f"{root}/samples", root)
    fired = spark.read.schema(alerts.ALERT).parquet(f"{root}/alerts").where("state = 'firing'")
    return fired.select(F.col("since").alias("window_start"), "topic", F.col("lag").alias("min_lag"))
