"""Shop-shaped views over the base tables (orders, lineitem, part, events, ...).

All views are lazy plans over the whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions import fx, money, orders as ev
from ordermill.functions.timestamps import utc_iso
from ordermill.operators.ingest import PRICE
from ordermill.session import fresh_dir

# A message is limited in size: orders of more lines are published as several events.
LINES_PER_EVENT = 64

# Display currency by customer nation, element [nation % 6].
CURRENCY_BY_NATION = ("USD", "EUR", "CAD", "JPY", "GBP", "TRY")

SHIPPING_USD_UNITS, SHIPPING_USD_NANOS = 8, 990_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(price: Column) -> Column:
    return F.round(price * 100).cast("bigint")


def _currency(nation: Column) -> Column:
    return F.element_at(F.array(*(F.lit(c) for c in CURRENCY_BY_NATION)), nation % 6 + 1)


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, event_timestamp, currency_code), one row per order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    placed = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(
        secs=(F.col("o_orderkey") % 86_400).cast("decimal(18,6)")
    )
    return orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        "o_orderkey",
        placed.alias("event_timestamp"),
        _currency(F.col("c_nationkey")).alias("currency_code"),
    )


def _line_columns() -> list[Column]:
    cents = _cents(F.col("l_extendedprice"))
    return [
        F.col("l_linenumber").alias("line"),
        F.col("l_suppkey").alias("supp"),
        F.col("l_quantity").cast("int").alias("quantity"),
        cents.alias("cents"),
    ]


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in the shape that exploding the order events gives.

    Catalyst picks the join per data size; a hot order only skews the line side,
    which AQE may split because the next shuffle is on the text keys.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", *_line_columns())
    headers = order_headers(spark, sf_dir)
    return lines.join(headers, lines.l_orderkey == headers.o_orderkey).select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        "quantity",
        "currency_code",
        (F.col("cents").cast("decimal(19,0)") * F.expr("0.01BD")).cast(money.AMOUNT).alias("unit_price"),
        "event_timestamp",
        F.to_date("event_timestamp").alias("event_date"),
        F.lit("SUCCEED").alias("status"),
        "line",
        "supp",
        "cents",
    )


LINE_ORDER = ("line", "supp", "quantity", "cents")


def reference_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row-store side of reconciliation: straight from line items, no events.

    First line per (order, product); aggregated as ``min(struct)`` so that copies
    of a line fold on the map side.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", *_line_columns())
    first = lines.groupBy("l_orderkey", "l_partkey").agg(F.min(F.struct(*LINE_ORDER)).alias("first"))
    headers = order_headers(spark, sf_dir)
    price = F.col("first.cents").cast("decimal(19,0)") * F.expr("0.01BD")
    return first.join(headers, first.l_orderkey == headers.o_orderkey).select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("first.quantity").alias("quantity"),
        "currency_code",
        price.cast(PRICE).alias("unit_price"),
        (price * F.col("first.quantity")).cast(PRICE).alias("total_price"),
        "event_timestamp",
        F.lit("SUCCEED").alias("status"),
    )


def _money_struct(currency: Column, units: Column, nanos: Column) -> Column:
    return F.struct(
        currency.alias("currency_code"), units.alias("units"), nanos.alias("nanos")
    )


def with_shipping(rows: DataFrame) -> DataFrame:
    """Adds the flat shipping price in the row's currency."""
    usd = _money_struct(
        F.lit("USD"),
        F.lit(SHIPPING_USD_UNITS).cast("bigint"),
        F.lit(SHIPPING_USD_NANOS).cast("bigint"),
    )
    return fx.with_converted(rows, usd, F.col("currency_code"), "shipping_cost")


LINE_ENTRY = "line:int,part:bigint,supp:bigint,quantity:int,cents:bigint,copies:int"


def orders_with_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order event: header columns plus an ``items`` array of all its lines.

    An order of at most :data:`LINES_PER_EVENT` lines is one event. The lines of a larger one go by line number,
    finer the larger it is, then by product, so that the first line of a
    product stays in the earliest event that holds the product; its equal lines are folded
    on the map side, and what one event can't hold of them goes to later events.
    Nothing is left out, no array holds much more than a share of its order, and no
    order's events depend on another order.
    """
    lineitem = table(spark, sf_dir, "lineitem")
    sizes = lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.max("l_linenumber").alias("lines"))
    split = F.ceil(F.col("n") / LINES_PER_EVENT)
    width = F.greatest(F.lit(1), F.floor(F.lit(LINES_PER_EVENT) / F.col("split")))
    large = sizes.where((F.col("n") > LINES_PER_EVENT) & F.col("l_orderkey").isNotNull()).withColumn("split", split).withColumn("width", width)
    large = large.select(F.col("l_orderkey").alias("key"), F.col("l_orderkey").cast("string").alias("large"), "split", "width", (F.floor((F.col("lines") - 1) / F.col("width")) + 1).alias("blocks"))
    # Kept, so that its size is known: few or no large orders are broadcast, and the lines are not shuffled for them.
    path = fresh_dir(spark, "large-orders")
    large.coalesce(8).write.parquet(path)
    large = spark.read.schema(large.schema).parquet(path)
    # The text keys give the joins with large orders exchanges of their own, so AQE may split a hot order.
    lines = lineitem.where(F.col("l_orderkey").isNotNull()).select(
        "l_orderkey", F.col("l_orderkey").cast("string").alias("_order"), F.col("l_partkey").alias("part"), *_line_columns()
    )
    headers = order_headers(spark, sf_dir).withColumn("order_id", F.col("o_orderkey").cast("string"))
    # Lines are shuffled once: what is gathered by order is dealt as the join with the headers needs it.
    entry = F.struct("line", "part", "supp", "quantity", "cents", F.lit(1).alias("copies"))
    small = (
        lines.join(large, F.col("_order") == F.col("large"), "left")
        .groupBy("l_orderkey")
        # Nulls are not collected: of a large order there is the key alone.
        .agg(F.collect_list(F.when(F.col("large").isNull(), entry)).alias("lines"), F.max(F.col("large").isNotNull()).alias("is_large"))
    )
    none = F.array().cast(f"array<struct<{LINE_ENTRY}>>")
    whole = (
        headers.join(small, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .where(~F.coalesce("is_large", F.lit(False)))
        .withColumns({"chunk": F.lit(0).cast("bigint"), "lines": F.coalesce("lines", none)})
    )
    copies = (
        lines.join(large, F.col("_order") == F.col("large"))
        .groupBy("l_orderkey", "part", *LINE_ORDER, "split", "width", "blocks")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("turn", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / LINES_PER_EVENT))))
    )
    block = F.floor((F.col("line") - 1) / F.col("width"))
    chunk = F.coalesce((F.col("turn") * F.col("blocks") + block) * F.col("split") + F.pmod("part", "split"), F.lit(0).cast("bigint"))
    here = F.least(F.lit(LINES_PER_EVENT), F.col("n") - F.col("turn") * LINES_PER_EVENT).cast("int")
    parts = copies.groupBy("l_orderkey", chunk.alias("chunk")).agg(
        F.collect_list(F.struct("line", "part", "supp", "quantity", "cents", here.alias("copies"))).alias("lines")
    )
    # Only their own headers are shuffled for the large orders.
    theirs = headers.join(large, F.col("o_orderkey") == F.col("key"), "left_semi")
    spread = parts.withColumn("order_id", F.col("l_orderkey").cast("string")).drop("l_orderkey").join(theirs, "order_id")
    item = lambda l: F.struct(
        l["part"].cast("string").alias("product_id"),
        l["quantity"].cast("bigint").alias("quantity"),
        _money_struct(
            F.col("currency_code"),
            F.floor(l["cents"] / 100).cast("bigint"),
            (l["cents"] % 100) * 10_000_000,
        ).alias("cost"),
    )
    items = F.flatten(F.transform(F.array_sort("lines"), lambda l: F.array_repeat(item(l), l["copies"])))
    columns = ["o_orderkey", "chunk", "order_id", "event_timestamp", "currency_code"]
    return with_shipping(whole.select(*columns, "lines").unionByName(spread.select(*columns, "lines")).select(*columns, items.alias("items")))


def _address(orderkey: Column) -> Column:
    return F.struct(
        F.concat(orderkey.cast("string"), F.lit(" Market Street")).alias("street_address"),
        F.lit("Springfield").alias("city"),
        F.lit("IL").alias("state"),
        F.lit("USA").alias("country"),
        F.lit(62_701).cast("bigint").alias("zip_code"),
    )


def order_events(spark: SparkSession, sf_dir: str, replays: bool = True) -> DataFrame:
    """Landed order events: ``raw`` text plus the metadata columns.

    With ``replays``, every tenth order arrives a second time, an hour later at
    a new offset, as an at-least-once broker may deliver it.
    """
    base = orders_with_items(spark, sf_dir)
    raw = ev.to_event_json(
        F.col("order_id"),
        # Events of one order are told apart by their parcel.
        F.concat(F.lit("track-"), F.col("order_id"), F.when(F.col("chunk") > 0, F.concat(F.lit("-"), F.col("chunk"))).otherwise("")),
        F.col("shipping_cost"),
        _address(F.col("o_orderkey")),
        F.col("items"),
        utc_iso(F.col("event_timestamp")),
    )
    landed = base.select(
        raw.alias("raw"),
        "o_orderkey",
        "event_timestamp",
        F.to_date("event_timestamp").alias("_event_date"),
        F.lit("orders").alias("_source_topic"),
        (F.col("o_orderkey") % 4).cast("int").alias("_kafka_partition"),
        (F.col("o_orderkey") + F.col("chunk") * 1_000_000_000_000).alias("_kafka_offset"),
        F.lit("1").alias("_schema_version"),
    )
    copies = F.when(F.col("o_orderkey") % 10 == 0, F.sequence(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    ) if replays else F.array(F.lit(0))
    return (
        landed.withColumn("_copy", F.explode(copies))
        .withColumn("_kafka_offset", F.col("_kafka_offset") + F.col("_copy") * 1_000_000_000)
        .withColumn(
            "_ingested_at",
            F.col("event_timestamp") + F.make_dt_interval(
                hours=F.col("_copy"), mins=F.lit(1)
            ),
        )
        .drop("_copy", "event_timestamp")
    )


def faulty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order event as one message; some orders carry one of eight faults.

    Columns: value, o_orderkey, chunk (the event's place in its order), target_away (the write would fail for a reason
    outside the message).
    """
    base = orders_with_items(spark, sf_dir)
    kind = F.col("o_orderkey") % 97
    when = lambda k, value, other: F.when(kind == k, value).otherwise(other)
    first = F.element_at("items", 1)

    def spoiled(product: Column, units: Column) -> Column:
        head = F.struct(
            product.alias("product_id"),
            first["quantity"].alias("quantity"),
            _money_struct(first["cost"]["currency_code"], units, first["cost"]["nanos"]).alias("cost"),
        )
        return F.concat(F.array(head), F.slice("items", 2, F.greatest(F.size("items"), F.lit(1))))

    units = first["cost"]["units"]
    has_items = F.size("items") > 0
    items = (
        F.when(has_items & (kind == 3), spoiled(F.lit(""), units))
        .when(has_items & (kind == 4), spoiled(first["product_id"], F.lit(10**12).cast("bigint")))
        .when(has_items & (kind == 5), spoiled(F.repeat(F.lit("P"), F.lit(300)), units))
        .otherwise(F.col("items"))
    )
    stamp = F.when(kind == 2, F.lit("")).when(kind == 6, F.lit("2026-13-40T99:99:99Z")).otherwise(
        utc_iso(F.col("event_timestamp"))
    )
    body = ev.to_event_json(
        when(1, F.lit(""), F.col("order_id")),
        F.concat(F.lit("track-"), F.col("order_id")),
        F.col("shipping_cost"),
        _address(F.col("o_orderkey")),
        F.col("spoiled_items"),
        stamp,
    )
    wrap = lambda attempt: F.concat(
        F.lit('{"original":'),
        F.col("body"),
        F.lit(f',"error":"Retryable DB: connection refused","attempt":{attempt},"timestamp":"2026-01-01T00:00:00Z"}}'),
    )
    return (
        base.withColumn("spoiled_items", items)
        .withColumn("body", body)
        .select(
            F.when(kind == 7, wrap(1)).when(kind == 8, wrap(3)).otherwise(F.col("body")).alias("value"),
            "o_orderkey",
            "chunk",
            kind.isin(7, 8).alias("target_away"),
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = _cents(F.col("p_retailprice"))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("name"),
        F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("description"),
        F.concat(F.lit("/images/"), F.col("p_partkey").cast("string"), F.lit(".jpg")).alias("picture_url"),
        F.floor(cents / 100).cast("bigint").alias("price_units"),
        ((cents % 100) * 10_000_000).cast("int").alias("price_nanos"),
        F.lit("USD").alias("currency_code"),
    )


def product_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bridge (product_id, category): each product's type and brand."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.explode(F.array("p_type", "p_brand")).alias("category"),
    )


def cart_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adds (clicks) and empties (purchases) per user."""
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type").isin("click", "purchase"))
        .select(
            "user_id",
            F.when(F.col("event_type") == "click", "add").otherwise("empty").alias("action"),
            F.get_json_object("props", "$.k").alias("product_id"),
            (F.col("event_id") % 10 + 1).alias("quantity"),
            F.col("ts").cast("timestamp").alias("ts"),
            "event_id",
        )
    )


CART_BATCHES = 4


def late_cart_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cart events with the ``batches`` that bring them: by quarters of the time; of a quarter's last day every
    third event comes a batch late, every fifth one twice."""
    events = cart_events(spark, sf_dir)
    at = F.unix_micros("ts")
    span = events.agg(F.min(at).alias("first"), (F.max(at) + 1 - F.min(at)).alias("span"))
    quarter = F.floor((at - F.col("first")) * CART_BATCHES / F.col("span"))
    end = F.col("first") + (F.col("_quarter") + 1) * F.col("span") / CART_BATCHES
    last_day = at >= end - 86_400_000_000
    late, twice = last_day & (F.col("event_id") % 3 == 0), last_day & (F.col("event_id") % 5 == 0)
    own = F.col("_quarter") + late.cast("int")
    return (
        events.join(F.broadcast(span), F.lit(True))  # one row
        .withColumn("_quarter", quarter)
        .withColumn("batches", F.when(twice, F.array(own, F.col("_quarter") + 1)).otherwise(F.array(own)))
        .drop("first", "span", "_quarter")
    )


def processing_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_id") % 2 == 0, "orders").otherwise("orders_retry").alias("topic"),
        F.when(F.col("event_type") == "error", "dlq")
        .when(F.col("event_type") == "signup", "retry")
        .otherwise("success")
        .alias("status"),
    )


def page_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a page request: a view is a product page, the rest has no product."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"),
        "user_id",
        F.when(F.col("event_type") == "view", F.get_json_object("props", "$.k")).alias("product_id"),
    )


# --- views for the shop and upkeep queries -------------------------------------

SNAPSHOT_TIMES = ("2024-01-31 00:00:00", "2024-01-31 00:05:00")


def user_currency(user_id: Column) -> Column:
    return _currency(user_id)


def cart_snapshots(lines: DataFrame) -> DataFrame:
    """The carts per product at two moments; the second is the newest."""
    from ordermill.operators.carts import snapshot

    once = snapshot(lines, F.lit(None).cast("timestamp")).drop("snapshot_ts")
    times = F.array(*(F.lit(t).cast("timestamp") for t in SNAPSHOT_TIMES))
    return once.withColumn("snapshot_ts", F.explode(times))


def advertisements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ads per brand: its cheapest and its dearest product."""
    best = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("category")).agg(
        F.min(F.struct("p_retailprice", "p_partkey")).alias("lo"),
        F.max(F.struct("p_retailprice", "p_partkey")).alias("hi"),
    )
    ad = lambda side, text: F.struct(
        F.concat(F.lit("/product/"), F.col(f"{side}.p_partkey").cast("string")).alias("redirect_url"),
        F.concat("category", F.lit(text)).alias("text"),
    )
    offers = F.array(ad("lo", " from our outlet"), ad("hi", " for connoisseurs"))
    return best.select("category", F.inline(offers))


def ad_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page requests with their context keys: a product page has the product's
    categories, other pages have none and meet no product."""
    requests = page_requests(spark, sf_dir)
    keys = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"), F.array("p_type", "p_brand").alias("context_keys")
    )
    pages = requests.where(F.col("product_id").isNotNull()).join(keys, "product_id", "left")
    others = requests.where(F.col("product_id").isNull()).withColumn("context_keys", F.lit(None).cast("array<string>"))
    return pages.select("request_id", "context_keys").unionByName(others.select("request_id", "context_keys"))


def checkouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One checkout per customer; some nations leave out or break one field each.

    Card numbers are made of digit pairs that each satisfy the check-digit rule,
    so a number is good unless its last pair is replaced.
    """
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    digits = F.lpad(key.cast("string"), 7, "0")
    pair = lambda i: F.concat(
        F.substring(digits, i, 1), F.translate(F.substring(digits, i, 1), "0123456789", "0864297531")
    )
    lead = F.element_at(F.array(F.lit("42"), F.lit("26"), F.lit("67"), F.lit("42")), (key % 4 + 1).cast("int"))
    last = F.when(key % 4 == 3, F.lit("01")).otherwise(pair(7))
    card = F.concat(lead, *(pair(i) for i in range(1, 7)), last)
    spoil = lambda n, value, good: F.when(nation == n, F.lit(value)).otherwise(good)
    return table(spark, sf_dir, "customer").select(
        key.alias("checkout_id"),
        spoil(0, "no address", F.concat(F.lit("buyer"), key.cast("string"), F.lit("@example.com"))).alias("email"),
        spoil(1, "long lane " * 60, F.lit("4 Harbour Row")).alias("street_address"),
        spoil(2, 0, F.lit(20_457)).alias("zip_code"),
        spoil(3, "", F.lit("Hamburg")).alias("city"),
        spoil(4, "", F.lit("HH")).alias("state"),
        spoil(5, "", F.lit("Germany")).alias("country"),
        spoil(6, "4100000000", card).alias("cc_number"),
        F.when(nation == 7, 0).when(nation == 8, 13).otherwise((key % 12 + 1).cast("int")).alias("cc_month"),
        spoil(9, 0, (key % 4 + 2023).cast("int")).alias("cc_year"),
        spoil(10, 0, F.lit(731)).alias("cc_cvv"),
    )


def change_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change events of the product table; large sizes are updates, not inserts."""
    p = products(spark, sf_dir).join(
        table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), "p_size"), "id"
    )
    wrapped = lambda kind, c: F.struct(c.alias(kind))
    row = F.struct(
        F.col("id"),
        wrapped("string", F.col("name")).alias("name"),
        wrapped("string", F.col("description")).alias("description"),
        wrapped("int", F.col("price_units")).alias("price_units"),
        wrapped("int", F.col("price_nanos")).alias("price_nanos"),
        wrapped("string", F.col("currency_code")).alias("currency_code"),
    )
    envelope = F.struct(
        F.when(F.col("p_size") <= 40, "c").otherwise("u").alias("op"),
        F.struct(row.alias("dbserver1.public.products.Value")).alias("after"),
        F.struct(F.lit("products").alias("table")).alias("source"),
    )
    return p.select(
        F.col("id").alias("key"),
        F.to_json(envelope).alias("value"),
        F.lit("dbserver1.public.products").alias("topic"),
    )


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change events of the product table with their log positions, and the batches that bring them.

    All products are in the snapshot. By size some are updated once or twice, deleted, or created again; the
    first update comes after later changes, and the snapshot and the deletes come twice.
    """
    rows = products(spark, sf_dir).join(table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), "p_partkey", "p_size"), "id")

    def event(kind: str, turn: int, batches: list[int], every: int, name: Column, units: Column) -> Column:
        text = lambda c: F.struct(c.cast("string").alias("string"))
        row = F.struct(F.col("id"), text(name).alias("name"), units.alias("price_units"), F.col("price_nanos"))
        after = F.lit(None) if kind == "d" else F.to_json(row)
        place = F.col("p_partkey") + F.lit(turn * 1_000_000_000_000)
        made = F.struct(F.lit(kind).alias("op"), place.alias("position"), after.cast("string").alias("after"), F.array(*map(F.lit, batches)).alias("batches"))
        return F.when(F.col("p_size") % every == 0, made)

    name, units = F.col("name"), F.col("price_units")
    events = F.array(
        event("r", 0, [0, 2], 1, name, units),
        event("u", 1, [2], 3, name, units + 1),
        event("u", 2, [1], 5, name, units + 2),
        event("d", 3, [0, 2], 7, name, units),
        event("c", 4, [1], 14, F.concat(F.lit("again "), name), F.lit(5).cast("bigint")),
    )
    source = F.concat(F.lit('{"table":"products","lsn":'), F.col("e.position"), F.lit("}"))
    value = F.concat(F.lit('{"op":"'), F.col("e.op"), F.lit('","after":'), F.coalesce("e.after", F.lit("null")), F.lit(',"source":'), source, F.lit("}"))
    return rows.select("id", F.explode(F.array_compact(events)).alias("e")).select(
        F.col("id").alias("key"), value.alias("value"), F.lit("dbserver1.public.products").alias("topic"), "e.batches"
    )


def csv_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed rows as text: known ids, and new ids for the large sizes."""
    key = F.col("p_partkey").cast("string")
    return table(spark, sf_dir, "part").select(
        F.when(F.col("p_size") > 40, F.concat(F.lit("N"), key)).otherwise(key).alias("_id"),
        F.concat(F.lit("new "), F.col("p_name")).alias("title"),
        F.col("p_type").alias("description"),
        F.when(F.col("p_size") == 1, "n/a").when(F.col("p_size") == 4, "NaN").when(F.col("p_size") == 5, "1e30")
        .when(F.col("p_size") == 6, "-Infinity").otherwise(F.col("p_retailprice").cast("string")).alias("price"),
        F.when(F.col("p_size") == 2, "-")
        .otherwise(F.concat(F.col("p_type"), F.lit(" > "), F.col("p_brand"), F.lit(" > ")))
        .alias("category"),
        F.when(F.col("p_size") == 3, "-")
        .otherwise(F.concat(F.lit("http://img.example.com/a/"), key, F.lit(".png?w=9, http://img.example.com/b")))
        .alias("imageUrls"),
    )


def json_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same products in the shape of the product document, priced in euro."""
    cents = _cents(F.col("p_retailprice"))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.concat(F.col("p_name"), F.lit("'s best")).alias("name"),
        F.col("p_type").alias("description"),
        F.concat(F.lit("/static/img/"), F.col("p_partkey").cast("string"), F.lit(".jpg")).alias("picture"),
        F.struct(
            F.lit("EUR").alias("currencyCode"),
            F.floor(cents / 100).cast("bigint").alias("units"),
            ((cents % 100) * 10_000_000).alias("nanos"),
        ).alias("priceUsd"),
        F.array("p_type", "p_brand").alias("categories"),
    )


def message_offsets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(end offsets, committed offsets, topics): events as messages of two topics
    in four partitions, read up to a date; partition 3 was never committed."""
    messages = table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 2 == 0, "orders").otherwise("orders_retry").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("ts"),
    )
    read = (F.col("ts") < F.lit("2024-01-20").cast("timestamp")) & (F.col("partition") != 3)
    both = messages.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("end_offset"),
        (F.max(F.when(read, F.col("offset"))) + 1).alias("committed"),
    )
    topics = spark.createDataFrame([("orders",), ("orders_retry",), ("orders_dlq",)], "topic string")
    return both.select("topic", "partition", "end_offset"), both.select("topic", "partition", "committed"), topics


def lag_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_id") % 2 == 0, "orders").otherwise("orders_retry").alias("topic"),
        F.floor(F.col("value") * 10).cast("bigint").alias("lag"),
    )
