"""A third of all rows under one key: same results, and the hot side is split."""

import duckdb
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from compare import TABLES, duck, rows_of
from ordermill.sources import tables

HOT = {
    "lineitem": """
        SELECT * REPLACE (CASE WHEN l_suppkey % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey,
                          CASE WHEN l_suppkey % 9 = 0 THEN 3 ELSE l_partkey END AS l_partkey) FROM t
        UNION ALL SELECT * EXCLUDE (range) REPLACE (8 AS l_orderkey) FROM (SELECT * FROM t LIMIT 1), range(3000)""",
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey) FROM t",
    "events": """
        SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 5 ELSE user_id END AS user_id,
                          CASE WHEN event_id % 3 = 1 THEN '{"k": 42}' ELSE props END AS props) FROM t""",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in TABLES:
        query = HOT.get(name, "SELECT * FROM t").replace(" t", f" '{SMALL}/{name}.parquet'")
        columns = con.execute(f"SELECT * FROM '{SMALL}/{name}.parquet' LIMIT 0").description
        typed = ", ".join(f'"{c[0]}"' for c in columns)
        con.execute(f"COPY (SELECT {typed} FROM ({query})) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize(
    "name",
    ["silver_order_items", "bi_revenue_by_hour", "bi_top_products", "bi_cart_not_paid", "reconcile_totals",
     "ingest_routes", "bronze_rows", "bronze_health", "cart_fold", "cart_totals", "order_totals",
     "recommendations", "ads_for_request", "chosen_ads", "stream_cart_fold", "order_event_items", "quarantine",
     "quality_report_faulty", "reconcile_differences"],
)
def test_same_results(spark, skewed, name):
    ours = entry_module.queries()[name](spark, skewed).toArrow()
    theirs = duck(skewed).execute(entry_module.oracle_sql()[name]).to_arrow_table()
    assert rows_of(ours) == rows_of(theirs)


@pytest.mark.parametrize(
    "frame_of, joined_on",
    [(tables.order_events, "order_id"), (tables.order_lines, "l_orderkey"), (entry_module.queries()["cart_fold"], "_user")],
)
def test_hot_side_of_the_join_is_split(spark, skewed, frame_of, joined_on):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "20000",
        # The rule must hold without being forced.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        source = _many_files(spark, skewed)
        frame = frame_of(spark, source)
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert f"SortMergeJoin(skew=true) [{joined_on}" in plan, [l for l in plan.splitlines() if "SortMergeJoin" in l]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _many_files(spark, folder):
    """Several map outputs per table: AQE splits a partition between them."""
    out = folder + "-files"
    for name in ("lineitem", "orders", "customer", "events", "part"):
        target = f"{out}/{name}.parquet"
        spark.read.parquet(f"{folder}/{name}.parquet").repartition(6).write.mode("overwrite").option(
            "partitionOverwriteMode", "static"
        ).parquet(target)
    return out


def test_an_order_of_many_lines_keeps_them_all(spark, skewed):
    """3 000 copies of a line, and an order with a third of all lines: nothing is lost, no event holds much."""
    events = entry_module.queries()["order_event_items"](spark, skewed).where("_kafka_offset % 1000000000000 < 1000000000")
    lines = spark.read.parquet(f"{skewed}/lineitem.parquet").where("l_orderkey in (7, 8)").groupBy("l_orderkey").count()
    per_order = events.groupBy("order_id").agg({"items": "sum", "*": "count"}).where("order_id in ('7', '8')")
    assert {int(r["order_id"]): r["sum(items)"] for r in per_order.collect()} == {r["l_orderkey"]: r["count"] for r in lines.collect()}
    assert events.agg({"items": "max"}).first()[0] <= 300


def test_silver_joins_lines_to_headers_once(spark):
    plan = tables.orders_with_items(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Join Inner, (order_id" in line for line in plan.splitlines()) == 1


def test_a_large_order_leaves_the_others_whole(spark, tmp_path):
    """One order of 3 000 lines comes in many events, in line order; every other order stays one event."""
    import shutil

    for name in ("orders", "customer"):
        shutil.copy(f"{SMALL}/{name}.parquet", tmp_path)
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    large = lines.agg(F.min("l_orderkey")).first()[0]
    more = lines.where(F.col("l_orderkey") != large).limit(1).crossJoin(spark.range(3000)).withColumns(
        {"l_orderkey": F.lit(large).cast(lines.schema["l_orderkey"].dataType), "l_linenumber": (F.col("id") + 10).cast(lines.schema["l_linenumber"].dataType),
         "l_partkey": (F.col("id") % 7 + 1).cast(lines.schema["l_partkey"].dataType)}
    )
    lines.unionByName(more.select(*lines.columns)).write.parquet(f"{tmp_path}/lineitem.parquet")
    events = tables.orders_with_items(spark, str(tmp_path)).select("o_orderkey", "chunk", F.size("items").alias("n")).collect()
    parts = [r for r in events if r["o_orderkey"] == large]
    assert len(parts) > 40 and sum(r["n"] for r in parts) == 3000 + lines.where(F.col("l_orderkey") == large).count() and max(r["n"] for r in parts) <= 64
    others = [r for r in events if r["o_orderkey"] != large]
    assert len({r["o_orderkey"] for r in others}) == len(others) and all(r["chunk"] == 0 for r in others)


def test_lines_are_shuffled_once_for_the_order_events(spark):
    """Lines gathered by order are dealt as the join with the headers needs them."""
    plan = tables.orders_with_items(spark, SMALL)
    plan.collect()
    final = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    dealt = [line for line in final.splitlines() if " Exchange hashpartitioning(" in line and "l_orderkey" in line]
    assert len(dealt) == 1, dealt


def test_orders_without_lines_and_null_keys(spark, tmp_path):
    """An order without lines is an empty event, one with a null key too; lines with a null key belong to none; a key
    that orders share gives each its lines."""
    customers = spark.read.parquet(f"{SMALL}/customer.parquet")
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    first = [r[0] for r in orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left_semi").select("o_orderkey").orderBy("o_orderkey").limit(4).collect()]
    customers.write.parquet(f"{tmp_path}/customer.parquet")
    few = orders.where(F.col("o_orderkey").isin(first))
    kind = orders.schema["o_orderkey"].dataType
    few.unionByName(few.where(F.col("o_orderkey") == first[1])).unionByName(few.where(F.col("o_orderkey") == first[2]).withColumn("o_orderkey", F.lit(None).cast(kind))).write.parquet(f"{tmp_path}/orders.parquet")
    key = F.when(F.col("l_orderkey") != first[3], F.col("l_orderkey"))
    lines.where(F.col("l_orderkey").isin(first)).withColumn("l_orderkey", key).write.parquet(f"{tmp_path}/lineitem.parquet")
    size = {r["l_orderkey"]: r["count"] for r in lines.groupBy("l_orderkey").count().collect()}
    got = sorted(((r["o_orderkey"], r["n"]) for r in tables.orders_with_items(spark, str(tmp_path)).select("o_orderkey", F.size("items").alias("n")).collect()), key=str)
    assert got == sorted([(first[0], size[first[0]]), (first[1], size[first[1]]), (first[1], size[first[1]]), (first[2], size[first[2]]), (first[3], 0), (None, 0)], key=str)
