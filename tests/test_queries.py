"""Models, quality and plans; every registered query against its SQL twin."""

import datetime

import pytest
from conftest import SMALL

import __spark_entry__ as entry_module
from compare import duck, rows_of
from ordermill import oracle
from ordermill.plans import bi, models, quality, registry

@pytest.fixture(scope="module")
def sql():
    return duck(SMALL)


def test_every_query_has_a_twin():
    assert set(registry.queries()) == set(oracle.queries())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_its_twin(spark, sql, name):
    ours = entry_module.queries()[name](spark, SMALL).toArrow()
    theirs = sql.execute(entry_module.oracle_sql()[name]).to_arrow_table()
    assert rows_of(ours) == rows_of(theirs)


def test_entry_is_the_flagship(spark):
    assert entry_module.entry(spark).columns == ["event_hour", "revenue", "units", "orders"]


GOLD = "order_id string, product_id string, quantity int, currency_code string, unit_price decimal(12,2), total_price decimal(12,2), event_timestamp timestamp, event_date date, status string"


def gold(spark, *changes):
    from decimal import Decimal as D

    base = dict(order_id="o", product_id="p", quantity=3, currency_code="USD", unit_price=D("1.33"), total_price=D("4.00"),
                event_timestamp=datetime.datetime(2026, 10, 11, 5), event_date=datetime.date(2026, 10, 11), status="SUCCEED")
    return spark.createDataFrame([tuple({**base, **c}.values()) for c in changes], GOLD)


def test_suites_find_failures(spark):
    from decimal import Decimal as D

    bad = gold(spark, {}, {}, {"product_id": None}, {"order_id": "x", "quantity": 0}, {"order_id": "y", "status": "LOST"},
               {"order_id": "z", "unit_price": D("-1"), "status": "CANCELLED"})
    report = quality.gold_suite(bad)
    failed = {r["expectation"]: r["failed_rows"] for r in report.collect() if not r["success"]}
    assert failed == {"not_null:product_id": 1, "accepted:status": 1, "at_least_1:quantity": 1, "at_least_0:unit_price": 1,
                      "only_succeed:status": 2, "unique:order_id,product_id": 2}
    with pytest.raises(AssertionError, match="not_null:product_id"):
        quality.require(report)
    quality.require(quality.gold_suite(gold(spark, {})))


def test_reconciliation(spark):
    from decimal import Decimal as D

    good = gold(spark, {}, {"product_id": "q"})
    row = quality.reconcile(good, good)
    assert quality.differences(row).count() == 0
    assert quality.differences(row, expected_items=3).count() == 1
    # An empty side is a difference, not an unknown.
    assert quality.differences(quality.reconcile(good, good.limit(0))).count() == 1
    assert quality.exact("totals", row, {"fact_items": 2, "items_delta": 1}).where("not success").count() == 1
    off = quality.reconcile(gold(spark, {"total_price": D("9.99")}), good).first()
    assert off["fact_price_mismatch_rows"] == 1
    windowed = quality.by_event_date(good, "2026-10-11", "2026-10-11")
    assert windowed.count() == 2 and quality.by_timestamp(good, "2026-10-12", "2026-10-15").count() == 0
    with pytest.raises(ValueError):
        quality.by_event_date(good, "2026-1-1", "2026-10-15")


def test_build_models_and_schema_names(spark):
    from ordermill.sources import tables

    for _ in range(2):  # a rebuild replaces
        built = models.build_models(spark, tables.order_events(spark, SMALL))
    assert built == {"silver": "silver.stg_orders_items", "gold": "gold.fact_orders_items"}
    assert spark.table(built["gold"]).count() == spark.table(built["silver"]).count() == 5942
    assert models.schema_name(" gold ", "dev") == "gold" and models.schema_name(None, "dev") == "dev"


def test_top_products_order_and_limit(spark):
    rows = gold(spark, *({"product_id": f"p{i:02}", "order_id": f"o{i}"} for i in range(30)))
    top = bi.top_products(bi.product_sales(rows)).collect()
    assert [r["product_id"] for r in top] == [f"p{i:02}" for i in range(20)]


def test_rate_without_units_is_null_and_last(spark):
    rates = spark.createDataFrame([("a", None), ("b", 0.5), ("c", 1.0)], "product_id string, cart_not_paid_rate double")
    assert [r["product_id"] for r in bi.highest_rate(rates).collect()] == ["c", "b", "a"]


def plan(frame):
    return frame._jdf.queryExecution().toString()


def test_plans(spark):
    from ordermill.operators import catalog
    from ordermill.plans.registry import _fact
    from ordermill.sources import tables

    hourly = plan(bi.revenue_by_hour(_fact(spark, SMALL)))
    assert "Join" not in hourly and "unit_price" not in hourly.split("ReadSchema", 1)[1]
    assert "WindowGroupLimit" in plan(models.silver_items(tables.order_events(spark, SMALL)))
    lookup = catalog.get(tables.products(spark, SMALL), tables.product_categories(spark, SMALL), "7")
    assert "p_partkey" in plan(lookup)
    events = tables.order_events(spark, SMALL)
    parsed = plan(models.silver_items(events)).split("== Physical Plan ==")[1]
    assert parsed.count("from_json(StructField(order_id") == 1


def test_lines_are_not_shuffled_for_large_orders(spark):
    """Few large orders are broadcast, and a task's share is bounded by bytes."""
    from ordermill.session import TASK_SIZES
    from ordermill.sources import tables

    before = {k: spark.conf.get(k, None) for k in TASK_SIZES}
    try:
        entry_module.queries()["retention_kept"](spark, SMALL)
        assert {k: spark.conf.get(k) for k in TASK_SIZES} == TASK_SIZES
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    plan = tables.orders_with_items(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join [_order#" in line]
    assert joins and all("BroadcastHashJoin" in line for line in joins), joins


def test_kept_rows_are_blocked_by_hundreds(spark):
    """Memory for kept rows is asked for every 16 blocks: a block of wide rows must be small. A session's smaller blocks stay."""
    from ordermill.session import TASK_SIZES

    before = {k: spark.conf.get(k, None) for k in TASK_SIZES}
    key = "spark.sql.inMemoryColumnarStorage.batchSize"
    try:
        entry_module.queries()["retention_kept"](spark, SMALL)
        kept = spark.range(0, 5000, 1, 1).selectExpr("id", "'kept in blocks' as text").persist()
        assert kept.count() == 5000
        found = spark._jsparkSession.sharedState().cacheManager().lookupCachedData(kept._jdf)
        assert found.get().cachedRepresentation().cacheBuilder().cachedColumnBuffers().count() >= 10
        kept.unpersist()
        spark.conf.set(key, "70")
        entry_module.queries()["retention_kept"](spark, SMALL)
        assert spark.conf.get(key) == "70"
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_letters_draw_on_messages_that_were_parsed_once(spark):
    """Both topics read the refused messages as they are kept; neither builds the messages again."""
    letters = entry_module.queries()["ingest_letters"](spark, SMALL)
    assert {r["topic"] for r in letters.select("topic").distinct().collect()} == {"orders_dlq", "orders_retry"}
    assert not [f for f in letters.inputFiles() if "lineitem" in f]
