"""Landing, bronze sync, ledger, retention, prune, orphans."""

import json
from datetime import date

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from ordermill.functions import timestamps
from ordermill.operators import bronze, landing
from ordermill.plans import increment, models, store, upkeep
from ordermill.sources import files, streams


def events(spark, *rows):
    return spark.createDataFrame(
        [(json.dumps({"order_id": o, "timestamp": t}), "orders", 0, i) for i, (o, t) in enumerate(rows)],
        "raw string, _source_topic string, _kafka_partition bigint, _kafka_offset bigint",
    )


def now():
    return F.lit("2026-10-12 00:00:00").cast("timestamp")



@pytest.mark.parametrize(
    "record, want",
    [
        ({"timestamp": "2031-03-01T00:30:00+02:00"}, "2031-02-28"),
        ({"timestamp": "2031-02-28T22:15:00-05:30"}, "2031-03-01"),
        ({"timestamp": "2031-06-30T12:00:00"}, "2031-06-30"),
        ({"event_timestamp": "2031-07-04T00:00:00Z"}, "2031-07-04"),
        ({"_event_date": "2031-08-09", "event_timestamp": "2031-07-04T00:00:00Z"}, "2031-08-09"),
        ({"timestamp": "some day"}, "2026-12-31"),
        ({"other": 1}, "2026-12-31"),
    ],
)
def test_event_date(spark, record, want):
    frame = spark.createDataFrame([(json.dumps(record),)], "raw string")
    at = F.lit("2026-12-31 08:00:00").cast("timestamp")
    assert str(frame.select(timestamps.event_date(F.col("raw"), at)).first()[0]) == want


def test_landing_splits_by_utc_date_and_replay_replaces(spark, folder):
    rows = events(spark, ("a", "2026-10-10T23:00:00Z"), ("b", "2026-10-11T01:00:00Z"))
    for _ in range(2):
        landing.land_batch(rows, folder, 0, ingested_at=now())
    manifest = landing.read_manifest(spark, f"{folder}/manifest")
    totals = {r["event_date"]: r for r in landing.manifest_totals(manifest).collect()}
    assert {d: t["rows"] for d, t in totals.items()} == {"2026-10-10": 1, "2026-10-11": 1}
    assert all(m["schema_hash"] == landing.schema_hash() and m["size_bytes"] > 0 for m in manifest.collect())
    back = files.read_landing_tree(spark, f"{folder}/data")
    assert sorted(r["raw"] for r in back.collect()) == sorted(r["raw"] for r in rows.collect())
    assert {r["_schema_version"] for r in back.collect()} == {"1"}


def test_unknown_source_defaults(spark):
    row = landing.decorate(spark.createDataFrame([("{}",)], "raw string"), now()).first()
    assert (row["_source_topic"], row["_kafka_partition"], row["_kafka_offset"]) == ("", -1, -1)
    assert row["_event_date"] == "2026-10-12"


def test_sync_is_idempotent_bounded_and_survives_a_lost_ledger(spark, folder):
    landing.land_batch(events(spark, ("a", "2026-10-10T10:00:00Z"), ("b", "2026-10-11T10:00:00Z")), folder, 0, now())
    replay = events(spark, ("a", "2026-10-10T10:00:00Z"), ("c", "bad time"))
    landing.land_batch(replay, folder, 1, now())
    table, ledger = f"{folder}/bronze", f"{folder}/ledger"
    synced = []
    while n := bronze.sync(spark, folder, table, ledger, max_files=1):
        synced.append(n)
    assert synced == [1, 1, 1, 1]
    rows = bronze.read_bronze(spark, table)
    assert sorted(r["order_id"] for r in rows.collect()) == ["a", "b", "c"]
    assert bronze.sync(spark, folder, table, ledger) == 0
    # Ledger lost: every file is met again, no row is added.
    assert bronze.sync(spark, folder, table, f"{folder}/ledger2") == 4
    assert bronze.read_bronze(spark, table).count() == 3
    health = bronze.health(bronze.read_bronze(spark, table)).first()
    assert tuple(health) == (3, 3, 0, 0)
    assert bronze.load_full(spark, folder, table, ledger) == 0
    # A first load takes all files, each event once, and leaves nothing to sync.
    assert bronze.load_full(spark, folder, f"{folder}/bronze3", f"{folder}/ledger3") == 3
    assert bronze.sync(spark, folder, f"{folder}/bronze3", f"{folder}/ledger3") == 0


def test_undated_copy_on_another_day_is_not_added(spark, folder):
    """A message dated by its arrival meets its copy on a different date."""
    table = f"{folder}/bronze"
    for batch, day in enumerate(("2026-10-12", "2026-10-13")):
        landing.land_batch(events(spark, ("x", "no time")), folder, batch, F.lit(day).cast("timestamp"))
        bronze.sync(spark, folder, table, f"{folder}/ledger")
    assert bronze.read_bronze(spark, table).count() == 1


def test_full_load_of_a_plain_date_tree(spark, folder):
    rows = landing.decorate(events(spark, ("a", "2026-10-10T10:00:00Z")), now())
    rows.write.parquet(f"{folder}/zone/data/2026/10/10")
    assert bronze.load_full(spark, f"{folder}/zone", f"{folder}/bronze", f"{folder}/ledger") == 1


def test_backfill(spark, folder):
    path = f"{folder}/bronze"
    rows = bronze.bronze_rows(landing.decorate(events(spark, ("a", "2026-10-10T10:00:00Z"), ("b", "2026-10-11T10:00:00Z")), now()))
    rows.drop("order_id", "_row_id").write.partitionBy("_event_date").parquet(path)
    table = bronze.read_bronze(spark, path)
    assert bronze.missing_generated(table).first()["n"] == 2
    assert bronze.backfill(spark, path) == 2
    fixed = bronze.read_bronze(spark, path)
    assert bronze.missing_generated(fixed).first()["n"] == 0
    assert sorted(r["order_id"] for r in fixed.collect()) == ["a", "b"]
    assert upkeep.with_columns_of(rows.drop("_row_id"), rows).where("_row_id is null").count() == 2


def test_prefix_and_bucket(spark):
    frame = spark.createDataFrame([("lg-1",), ("x",), (None,)], "order_id string")
    assert bronze.without_prefix(frame, "lg-").count() == 2
    buckets = [r[0] for r in frame.where("order_id is not null").select(bronze.bucket(F.col("order_id"))).collect()]
    assert all(0 <= b < 16 for b in buckets)


def test_manifest_documents_with_hidden_names(spark, tmp_path):
    day = tmp_path / "2026" / "10" / "10"
    day.mkdir(parents=True)
    entry = {"path": "p1", "rows": 3, "size_bytes": 9, "schema_hash": "h", "created_at": "2026-10-10T00:00:00+00:00"}
    (day / "_manifest.json").write_text(json.dumps({"dataset": "d", "schema_version": "1", "files": [entry]}))
    got = files.read_manifest_documents(spark, f"file://{tmp_path}").collect()
    assert [(r["path"], r["rows"], r["min_event_date"]) for r in got] == [("p1", 3, None)]


def test_manifest_upsert_keeps_the_latest(spark):
    row = lambda rows, at: ("p", rows, 1, "h", "d", "d", at)
    schema = "path string, rows bigint, size_bytes bigint, schema_hash string, min_event_date string, max_event_date string, created_at string"
    frame = spark.createDataFrame([row(1, "2026-01-01"), row(5, "2026-01-02")], schema)
    assert [r["rows"] for r in landing.upsert_manifest(frame).collect()] == [5]


def test_maintenance(spark, folder):
    table, ledger = f"{folder}/bronze", f"{folder}/ledger"
    for batch in range(3):
        rows = events(spark, (f"old{batch}", "2026-01-01T10:00:00Z"), (f"new{batch}", "2026-10-10T10:00:00Z"))
        landing.land_batch(rows, folder, batch, F.lit("2026-10-12").cast("timestamp"))
        bronze.sync(spark, folder, table, ledger)
    landing.write_batch(landing.decorate(events(spark, ("z", "2026-10-10T10:00:00Z")), now()), f"{folder}/data", 99)
    done = upkeep.run(spark, table, folder, ledger, date(2026, 10, 20))
    assert done["expired_days"] == 1
    left = bronze.read_bronze(spark, table)
    assert sorted(r["order_id"] for r in left.collect()) == ["new0", "new1", "new2"]
    assert upkeep.run(spark, f"{folder}/nothing", folder, ledger, date(2026, 10, 20)) == {}
    # Files written now are not old enough for either list.
    assert done["pruned"] == 0 and done["orphans"] == 0
    far = upkeep.run(spark, table, folder, ledger, date(2099, 1, 1), prune_dry_run=False)
    assert far["pruned"] == 6 and far["orphans"] == 1
    # The file that was never synced is still there.
    assert files.list_files(spark, f"{folder}/data").count() == 1


def test_zero_days_disable_retention(spark):
    frame = spark.createDataFrame([(date(2000, 1, 1),)], "_event_date date")
    today = F.lit("2026-01-01").cast("date")
    assert upkeep.kept(frame, today, 0).count() == 1
    assert upkeep.kept(frame, today, 90).count() == 0
    assert upkeep.expired_days(frame, today, 0).count() == 0


def test_pending_files_oldest_first(spark):
    manifest = spark.createDataFrame([(p,) for p in "dbca"], "path string")
    ledger = spark.createDataFrame([("b",)], "source_path string")
    pending = bronze.pending_files(manifest, ledger)
    assert sorted(r["path"] for r in pending.collect()) == ["a", "c", "d"]
    assert [r["path"] for r in bronze.next_run(pending, 2).collect()] == ["a", "c"]


def test_stream_options_and_registry_frame(spark):
    options = streams.kafka_options("b:1", ["orders", "orders_retry"], "earliest", 10)
    assert options["subscribe"] == "orders,orders_retry" and options["maxOffsetsPerTrigger"] == "10"
    with pytest.raises(ValueError):
        streams.kafka_options("b:1", ["orders"], "middle")
    ranged = streams.offset_range_options("b:1", {"t": {0: 5}}, {"t": {0: 9}})
    assert json.loads(ranged["startingOffsets"]) == {"t": {"0": 5}}
    frame = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x07body"),)], "v binary")
    row = frame.select(streams.registry_payload(F.col("v")), streams.registry_id(F.col("v"))).first()
    assert bytes(row[0]) == b"body" and row[1] == 7


def test_read_jsonl_skips_blank_lines(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text('{"a": 1}\n\n   \n{"a":  2}\n')
    assert [r[0] for r in files.read_jsonl(spark, f"file://{tmp_path}/in.jsonl").collect()] == ['{"a": 1}', '{"a":  2}']


def _files_by_day(spark, path):
    rows = spark.read.parquet(path).select("period", "_metadata.file_path").distinct().collect()
    out = {}
    for day, file in rows:
        out.setdefault(day, set()).add(file)
    return out


def test_models_from_deltas_equal_the_full_build(spark, folder):
    """Events in any order of arrival; a day that no delta touches keeps its files, a day that loses its last row goes."""
    rows = store.layers(spark, SMALL).bronze
    rows = rows.where(F.col("_event_date") < F.date_add(F.lit(rows.agg(F.min("_event_date")).first()[0]), 60))
    by_hash = F.pmod(F.xxhash64("_row_id", "_kafka_offset"), F.lit(3))
    day = rows.groupBy("_event_date").count().orderBy("count", "_event_date").first()["_event_date"]
    moved = rows.where(F.col("_event_date") == day).withColumns({"_ingested_at": F.lit("1990-01-01").cast("timestamp"), "_event_date": F.lit("1991-12-31").cast("date")})
    deltas = [rows.where(by_hash == k) for k in (2, 0, 1)] + [moved, rows.limit(0), rows.where(by_hash == 0)]
    seen = rows.limit(0)
    for delta in deltas:
        seen = seen.unionByName(delta)
        before = _files_by_day(spark, f"{folder}/silver") if delta is not deltas[0] else {}
        days = increment.apply(spark, folder, delta)
        want = models.gold_fact(models.silver_items(seen))
        got = increment.gold(spark, folder)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        after = _files_by_day(spark, f"{folder}/silver")
        assert {d: f for d, f in before.items() if d not in days} == {d: f for d, f in after.items() if d not in days}
        assert all(after[d] != before[d] for d in days if d in before and d in after)
        if delta is moved:
            assert days == [date(1991, 12, 31), day] and day not in after
        if delta is deltas[4]:
            assert days == []


def test_a_small_delta_leaves_other_rows_where_they_lie(spark, folder, monkeypatch):
    """Stored rows of orders that a delta does not name are joined by a broadcast and written without an exchange; with
    more orders than are broadcast the rows are the same."""
    rows = store.layers(spark, SMALL).bronze
    late = F.pmod(F.xxhash64("order_id"), F.lit(50)) == 0
    want = models.gold_fact(models.silver_items(rows))
    for part, most in (("few", increment.BROADCAST_ORDERS), ("many", 0)):
        monkeypatch.setattr(increment, "BROADCAST_ORDERS", most)
        written = []
        monkeypatch.setattr(increment, "_write", lambda r, path, write=increment._write: (written.append(r), write(r, path)))
        increment.apply(spark, f"{folder}/{part}", rows.where(~late), unit="year")
        increment.apply(spark, f"{folder}/{part}", rows.where(late), unit="year")
        got = increment.gold(spark, f"{folder}/{part}")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        plans = [r._jdf.queryExecution().executedPlan().toString() for r in written]
        if part == "few":
            assert sum("Exchange" in p.replace("BroadcastExchange", "") for p in plans) == 1
        monkeypatch.undo()


def test_a_first_empty_delta_writes_nothing(spark, folder):
    assert increment.apply(spark, folder, store.layers(spark, SMALL).bronze.limit(0)) == []
    assert not bronze._exists(spark, f"{folder}/silver")


def test_only_the_tables_asked_for_are_built(spark, tmp_path):
    """Bronze alone is written for a query that reads bronze alone."""
    import shutil

    for name in ("orders", "customer", "lineitem"):
        shutil.copy(f"{SMALL}/{name}.parquet", tmp_path)
    stored = store.layers(spark, str(tmp_path))
    assert stored.bronze.count() > 0
    built = lambda: [n for n in ("bronze", "silver", "quarantine", "gold") if bronze._exists(spark, f"{stored.root}/{n}")]
    assert built() == ["bronze"]
    assert stored.gold.count() > 0 and built() == ["bronze", "silver", "gold"]
