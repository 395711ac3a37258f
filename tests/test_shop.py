"""Carts, catalogue, feeds, screening, suggestions, vectors, change events."""

import json
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermill.functions import cart_blob
from ordermill.operators import (
    carts, catalog, cdc, checkout, feeds, monitoring, screening, suggest, vectors,
)
from ordermill.sources import files


def ts(text):
    return F.lit(text).cast("timestamp")


# --- carts -----------------------------------------------------------------------


def cart_frame(spark, rows):
    frame = spark.createDataFrame(rows, "user_id bigint, action string, product_id string, quantity bigint, t string, event_id bigint")
    return frame.withColumn("ts", F.col("t").cast("timestamp")).drop("t")


def test_fold_adds_sum_and_empty_clears(spark):
    at = "2024-01-01 00:00:0{}".format
    rows = [
        (1, "add", "p", 1, at(1), 1),
        (1, "add", "p", 1, at(2), 2),
        (2, "add", "p", 5, at(1), 3),
        (2, "empty", None, 0, at(2), 4),
        (2, "add", "q", 3, at(2), 5),
        (3, "add", "z", 4, at(3), 6),
        (3, "empty", None, 0, at(3), 7),
    ]
    got = {(r["user_id"], r["product_id"]): r["quantity"] for r in carts.fold(cart_frame(spark, rows)).collect()}
    assert got == {("1", "p"): 2, ("2", "q"): 3}


def varint(n):
    n &= (1 << 64) - 1
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def part(number, content):
    return varint(number * 8 + 2) + varint(len(content)) + content


def cart(user, *lines):
    """A cart written by hand; a quantity of None is left out."""
    body = [part(2, part(1, p.encode()) + (b"" if q is None else varint(16) + varint(q))) for p, q in lines]
    return part(1, user.encode()) + b"".join(body)


def test_blob_decoding(spark):
    lines = [("tea", 2), ("", 5), ("cup", None), ("owed", -3), ("saucer é", 70_000)]
    whole = cart("ann", *lines)
    twice = part(2, part(1, b"first") + part(1, b"second") + varint(16) + varint(1) + varint(16) + varint(9))
    dump = {
        "whole": whole,
        "unknown": b"\x20\x01" + whole + varint(9 * 8 + 1) + bytes(8) + varint(10 * 8 + 5) + bytes(4) + part(11, b"?"),
        "several": cart("bob", ("pot", 1)) + cart("bob", ("lid", 2)),
        "last wins": twice,
        "cut": whole[:-1],
        "cut inside": part(2, part(1, b"tea")[:-1]),
        "group": b"\x13",
        "endless": b"\x10" + b"\xff" * 12,
        "no text": part(2, part(1, b"\xff\xfe")),
        "long length": b"\x12\xff\xff\xff\xff\xff\xff\xff\xff\x7f",
        "none": b"",
        "null": None,
    }
    frame = spark.createDataFrame([(k, None if v is None else bytearray(v)) for k, v in dump.items()], "key string, value binary")
    for rows in (frame, frame.repartition(3)):
        decoded = carts.decode_blobs(rows)
        assert tuple(carts.scan_report(decoded).first()) == (4, 6)
        items = {r["key"]: [tuple(i) for i in r["items"]] for r in decoded.where("not malformed").collect()}
        want = [(p, q or 0) for p, q in lines]
        assert items == {"whole": want, "unknown": want, "several": [("pot", 1), ("lid", 2)], "last wins": [("second", 9)]}
    snap = {r["product_id"]: (r["units_in_cart"], r["carts_with_product"]) for r in carts.snapshot(carts.blob_lines(decoded), ts("2026-01-01")).collect()}
    assert snap == {"tea": (4, 2), "saucer é": (140_000, 2), "pot": (1, 1), "lid": (2, 1), "second": (9, 1)}
    assert carts.decode_blobs(frame.limit(0)).count() == 0


def test_encoded_carts_are_the_same_bytes(spark):
    rows = [("u", [("p", 200), ("x" * 300, 1), ("é", 0)]), ("v", [])]
    frame = spark.createDataFrame(rows, "user string, items array<struct<product_id:string,quantity:bigint>>")
    got = {r[0]: bytes(r[1]) for r in frame.select("user", cart_blob.encode(F.col("user"), F.col("items"))).collect()}
    assert got == {"u": cart("u", ("p", 200), ("x" * 300, 1), ("é", None)), "v": cart("v")}


def test_snapshot_upsert_and_retention(spark, folder):
    schema = "snapshot_ts timestamp, product_id string, units_in_cart bigint, carts_with_product bigint"
    at = lambda day: spark.sql(f"select timestamp'2024-01-{day} 00:00:00' t").first()["t"]
    stored = spark.createDataFrame([(at("01"), "a", 1, 1), (at("08"), "a", 1, 1), (at("15"), "a", 1, 1)], schema)
    new = spark.createDataFrame([(at("15"), "a", 9, 2), (at("15"), "b", 3, 1)], schema)
    kept = carts.upsert_snapshots(stored, new, ts("2024-01-15"))
    got = sorted((r["snapshot_ts"].day, r["product_id"], r["units_in_cart"]) for r in kept.collect())
    assert got == [(8, "a", 1), (15, "a", 9), (15, "b", 3)]
    for rows, when in ((stored.limit(1), "2024-01-01 00:00:00"), (new, "2024-01-15 00:00:00"), (new, "2024-01-15 00:00:00")):
        carts.store_snapshot(spark, f"{folder}/snap", rows, when)
    table = spark.read.parquet(f"{folder}/snap")
    assert sorted((r["product_id"], r["units_in_cart"]) for r in table.collect()) == [("a", 9), ("b", 3)]


# --- catalogue and feeds -----------------------------------------------------------


def product_frame(spark, rows):
    return spark.createDataFrame(
        [(i, n, d, "/p", 1, 0, "USD") for i, n, d in rows],
        "id string, name string, description string, picture_url string, price_units bigint, price_nanos int, currency_code string",
    )


def test_search_lookup_and_page(spark):
    products = product_frame(spark, [("abc001", "Alpha One", "x"), ("abc002", "Delta", "ALPHA two"), ("abc003", "Beta", "50% off"), ("abc004", "Gamma", "y")])
    bridge = spark.createDataFrame([("abc001", "b"), ("abc001", "a")], "product_id string, category string")
    found = catalog.search(products, bridge, "alpha").collect()
    assert sorted(r["id"] for r in found) == ["abc001", "abc002"]
    assert {r["id"]: r["categories"] for r in found} == {"abc001": "a,b", "abc002": ""}
    assert catalog.search(products, bridge, "0% o").count() == 1
    assert catalog.search(products, bridge, "%", literal=True).count() == 1
    assert catalog.search(products, bridge, "%").count() == 4
    assert catalog.get(products, bridge, "abc003").first()["name"] == "Beta"
    assert catalog.get(products, bridge, "nope").count() == 0
    pages = [sorted(r["id"] for r in catalog.page(products, bridge, n, size=2).collect()) for n in (0, 1, 2, 3)]
    assert pages == [["abc001", "abc002", "abc003"], ["abc001", "abc002", "abc003"], ["abc003", "abc004"], []]
    assert catalog.has_next(catalog.page(products, bridge, 1, 2), 2).first()[0]


def test_feeds(spark, tmp_path):
    (tmp_path / "feed.csv").write_text(
        '_id,title,description,price,category,imageUrls\n'
        'a1,"Shoe, red","line 1\nline 2",12.5,Men > Shoes > ,"http://x/y/z.png?s=1, http://b"\n'
        'a2,,-,n/a,-,-\n'
        ',ghost,d,1,c,u\n'
        'a3,Cap,d,3,Men,local.png\n'
        'a4,Hat,d,0.99,Men,http://x/\n'
    )
    feed = feeds.from_csv_feed(files.read_products_csv(spark, f"file://{tmp_path}/feed.csv"))
    got = {r["id"]: r for r in feed.collect()}
    assert set(got) == {"a1", "a2", "a3", "a4"}
    assert got["a1"]["name"] == "Shoe, red" and got["a1"]["description"] == "line 1\nline 2"
    assert (got["a1"]["price_units"], got["a1"]["price_nanos"]) == (12, 500_000_000)
    assert got["a1"]["categories"] == ["Men", "Shoes"] and got["a1"]["picture_url"] == "/images/z.png"
    assert got["a2"]["categories"] == [] and got["a2"]["picture_url"] == "" and got["a2"]["price_units"] == 0
    assert got["a3"]["picture_url"] == "local.png" and got["a4"]["picture_url"] == "/images/img_a4.jpg"

    stored = product_frame(spark, [("a1", "old", "old")]).withColumn("currency_code", F.lit("GBP"))
    by_id = lambda frame: {r["id"]: r for r in frame.collect()}
    kept = by_id(feeds.upsert_products(stored, feed, keep_currency=True))
    assert kept["a1"]["currency_code"] == "GBP" and kept["a1"]["name"] == "Shoe, red" and kept["a3"]["currency_code"] == "USD"
    assert by_id(feeds.upsert_products(stored, feed, keep_currency=False))["a1"]["currency_code"] == "USD"

    twice = feed.where("id = 'a3'").unionByName(feed.where("id = 'a3'").withColumn("name", F.lit("Cap 2"))).coalesce(1)
    assert by_id(feeds.upsert_products(stored, twice, keep_currency=True))["a3"]["name"] == "Cap 2"

    none = spark.createDataFrame([], "id bigint, name string")
    names = feeds.new_categories(none, feed)
    assert sorted(r["name"] for r in names.collect()) == ["Men", "Shoes"]
    assert feeds.new_categories(names, feed).count() == 0
    empty = spark.createDataFrame([], "product_id string, category_id bigint")
    rows = feeds.new_bridge_rows(empty, feed, names)
    assert rows.count() == 4 and feeds.new_bridge_rows(rows, feed, names).count() == 0


def test_json_feed_and_vector_export(spark, tmp_path):
    document = {"products": [{"id": "p", "name": "It's", "description": "d'e", "picture": "/static/img/products/a.jpg",
                              "priceUsd": {"currencyCode": "USD", "units": 19}, "categories": ["x", "y"]}]}
    (tmp_path / "products.json").write_text(json.dumps(document, indent=1))
    products = files.read_products_json(spark, f"file://{tmp_path}/products.json")
    row = feeds.from_json_feed(products).first()
    assert (row["picture_url"], row["price_units"], row["price_nanos"]) == ("/images/a.jpg", 19, 0)
    flat = catalog.vector_export(products).first()
    assert (flat["name"], flat["description"], flat["categories"]) == ("Its", "de", "x,y")


def test_other_readers(spark, tmp_path):
    (tmp_path / "fx.json").write_text(json.dumps({"EUR": "1.0", "USD": "1.1305"}, indent=2))
    rates = files.read_fx_rates(spark, f"file://{tmp_path}/fx.json")
    assert sorted(map(tuple, rates.collect())) == [("EUR", "1.0"), ("USD", "1.1305")]
    spark.createDataFrame([("k", bytearray(b"x"))], "key string, value binary").write.parquet(f"file://{tmp_path}/dump")
    assert files.read_cart_dump(spark, f"file://{tmp_path}/dump").count() == 1


# --- prices ---------------------------------------------------------------------


def test_quote_and_order_total(spark):
    lines = spark.createDataFrame([("a", 4), ("b", 0)], "order_id string, quantity int")
    got = {r["order_id"]: (r["units"], r["nanos"]) for r in checkout.quote(lines, "order_id").collect()}
    assert got == {"a": (8, 990_000_000), "b": (0, 0)}
    items = spark.createDataFrame(
        [("a", "USD", "0.999999999", None), ("a", None, "2.000000002", None), ("a", "USD", None, "8.99"), ("m", "USD", "1", "1"), ("m", "EUR", "1", None)],
        "order_id string, currency_code string, a string, s string",
    ).select("order_id", "currency_code", F.col("a").cast("decimal(38,9)").alias("amount"), F.col("s").cast("decimal(28,9)").alias("shipping"))
    rows = {r["order_id"]: r for r in checkout.order_total(items).collect()}
    assert (rows["a"]["units"], rows["a"]["nanos"], rows["a"]["error"]) == (11, 990_000_001, None)
    assert rows["m"]["units"] is None and rows["m"]["error"] == "mismatching currency codes"


def test_missing_product_fails_the_cart(spark):
    lines = spark.createDataFrame([("u", "a", 2), ("u", "gone", 1), ("v", "a", 3)], "user_id string, product_id string, quantity bigint")
    priced = checkout.price_lines(lines, product_frame(spark, [("a", "n", "d")]), F.lit("USD"))
    rows = {r["user_id"]: r for r in checkout.cart_totals(priced).collect()}
    assert rows["u"]["units"] is None and "gone" in rows["u"]["error"] and rows["u"]["cart_size"] == 3
    assert (rows["v"]["units"], rows["v"]["nanos"]) == (3, 0)


# --- suggestions -------------------------------------------------------------------


def test_recommendations(spark):
    shelf = spark.createDataFrame([(f"p{i}",) for i in range(8)], "product_id string")
    requests = spark.createDataFrame([("r1",), ("r2",), ("r3",)], "request_id string")
    held = [("r1", "p0"), ("r1", "p1"), ("r1", "elsewhere")] + [("r3", f"p{i}") for i in range(6)]
    baskets = spark.createDataFrame(held, "request_id string, product_id string")
    first, again = (sorted(map(tuple, suggest.recommend(requests, baskets, shelf, seed=1).collect())) for _ in range(2))
    assert first == again
    of = lambda r: [x for x in first if x[0] == r]
    assert len(of("r1")) == 5 and not {"p0", "p1"} & {x[2] for x in of("r1")}
    assert len({x[2] for x in of("r2")}) == 5 and sum(x[3] for x in of("r2")) == 4
    assert {x[2] for x in of("r3")} == {"p6", "p7"} and [x[1] for x in of("r3")] == [1, 2]
    wide = spark.range(5000).selectExpr("cast(id as string) product_id")
    assert suggest.recommend(requests, baskets, wide).count() == 15
    assert suggest.recommend(requests, baskets, wide.limit(0)).count() == 0


@pytest.mark.parametrize("size", [1, 2, 7, 100, 1010])
def test_permutations_reach_every_number_once(spark, size):
    keyed = spark.range(3).select(F.array(*(F.xxhash64("id", F.lit(k)) % 2**27 + 2**27 for k in range(4))).alias("keys"))
    steps = keyed.crossJoin(spark.range(size).withColumnRenamed("id", "step"))
    reached = steps.groupBy("keys").agg(F.array_sort(F.collect_list(suggest.permuted(F.col("step"), F.lit(size), F.col("keys")))).alias("all"))
    assert [r["all"] for r in reached.collect()] == [list(range(size))] * 3


def test_samples_overlap_as_chance_has_it(spark):
    shelf = spark.range(100).selectExpr("cast(id as string) product_id")
    requests = spark.range(400).selectExpr("concat('u', id) request_id")
    drawn: dict = {}
    for r in suggest.recommend(requests, requests.selectExpr("request_id", "'none' product_id").limit(0), shelf, seed=3).collect():
        drawn.setdefault(r["request_id"], set()).add(int(r["product_id"]))
    sets = list(drawn.values())
    shared = [len(a & b) for k, a in enumerate(sets) for b in sets[:k]]
    # Five of a hundred twice: a quarter of a product in common, and hardly ever more than two.
    assert all(len(s) == 5 for s in sets) and abs(np.mean(shared) - 0.25) < 0.02 and np.mean(np.array(shared) > 2) < 0.002
    chosen = np.bincount([x for s in sets for x in s], minlength=100)
    assert chosen.min() > 4 and chosen.max() < 45


def test_ads(spark):
    ads = spark.createDataFrame(
        [("clothing", "/product/1", "tank top"), ("kitchen", "/product/2", "jar"), ("kitchen", "/product/3", "mug")],
        "category string, redirect_url string, text string",
    )
    requests = spark.createDataFrame(
        [(1, ["kitchen", "clothing", "kitchen"]), (2, []), (3, ["none"]), (4, None)], "request_id bigint, context_keys array<string>"
    )
    got = suggest.ads_for(requests, ads, seed=3)
    rows = sorted((r["request_id"], r["key_pos"], r["text"], r["fallback"]) for r in got.collect())
    assert [r[:3] for r in rows if r[0] == 1] == [(1, 0, "jar"), (1, 0, "mug"), (1, 1, "tank top"), (1, 2, "jar"), (1, 2, "mug")]
    for request in (2, 3, 4):
        assert len([r for r in rows if r[0] == request]) == 2 and all(r[3] for r in rows if r[0] == request)
    chosen = suggest.choose_ad(got, seed=3).collect()
    assert sorted(r["request_id"] for r in chosen) == [1, 2, 3, 4]


def test_nearest_equals_brute_force_in_any_number_of_blocks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(300, 16)).astype(np.float32)
    data[17] = data[42]  # a tie
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id bigint, embedding array<float>").repartition(5)
    asked = rng.normal(size=(7, 16))
    asked[3] = data[42]
    queries = spark.createDataFrame([(q, v.tolist()) for q, v in enumerate(asked)], "query_id bigint, query array<double>")
    wide = data.astype(np.float64)
    scores = (wide @ asked.T) / (np.linalg.norm(wide, axis=1)[:, None] * np.linalg.norm(asked, axis=1))
    for rows, block in ((8_192, 256), (50, 3)):
        monkeypatch.setattr(vectors, "ROWS_PER_BLOCK", rows)
        monkeypatch.setattr(vectors, "QUERIES_PER_BLOCK", block)
        got = {}
        for r in vectors.nearest(frame, queries, 6).collect():
            got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
        for q in range(7):
            want = sorted(range(300), key=lambda i: (-round(scores[i, q], 12), i))[:6]
            assert [got[q][k] for k in range(1, 7)] == want
    assert vectors.nearest(frame, queries.limit(0), 3).count() == 0


def test_vectors_without_direction_take_no_part(spark):
    odd = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, [0.6, 0.8]), (3, None), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, [0.0, 1.0])]
    frame = spark.createDataFrame(odd, "vec_id bigint, embedding array<double>")
    queries = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None)], "query_id bigint, query array<double>")
    for k, want in ((1, [0]), (2, [0, 2]), (9, [0, 2, 6])):
        assert [(r["query_id"], r["vec_id"]) for r in vectors.nearest(frame, queries, k).orderBy("rank").collect()] == [(0, v) for v in want]


def test_index_gives_the_same_neighbours_with_far_fewer_pairs(spark, monkeypatch):
    """Clusters, one of them a third of all rows and full of copies; several blocks a cell."""
    rng = np.random.default_rng(8)
    middles = rng.normal(size=(30, 24))
    own = np.concatenate([np.zeros(500, int), rng.integers(1, 30, 1000)])
    data = middles[own] + 0.05 * rng.normal(size=(1500, 24))
    data[:200] = data[0]
    rows = [(i, v.tolist()) for i, v in enumerate(data)] + [(9001, [0.0] * 24), (9002, None)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    asked = np.concatenate([data[[0, 3, 600, 900]], rng.normal(size=(4, 24))])
    queries = spark.createDataFrame([(q, v.tolist()) for q, v in enumerate(asked)] + [(50, [0.0] * 24)], "query_id bigint, query array<double>")
    want = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in vectors.nearest(frame, queries, 7).collect())
    monkeypatch.setattr(vectors, "ROWS_PER_BLOCK", 90)
    monkeypatch.setattr(vectors, "QUERIES_PER_BLOCK", 3)
    index = vectors.Index.build(frame)
    got = index.nearest(queries, 7).collect()
    assert index.counts.sum() == 1500 and sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == want
    compared = {r["query_id"]: r["compared"] for r in got}
    assert len(compared) == 8 and all(compared[q] < 750 for q in range(4))
    # One row per query stands here: fewer rows than asked for, and none at all.
    few = vectors.Index.build(frame.where("vec_id < 3")).nearest(queries, 7)
    assert {tuple(r) for r in few.groupBy("query_id").count().collect()} == {(q, 3) for q in range(8)}
    assert vectors.Index.build(frame.where("vec_id > 9000")).nearest(queries, 7).count() == 0
    assert index.nearest(queries.limit(0), 7).count() == 0


# --- screening --------------------------------------------------------------------

SOUND = {"email": "rosa.lind@post.example.org", "street_address": "Kirkgate 9", "zip_code": 55_120, "city": "Mainz", "state": "RP", "country": "Germany",
         "cc_number": "4539578763621486", "cc_month": 11, "cc_year": 2031, "cc_cvv": 217}
# What each rule refuses.
REFUSED = {
    "cc_cvv": [0], "email": ["", "rosa.lind", "@post.example.org"], "zip_code": [0], "city": [""], "country": [""], "state": [""],
    "street_address": ["", "K" * 600], "cc_month": [-2, 0, 13, 40], "cc_year": [0], "cc_number": ["", "4539578763621487", "45395787"],
}


def test_checkout_rules(spark):
    broken = [(k, v) for k, values in REFUSED.items() for v in values]
    rows = [SOUND] + [{**SOUND, k: v} for k, v in broken]
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) else 'bigint'}" for k, v in SOUND.items())
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    screened = screening.screen(frame, screening.checkout_error())
    assert [r["first_error"] for r in screened.collect()] == [None] + [k for k, _ in broken]
    good, bad = screening.split(screened)
    assert (good.count(), bad.count()) == (1, len(broken))


def test_cart_and_currency_rules(spark):
    frame = spark.createDataFrame([(1, "p"), (10, "p"), (0, "p"), (11, "p"), (5, "")], "quantity bigint, product_id string")
    got = [r["first_error"] for r in screening.screen(frame, screening.cart_error()).collect()]
    assert got == [None, None, "quantity", "quantity", "product_id"]
    money = spark.createDataFrame([("EUR",), ("eur",), ("",), (None,)], "currency string")
    assert [r["first_error"] for r in screening.screen(money, screening.currency_error()).collect()] == [None] + ["currency"] * 3


def test_cards(spark):
    rows = [("4432801561520454", 1, 2030), ("4432-8015-6152-0454", 12, 2029), ("4432801561520455", 1, 2030),
            ("378282246310005", 1, 2030), ("5555555555554444", 5, 2025), ("5555555555554444", 6, 2025)]
    frame = spark.createDataFrame(rows, "cc_number string, cc_month bigint, cc_year bigint")
    got = screening.screen(frame, screening.card_error(2025, 6)).select("first_error", screening.last_four(F.col("cc_number"))).collect()
    assert [r[0] for r in got] == [None, None, "invalid", "unaccepted", "expired", None]
    assert got[0][1] == "0454"


# --- change events ------------------------------------------------------------------


def test_change_events(spark):
    nested = {"op": "c", "after": {"orderdb.analytics.order_items.Value": {"order_id": "o", "quantity": {"int": 2}, "note": None}}}
    plain = {"op": "c", "before": None, "after": {"order_id": {"string": "p"}, "quantity": 3}}
    rows = [("orderdb.analytics.order_items", json.dumps(nested)), ("other", json.dumps(plain)),
            ("t", json.dumps({"op": "u", "after": {"order_id": "x"}})), ("t", "no json")]
    frame = spark.createDataFrame([("k", t, v) for t, v in rows], "key string, topic string, value string")
    got = cdc.fields(cdc.changes(frame), ["order_id", "quantity", "note"])
    values = sorted((r["topic"], r["order_id"], r["quantity"], r["note"]) for r in got.collect())
    assert values == [("cdc_order_items", "o", "2", None), ("other", "p", "3", None)]
    probes = spark.createDataFrame([("o", 2), ("p", 4)], "order_id string, quantity int")
    assert [r["order_id"] for r in cdc.captured(probes, got, ["order_id", "quantity"]).collect()] == ["o"]


# --- monitoring ---------------------------------------------------------------------


def test_lag(spark):
    ends = spark.createDataFrame([("orders", 0, 100), ("orders", 1, 50)], "topic string, partition int, end_offset bigint")
    done = spark.createDataFrame([("orders", 0, 90), ("orders", 1, None)], "topic string, partition int, committed bigint")
    topics = spark.createDataFrame([("orders",), ("missing",)], "topic string")
    assert dict(map(tuple, monitoring.lag(ends, done, topics).collect())) == {"orders": 60, "missing": 0}


def test_sliding_counts_and_alerts(spark):
    rows = [("2024-01-01 00:00:07", "dlq"), ("2024-01-01 00:00:09", "dlq"), ("2024-01-01 00:04:59", "success")]
    frame = spark.createDataFrame(rows, "t string, status string").select(F.col("t").cast("timestamp").alias("ts"), "status", F.lit("orders").alias("topic"))
    windows = monitoring.alert_dead_letters(frame).collect()
    assert len(windows) == 20 and {r["n"] for r in windows} == {2}
    rates = monitoring.rate_by_status(frame).where("status = 'success'").collect()
    assert len(rates) == 20 and {r["per_second"] for r in rates} == {1 / 300}
    fresh = monitoring.freshness(frame, ts("2024-01-01 01:04:58")).first()
    assert fresh["age_seconds"] == 3599.0 and fresh["in_sla"]
    samples = spark.createDataFrame([("2024-01-01 00:00:00", 500), ("2024-01-01 00:04:00", 200)], "t string, lag bigint")
    samples = samples.select(F.col("t").cast("timestamp").alias("ts"), F.lit("orders").alias("topic"), "lag")
    # Two samples say nothing of the time between a window's first and last step.
    assert monitoring.alert_lag(samples).count() == 0
    steps = [(f"2024-01-01 00:{m:02}:{s:02}", 500 if m < 6 else 200) for m in range(8) for s in (0, 15, 30, 45)]
    steady = spark.createDataFrame(steps, "t string, lag bigint").select(F.col("t").cast("timestamp").alias("ts"), F.lit("orders").alias("topic"), "lag")
    held = [r["window_start"].strftime("%M:%S") for r in monitoring.alert_lag(steady).orderBy("window_start").collect()]
    assert held == ["00:00", "00:15", "00:30", "00:45", "01:00"]


def test_substring_index_equals_like(spark):
    from ordermill.operators import substring

    texts = ["Red gauze", "RED GXZ", "a", "", None, "éclair au café", "100% wool_blend", "aaaa", "ab ab"]
    asked = ["red", "d g_z", "%", "", "_", "a", "É", "CAFÉ", "0%w", "ab%ab", "aa_a", "zzz", "l_b", None, "abc" * 5]
    frame = spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)], "id string, text string")
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id int, query string")
    got = {tuple(r) for r in substring.search(queries, frame, substring.postings(frame)).collect()}
    pattern = lambda q: "(?s).*" + "".join({"%": ".*", "_": "."}.get(c, re.escape(c)) for c in q.lower()) + ".*"
    want = {(k, str(n)) for k, q in enumerate(asked) if q is not None for n, t in enumerate(texts) if t is not None and re.fullmatch(pattern(q), t.lower())}
    assert got == want
    plan = substring.search(queries, frame, substring.postings(frame))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan and "LIKE" in plan.upper()


def test_equal_searches_and_texts_are_verified_once(spark):
    """Ids with equal texts, and some with several, against repeated searches: all pairs, each once, in many tasks."""
    from ordermill.operators import substring

    rows = [(str(k), f"text {k % 3}") for k in range(2500)] + [("7", "other"), ("8", "text 2"), (None, "text 0"), ("9", None)]
    asked = [(k, ("t 1", "T_2", "oth%r", None)[k % 4]) for k in range(40)] + [(1, "t 0"), (0, "t 1")]
    frame = spark.createDataFrame(rows, "id string, text string").persist()
    found = substring.search(spark.createDataFrame(asked, "query_id int, query string"), frame, substring.postings(frame))
    holds = {"t 0": {"text 0"}, "t 1": {"text 1"}, "T_2": {"text 2"}, "oth%r": {"other"}, None: set()}
    want = {(q, i) for q, query in asked for i, text in rows if i is not None and text in holds[query]}
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    # What is found is dealt as blocks of ids and listed last, without a shuffle of the pairs.
    assert "Repartition " in found._jdf.queryExecution().optimizedPlan().toString()
    frame.unpersist()


def test_cells_are_assigned_in_bounded_steps(monkeypatch):
    """However many vectors a batch of rows brings, few meet all centres at once."""
    import numpy as np
    import pandas as pd

    from ordermill.operators import vectors

    rng = np.random.default_rng(3)
    rows, centres = rng.normal(size=(1300, 6)), vectors._units(pd.Series(list(rng.normal(size=(20, 6)))))
    seen, whole = [], vectors._distances
    monkeypatch.setattr(vectors, "_distances", lambda units, at: seen.append(len(units)) or whole(units, at))
    got = pd.concat(vectors._assigned(pd.DataFrame({"vec_id": range(1300), "vector": list(rows)}), centres))
    want = whole(vectors._units(pd.Series(list(rows))), centres)
    assert max(seen) <= vectors.ROWS_PER_STEP and got["vec_id"].tolist() == list(range(1300))
    assert got["cell"].tolist() == want.argmin(axis=1).tolist() and np.allclose(got["apart"], want.min(axis=1))
