"""SQL twins of the registered queries, computed from the base tables alone.

They share no step with the Spark side: no events are built, no JSON is parsed.
"""

from __future__ import annotations

from ordermill.functions.fx import RATES

LINES_PER_EVENT = 64

HEADERS = """
headers AS (
  SELECT o_orderkey, o_orderdate + to_seconds(o_orderkey % 86400) AS ts,
         ['USD','EUR','CAD','JPY','GBP','TRY'][c_nationkey % 6 + 1] AS cur
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

LINES = """
lines AS (
  SELECT l_orderkey, l_partkey, l_linenumber AS line, l_suppkey AS supp,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS cents
  FROM lineitem
)"""

GOLD = (
    HEADERS
    + ","
    + LINES
    + """,
first_lines AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey
                                 ORDER BY line, supp, quantity, cents) AS rn
    FROM lines) t WHERE rn = 1
),
gold AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
         quantity, cur AS currency_code,
         CAST(cents / 100.0 AS DECIMAL(12,2)) AS unit_price,
         CAST(CAST(cents AS DECIMAL(18,0)) * quantity * 0.01 AS DECIMAL(12,2)) AS total_price,
         ts AS event_timestamp, CAST(ts AS DATE) AS event_date, 'SUCCEED' AS status,
         l_orderkey, l_partkey, cents
  FROM first_lines JOIN headers ON l_orderkey = o_orderkey
)"""
)

CARTS = """
cart_events AS (
  SELECT user_id, event_id, ts, event_type,
         json_extract_string(props, '$.k') AS product_id, event_id % 10 + 1 AS quantity
  FROM events WHERE event_type IN ('click', 'purchase')
),
carts AS (
  SELECT a.user_id, a.product_id, CAST(sum(a.quantity) AS BIGINT) AS quantity
  FROM cart_events a
  LEFT JOIN (SELECT user_id, max((ts, event_id)) AS last_empty FROM cart_events
             WHERE event_type = 'purchase' GROUP BY user_id) e USING (user_id)
  WHERE a.event_type = 'click'
    AND (e.last_empty IS NULL OR (a.ts, a.event_id) > e.last_empty)
  GROUP BY a.user_id, a.product_id
)"""

# An order's lines by event (all of them); every tenth order is seen twice.
EVENTS = (
    HEADERS
    + f""",
layout AS (
  SELECT l_orderkey, n, split, width, (line - 1) // width + 1 AS blocks FROM (
    SELECT *, greatest(1, {LINES_PER_EVENT} // split) AS width FROM (
      SELECT l_orderkey, count(*) AS n, max(l_linenumber) AS line, CAST(ceil(count(*) / {LINES_PER_EVENT}.0) AS BIGINT) AS split
      FROM lineitem GROUP BY l_orderkey) t) u),
placed AS (
  SELECT l.*, CASE WHEN n <= {LINES_PER_EVENT} THEN 0 ELSE
         ((row_number() OVER (PARTITION BY l_orderkey, l_partkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice) - 1)
          // {LINES_PER_EVENT} * blocks + (l_linenumber - 1) // width) * split + l_partkey % split END AS chunk
  FROM lineitem l JOIN layout USING (l_orderkey)),
published AS (
  SELECT o_orderkey, ts, coalesce(chunk, 0) AS chunk, CAST(count(l_orderkey) AS INTEGER) AS items,
         CAST(coalesce(sum(l_quantity), 0) AS BIGINT) AS units
  FROM headers LEFT JOIN placed ON l_orderkey = o_orderkey GROUP BY 1, 2, 3),
events_seen AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderkey, ts, chunk, copy, items, units
  FROM published, (VALUES (0), (1)) c(copy) WHERE copy = 0 OR o_orderkey % 10 = 0)"""
)

ROUTES = (
    EVENTS
    + """,
kinds AS (
  SELECT o_orderkey, o_orderkey % 97 AS kind, items FROM published),
errors AS (
  SELECT *, CASE
    WHEN kind = 1 THEN 'InvalidOrder: Missing order_id'
    WHEN items = 0 THEN 'InvalidOrder: Order ' || o_orderkey || ' has no items'
    WHEN kind = 2 THEN 'InvalidOrder: Order ' || o_orderkey || ' is missing timestamp'
    WHEN kind = 3 THEN 'InvalidOrder: Order ' || o_orderkey || ' has item with missing product_id'
    WHEN kind = 6 THEN 'Unexpected: timestamp is not ISO-8601'
    WHEN kind = 5 THEN 'NonRetryable DB: value too long'
    WHEN kind = 4 THEN 'NonRetryable DB: numeric field overflow'
    WHEN kind IN (7, 8) THEN 'Retryable DB: target not available' END AS error
  FROM kinds),
routes AS (
  SELECT o_orderkey, kind, items, error,
    CASE WHEN error IS NULL THEN 'ok' WHEN error LIKE 'Retryable%' AND kind = 7 THEN 'retry' ELSE 'dlq' END AS route,
    CASE WHEN error IS NULL THEN 'success' WHEN error LIKE 'Invalid%' THEN 'invalid'
         WHEN error LIKE 'Unexpected%' THEN 'unexpected' WHEN error LIKE 'NonRetryable%' THEN 'non_retryable'
         WHEN kind = 7 THEN 'retry' ELSE 'dlq' END AS status,
    CAST(CASE WHEN kind = 8 THEN 3
              WHEN kind = 7 THEN CASE WHEN error LIKE 'Retryable%' THEN 2 ELSE 1 END
              ELSE 0 END AS INTEGER) AS attempt
  FROM errors)"""
)

OUTCOMES = """
outcomes AS (
  SELECT ts, CASE WHEN event_id % 2 = 0 THEN 'orders' ELSE 'orders_retry' END AS topic,
         CASE event_type WHEN 'error' THEN 'dlq' WHEN 'signup' THEN 'retry' ELSE 'success' END AS status
  FROM events)"""

PRODUCTS = """
products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name,
         p_name || ' ' || p_type || ' ' || p_brand AS description,
         '/images/' || p_partkey || '.jpg' AS picture_url,
         CAST(round(p_retailprice * 100) AS BIGINT) // 100 AS price_units,
         CAST((CAST(round(p_retailprice * 100) AS BIGINT) % 100) * 10000000 AS INTEGER) AS price_nanos,
         'USD' AS currency_code,
         CASE WHEN p_type < p_brand THEN p_type || ',' || p_brand ELSE p_brand || ',' || p_type END AS categories,
         p_type, p_brand, p_size
  FROM part)"""

PRODUCT_LIST = "id, name, description, picture_url, price_units, price_nanos, currency_code"

RATE_MAP = "MAP {" + ", ".join(f"'{c}': CAST({r} AS DOUBLE)" for c, r in RATES.items()) + "}"


def fx(source: str, code: str, units: str, nanos: str, to: str, keep: str, from_code: str | None = None) -> str:
    """CTEs that convert an amount step by step; the last is ``converted``."""
    code = from_code or code
    return f"""
fx1 AS (
  SELECT {keep}, {code} AS f_, {to} AS t_, {units} AS u0, {nanos} AS n0,
         {RATE_MAP}[{code}] AS src, {RATE_MAP}[{to}] AS dst FROM {source}),
fx2 AS (
  SELECT *, floor(u0 / src) + floor((n0 / src + ((u0 / src) % 1.0::DOUBLE) * 1e9) / 1e9) AS u1,
         (n0 / src + ((u0 / src) % 1.0::DOUBLE) * 1e9) % 1e9 AS n1 FROM fx1),
fx3 AS (SELECT * EXCLUDE (u1, n1), u1 * dst AS u2, floor(n1 + 0.5::DOUBLE) * dst AS n2 FROM fx2),
fx4 AS (
  SELECT *, floor(u2) + floor((n2 + (u2 % 1.0::DOUBLE) * 1e9) / 1e9) AS u3,
         (n2 + (u2 % 1.0::DOUBLE) * 1e9) % 1e9 AS n3 FROM fx3),
converted AS (
  SELECT *, CASE WHEN f_ = t_ THEN u0 ELSE CAST(floor(u3) AS BIGINT) END AS units,
         CASE WHEN f_ = t_ THEN n0 ELSE CAST(floor(n3) AS BIGINT) END AS nanos FROM fx4)"""


ADS = """
ad_list AS (
  SELECT p_brand AS category, unnest([
    ('/product/' || lo, p_brand || ' from our outlet'), ('/product/' || hi, p_brand || ' for connoisseurs')]) AS ad
  FROM (SELECT p_brand, min((p_retailprice, p_partkey))[2] AS lo, max((p_retailprice, p_partkey))[2] AS hi
        FROM part GROUP BY 1) b),
ads AS (SELECT category, ad[1] AS redirect_url, ad[2] AS text FROM ad_list),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY substr(md5(category || '|' || redirect_url || '|' || text), 1, 2),
                                        category, redirect_url, text) - 1 AS number FROM ads),
requests AS (
  SELECT event_id AS request_id, p_brand FROM events
  LEFT JOIN part ON event_type = 'view' AND p_partkey = CAST(json_extract_string(props, '$.k') AS BIGINT)),
served AS (
  SELECT request_id, 1 AS key_pos, redirect_url, text, false AS fallback
  FROM requests JOIN ads ON category = p_brand
  UNION ALL
  SELECT request_id, CAST(i AS INTEGER), redirect_url, text, true
  FROM (SELECT request_id, i, CAST('0x' || substr(md5(request_id || '|' || i || '|7'), 1, 12) AS BIGINT)
               % (SELECT count(*) FROM ads) AS number
        FROM requests, range(2) r(i) WHERE p_brand IS NULL) d
  JOIN numbered USING (number))"""


def _turn(place: str) -> str:
    """A place of the grid a x b after four keyed rounds."""
    left, right = f"({place} // b)", f"({place} % b)"
    mixed = lambda value, key: f"((({value} + k{key}) % 2147483647) * (({value} + k{key}) % 2147483647) % 2147483647)"
    for key in (0, 2):
        left = f"(({left} + {mixed(right, key)}) % a)"
        right = f"(({right} + {mixed(left, key + 1)}) % b)"
    return f"CAST({left} * b + {right} AS BIGINT)"


def queries() -> dict[str, str]:
    q: dict[str, str] = {}

    q["silver_order_items"] = f"""
WITH {GOLD}
SELECT order_id, product_id, quantity, currency_code,
       CAST(CAST(cents AS DECIMAL(18,0)) * 0.01 AS DECIMAL(28,9)) AS unit_price,
       event_timestamp, event_date, status FROM gold"""

    q["gold_fact_order_items"] = f"""
WITH {GOLD}
SELECT order_id, product_id, quantity, currency_code, unit_price, total_price,
       event_timestamp, event_date, status FROM gold"""

    sales = f"""
{HEADERS}, {LINES},
kept AS (
  SELECT l_orderkey, l_partkey, min({{'line': line, 'supp': supp, 'quantity': quantity, 'cents': cents}}) AS l
  FROM lines GROUP BY ALL),
sold AS (
  SELECT o_orderkey AS o, CAST(l_partkey AS VARCHAR) AS p, date_trunc('hour', ts) AS h, l.quantity AS q, l.quantity * l.cents AS c
  FROM headers, kept WHERE o_orderkey = l_orderkey)"""
    money = lambda cents: f"CAST(({cents}) / CAST(100 AS DECIMAL(18,2)) AS DECIMAL(18,2))"

    q["bi_revenue_by_hour"] = f"""
WITH {sales}
SELECT DISTINCT h AS event_hour, {money("sum(c) OVER w")} AS revenue, CAST(sum(q) OVER w AS BIGINT) AS units,
       max(nth) OVER w AS orders
FROM (SELECT *, dense_rank() OVER (PARTITION BY h ORDER BY o) AS nth FROM sold) s WINDOW w AS (PARTITION BY h)"""

    q["bi_newest_hours"] = q["bi_revenue_by_hour"] + " ORDER BY event_hour DESC LIMIT 168"

    q["bi_product_sales"] = f"""
WITH {sales}, per_order AS (SELECT p, o, sum(q) AS q, sum(c) AS c FROM sold GROUP BY ALL)
SELECT p AS product_id, CAST(sum(q) AS BIGINT) AS units_sold, {money("sum(c)")} AS revenue, count(*) AS orders
FROM per_order GROUP BY p"""

    q["bi_top_products"] = f"""
SELECT * FROM ({q["bi_product_sales"]}) s
QUALIFY row_number() OVER (ORDER BY units_sold DESC, product_id) <= 20"""

    q["bi_product_sales_with_copies"] = f"""
WITH {sales}, per_order AS (
  SELECT p, o, sum(q) * CASE o % 10 WHEN 0 THEN 2 ELSE 1 END AS q, sum(c) * CASE o % 10 WHEN 0 THEN 2 ELSE 1 END AS c
  FROM sold GROUP BY p, o)
SELECT p AS product_id, CAST(sum(q) AS BIGINT) AS units_sold, {money("sum(c)")} AS revenue, count(*) AS orders
FROM per_order GROUP BY p"""

    q["bi_cart_not_paid"] = f"""
WITH {sales}, {CARTS},
sides AS (
  SELECT product_id AS p, quantity AS waiting, 1 AS line, 0 AS bought FROM carts
  UNION ALL SELECT p, 0, 0, q FROM sold),
sums AS (
  SELECT p, CAST(sum(waiting) AS BIGINT) AS waiting, CAST(sum(line) AS BIGINT) AS lines, CAST(sum(bought) AS BIGINT) AS bought
  FROM sides GROUP BY p)
SELECT p AS product_id, waiting AS cart_units, lines AS carts, bought AS paid_units,
       CASE WHEN waiting + bought <> 0 THEN CAST(waiting AS DOUBLE) / (waiting + bought) END AS cart_not_paid_rate
FROM sums"""

    q["bi_cart_not_paid_top"] = f"""
SELECT * FROM ({q["bi_cart_not_paid"]}) s
QUALIFY row_number() OVER (ORDER BY cart_not_paid_rate DESC NULLS LAST, product_id) <= 20"""

    q["bi_revenue_usd_by_hour"] = f"""
WITH {GOLD}, {fx("gold", "currency_code", "CAST(trunc(total_price) AS BIGINT)",
                "CAST((total_price - trunc(total_price)) * 1000000000 AS BIGINT)", "'USD'",
                "event_timestamp")}
SELECT date_trunc('hour', event_timestamp) AS event_hour,
       CAST(sum(CAST(units AS DECIMAL(28,9)) + CAST(nanos AS DECIMAL(28,9)) * 0.000000001)
            AS DECIMAL(18,2)) AS revenue
FROM converted GROUP BY 1"""

    q["bi_metrics"] = f"""
WITH {GOLD}
SELECT CAST(sum(total_price) AS DECIMAL(18,2)) AS revenue, CAST(sum(quantity) AS BIGINT) AS units
FROM gold"""

    q["reconcile_totals"] = f"""
WITH {GOLD},
t AS (
  SELECT count(*) AS items, CAST(coalesce(sum(quantity), 0) AS BIGINT) AS units,
         CAST(coalesce(sum(total_price * 100), 0) AS BIGINT) AS cents
  FROM gold WHERE event_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31')
SELECT items AS fact_items, units AS fact_units, cents AS fact_revenue_cents,
       items AS reference_items, units AS reference_units, cents AS reference_revenue_cents,
       CAST(0 AS BIGINT) AS items_delta, CAST(0 AS BIGINT) AS units_delta,
       CAST(0 AS BIGINT) AS revenue_cents_delta, CAST(0 AS BIGINT) AS fact_price_mismatch_rows
FROM t"""

    q["items_per_day"] = f"""
WITH {GOLD} SELECT event_date, count(*) AS items FROM gold GROUP BY 1"""

    q["duplicate_grain"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
       count(*) AS row_count
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
GROUP BY 1, 2 HAVING count(*) > 1"""

    q["quality_report"] = f"""
WITH {GOLD},
rules(suite, expectation) AS (VALUES
  {", ".join(f"('bronze', 'not_null:{c}')" for c in ("order_id", "raw", "_event_date", "_ingested_at"))},
  {", ".join(f"('silver', 'not_null:{c}')" for c in ("order_id", "product_id", "quantity", "currency_code", "unit_price", "event_timestamp", "event_date", "status"))},
  ('silver', 'accepted:status'),
  {", ".join(f"('gold', 'not_null:{c}')" for c in ("order_id", "product_id", "quantity", "currency_code", "unit_price", "total_price", "event_timestamp", "event_date", "status"))},
  ('gold', 'accepted:status'), ('gold', 'only_succeed:status'),
  ('gold', 'at_least_1:quantity'), ('gold', 'at_least_0:unit_price'), ('gold', 'at_least_0:total_price'),
  ('gold', 'unique:order_id,product_id')),
broken AS (
  SELECT count(*) FILTER (WHERE quantity < 1) AS quantity,
         count(*) FILTER (WHERE unit_price < 0) AS unit_price,
         count(*) FILTER (WHERE total_price < 0) AS total_price FROM gold)
SELECT suite, expectation, failed_rows, failed_rows = 0 AS success FROM (
  SELECT suite, expectation,
         CASE expectation WHEN 'at_least_1:quantity' THEN quantity
                          WHEN 'at_least_0:unit_price' THEN unit_price
                          WHEN 'at_least_0:total_price' THEN total_price
                          ELSE 0 END AS failed_rows
  FROM rules, broken) r"""

    faulty = f"""
{GOLD},
kinds AS (SELECT *, l_orderkey % 97 AS kind FROM gold WHERE l_orderkey % 97 <> 18),
once AS (
  SELECT order_id, event_date, CASE WHEN kind <> 12 THEN product_id END AS product_id, CASE WHEN kind = 11 THEN 0 ELSE quantity END AS quantity,
         CASE kind WHEN 13 THEN 'LOST' WHEN 14 THEN 'CANCELLED' ELSE status END AS status,
         CASE WHEN kind = 15 THEN -unit_price ELSE unit_price END AS unit_price,
         CASE WHEN kind = 16 THEN total_price + 1 ELSE total_price END AS total_price, kind FROM kinds),
broken AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE kind = 17)"""
    off = "abs(total_price - quantity * unit_price) > quantity * 0.005 + 0.01"
    gold_rules = {
        **{f"not_null:{c}": "false" for c in ("order_id", "quantity", "currency_code", "unit_price", "total_price", "event_timestamp", "event_date", "status")},
        "not_null:product_id": "product_id IS NULL",
        "accepted:status": "status NOT IN ('SUCCEED', 'CANCELLED')",
        "only_succeed:status": "status <> 'SUCCEED'",
        "at_least_1:quantity": "quantity < 1",
        "at_least_0:unit_price": "unit_price < 0",
        "at_least_0:total_price": "total_price < 0",
    }

    q["quality_report_faulty"] = (
        f"WITH {faulty}, r AS ("
        + " UNION ALL ".join(f"SELECT 'gold' AS suite, '{n}' AS expectation, count(*) FILTER (WHERE {c}) AS failed_rows FROM broken" for n, c in gold_rules.items())
        + f"""
  UNION ALL SELECT 'gold', 'unique:order_id,product_id', CAST(coalesce(sum(n), 0) AS BIGINT) FROM (
    SELECT count(*) AS n FROM broken GROUP BY order_id, product_id HAVING count(*) > 1) d
  UNION ALL SELECT 'totals', 'equals_0:fact_price_mismatch_rows', CAST(count(*) > 0 AS BIGINT) FROM broken WHERE {off}
  UNION ALL SELECT 'totals', 'equals_-1:fact_items', CAST(1 AS BIGINT))
SELECT suite, expectation, failed_rows, failed_rows = 0 AS success FROM r"""
    )

    q["reconcile_differences"] = f"""
WITH {faulty},
ours AS (
  SELECT year(event_date) AS y, count(*) AS items, CAST(sum(quantity) AS BIGINT) AS units,
         CAST(sum(total_price * 100) AS BIGINT) AS cents, count(*) FILTER (WHERE {off}) AS mismatch FROM broken GROUP BY 1),
theirs AS (
  SELECT year(ts) AS y, count(*) AS items, CAST(sum(f.quantity) AS BIGINT) AS units, CAST(sum(f.quantity * f.cents) AS BIGINT) AS cents
  FROM first_lines f JOIN headers ON l_orderkey = o_orderkey GROUP BY 1),
r AS (
  SELECT CAST(y AS INTEGER) AS year, coalesce(o.items, 0) AS fact_items, coalesce(o.units, 0) AS fact_units, coalesce(o.cents, 0) AS fact_revenue_cents,
         coalesce(t.items, 0) AS reference_items, coalesce(t.units, 0) AS reference_units, coalesce(t.cents, 0) AS reference_revenue_cents,
         coalesce(mismatch, 0) AS fact_price_mismatch_rows
  FROM (SELECT y FROM ours UNION SELECT y FROM theirs) s LEFT JOIN ours o USING (y) LEFT JOIN theirs t USING (y))
SELECT *, fact_items - reference_items AS items_delta, fact_units - reference_units AS units_delta,
       fact_revenue_cents - reference_revenue_cents AS revenue_cents_delta
FROM r WHERE fact_items <> reference_items OR fact_units <> reference_units OR fact_revenue_cents <> reference_revenue_cents"""

    q["ingest_routes"] = f"""
WITH {ROUTES}
SELECT o_orderkey, route, status, error, attempt FROM routes"""

    q["ingest_outcomes"] = f"""
WITH {ROUTES}
SELECT status, count(*) AS n FROM routes GROUP BY 1"""

    q["ingest_letters"] = f"""
WITH {ROUTES}
SELECT CASE route WHEN 'dlq' THEN 'orders_dlq' ELSE 'orders_retry' END AS topic,
       CASE WHEN kind = 1 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS key,
       attempt, error, items
FROM routes WHERE route <> 'ok'"""

    q["landing_manifest"] = f"""
WITH {EVENTS}
SELECT strftime(ts, '%Y-%m-%d') AS event_date, CAST(count(*) AS BIGINT) AS rows,
       strftime(ts, '%Y-%m-%d') AS min_event_date, strftime(ts, '%Y-%m-%d') AS max_event_date
FROM events_seen GROUP BY 1"""

    q["bronze_sync"] = f"""
WITH {EVENTS}
SELECT order_id, CAST(ts AS DATE) AS _event_date, CAST(o_orderkey % 4 AS INTEGER) AS _kafka_partition,
       o_orderkey + chunk * 1000000000000 AS _kafka_offset
FROM events_seen WHERE copy = 0"""

    q["bronze_undated"] = f"""
WITH {EVENTS}
SELECT CASE WHEN o_orderkey % 3 = 0 THEN DATE '2026-01-31' ELSE CAST(ts AS DATE) END AS _event_date, count(*) AS rows,
       count(DISTINCT order_id) AS orders FROM events_seen WHERE copy = 0 GROUP BY 1"""

    q["bronze_rows"] = f"""
WITH {EVENTS}
SELECT order_id, CAST(ts AS DATE) AS _event_date, CAST(o_orderkey % 4 AS INTEGER) AS _kafka_partition,
       o_orderkey + chunk * 1000000000000 AS _kafka_offset, ts + INTERVAL 1 MINUTE AS _ingested_at
FROM events_seen WHERE copy = 0"""

    q["bronze_health"] = f"""
WITH {EVENTS}
SELECT count(*) AS rows, count(*) FILTER (WHERE copy = 0) AS distinct_row_ids,
       CAST(0 AS BIGINT) AS null_row_ids, count(*) FILTER (WHERE copy = 1) AS duplicate_keys
FROM events_seen"""

    q["pending_files"] = f"""
WITH {EVENTS}
SELECT strftime(ts, '%Y-%m-%d') AS event_date, CAST(count(*) AS BIGINT) AS rows
FROM events_seen WHERE ts >= TIMESTAMP '1999-01-01' GROUP BY 1"""

    q["pending_files_per_run"] = f"""
WITH {EVENTS}
SELECT strftime(ts, '%Y-%m-%d') AS event_date, CAST(count(*) AS BIGINT) AS rows FROM events_seen GROUP BY 1"""

    q["bronze_without_tests"] = f"""
WITH {EVENTS}
SELECT CAST(ts AS DATE) AS _event_date, count(*) AS rows FROM events_seen WHERE order_id NOT LIKE '7%' GROUP BY 1"""

    q["order_event_items"] = f"""
WITH {EVENTS}
SELECT order_id, o_orderkey + chunk * 1000000000000 + copy * 1000000000 AS _kafka_offset, items, units FROM events_seen"""

    q["quarantine"] = f"""
WITH {EVENTS}
SELECT order_id, o_orderkey + chunk * 1000000000000 + copy * 1000000000 AS _kafka_offset,
       'InvalidOrder: Order ' || order_id || ' has no items' AS error FROM events_seen WHERE items = 0"""

    q["outcome_counts"] = f"""
WITH {OUTCOMES} SELECT topic, status, count(*) AS n FROM outcomes GROUP BY 1, 2"""

    windows = """
windows AS (
  SELECT o.*, time_bucket(INTERVAL 15 SECOND, ts, TIMESTAMP '2000-01-01') - to_seconds(15 * i) AS window_start
  FROM outcomes o, range(20) r(i))"""

    q["dlq_5min"] = f"""
WITH {OUTCOMES}, {windows}
SELECT window_start, count(*) AS n FROM windows WHERE status = 'dlq' GROUP BY 1"""

    q["rate_by_status"] = f"""
WITH {OUTCOMES}, {windows}
SELECT window_start, status, count(*) / CAST(300 AS DOUBLE) AS per_second
FROM windows GROUP BY 1, 2"""

    q["topic_freshness"] = f"""
WITH {OUTCOMES}
SELECT topic, max(ts) AS last_ts,
       (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / CAST(1000000 AS DOUBLE) AS age_seconds,
       (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) < 3600000000 AS in_sla
FROM outcomes WHERE status = 'success' GROUP BY 1"""

    q["topic_lag"] = """
WITH m AS (
  SELECT CASE WHEN event_id % 2 = 0 THEN 'orders' ELSE 'orders_retry' END AS topic,
         user_id % 4 AS part, event_id, ts FROM events),
p AS (
  SELECT topic, part, max(event_id) + 1 AS done,
         max(event_id) FILTER (WHERE ts < TIMESTAMP '2024-01-20' AND part <> 3) + 1 AS read
  FROM m GROUP BY 1, 2)
SELECT topic, CAST(sum(greatest(0, done - coalesce(read, 0))) AS BIGINT) AS lag FROM p GROUP BY 1
UNION ALL SELECT 'orders_dlq', CAST(0 AS BIGINT)"""

    q["lag_alert"] = """
WITH s AS (
  SELECT time_bucket(INTERVAL 15 SECOND, ts, TIMESTAMP '2000-01-01') AS tick,
         CASE WHEN event_id % 2 = 0 THEN 'orders' ELSE 'orders_retry' END AS topic,
         max(CAST(floor(value * 10) AS BIGINT)) AS lag
  FROM events GROUP BY 1, 2)
SELECT tick - to_seconds(15 * i) AS window_start, topic, min(lag) AS min_lag
FROM s, range(20) r(i) GROUP BY 1, 2 HAVING min(lag) > 300 AND count(*) FILTER (WHERE i IN (0, 19)) = 2"""

    q["cart_fold"] = f"""
WITH {CARTS} SELECT CAST(user_id AS VARCHAR) AS user_id, product_id, quantity FROM carts"""

    snapshot = """
SELECT TIMESTAMP '2024-01-31' AS snapshot_ts, product_id,
       CAST(sum(quantity) AS BIGINT) AS units_in_cart, count(*) AS carts_with_product FROM carts"""

    q["cart_snapshot"] = f"WITH {CARTS} {snapshot} GROUP BY product_id"
    q["cart_blob_snapshot"] = f"WITH {CARTS} {snapshot} WHERE user_id % 7 <> 0 GROUP BY product_id"

    q["snapshot_upsert"] = f"""
WITH {CARTS},
s AS (SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units, count(*) AS n FROM carts GROUP BY 1)
SELECT TIMESTAMP '2024-01-31' - to_days(CAST(i AS INTEGER)) AS snapshot_ts, product_id,
       units + (i = 0)::INTEGER AS units_in_cart, n AS carts_with_product
FROM s, range(8) r(i)"""

    q["catalog_page"] = f"""
WITH {PRODUCTS} SELECT {PRODUCT_LIST}, categories FROM products ORDER BY id LIMIT 21 OFFSET 20"""

    q["catalog_search_many"] = f"""
WITH {PRODUCTS},
asked AS (
  SELECT id || '-' || kind AS query_id, lower(query) AS query FROM (
    SELECT id, unnest([0, 1, 2, 3]) AS kind,
           unnest([substr(name, 2, 5), substr(name, 1, 3) || '_' || substr(name, 5, 2), substr(name, 2, 2) || '%' || substr(name, 6, 3),
                   substr(name, 3, 1) || '_' || substr(name, 5, 1)]) AS query
    FROM products WHERE CAST(id AS BIGINT) % 100 = 0) a)
SELECT query_id, id FROM asked, products WHERE lower(name) LIKE '%' || query || '%'"""

    q["catalog_search"] = f"""
WITH {PRODUCTS} SELECT {PRODUCT_LIST}, categories FROM products
WHERE lower(name) LIKE '%red g_z%' OR lower(description) LIKE '%red g_z%'"""

    q["catalog_products"] = f"WITH {PRODUCTS} SELECT {PRODUCT_LIST}, categories FROM products"

    q["product_lookup"] = f"""
WITH {PRODUCTS},
asked AS (SELECT json_extract_string(props, '$.k') AS product_id, count(*) AS requests
          FROM events WHERE event_type = 'view' GROUP BY 1)
SELECT product_id, requests, id IS NOT NULL AS found, name, price_units, price_nanos
FROM asked LEFT JOIN products ON product_id = id"""

    q["vector_export"] = f"""
WITH {PRODUCTS}
SELECT id, name || 's best' AS name, p_type AS description,
       '/static/img/' || id || '.jpg' AS picture, 'EUR' AS price_usd_currency_code,
       price_units AS price_usd_units, CAST(price_nanos AS BIGINT) AS price_usd_nanos,
       p_type || ',' || p_brand AS categories
FROM products"""

    q["catalog_upsert"] = f"""
WITH {PRODUCTS},
feed AS (
  SELECT CASE WHEN p_size > 40 THEN 'N' || id ELSE id END AS id, 'new ' || name AS name,
         p_type AS description,
         CASE WHEN p_size = 3 THEN '' ELSE '/images/' || id || '.png' END AS picture_url,
         CASE WHEN p_size IN (1, 4, 5, 6) THEN CAST(0 AS BIGINT) ELSE price_units END AS price_units,
         CASE WHEN p_size IN (1, 4, 5, 6) THEN CAST(0 AS INTEGER) ELSE price_nanos END AS price_nanos
  FROM products)
SELECT id, name, description, picture_url, price_units, price_nanos,
       CASE WHEN starts_with(id, 'N') THEN 'USD' ELSE 'GBP' END AS currency_code FROM feed
UNION ALL
SELECT id, name, description, picture_url, price_units, price_nanos, 'GBP' FROM products WHERE p_size > 40"""

    q["catalog_upsert_json"] = f"""
WITH {PRODUCTS}
SELECT id, name || '''s best' AS name, p_type AS description, '/images/' || id || '.jpg' AS picture_url,
       price_units, price_nanos, 'EUR' AS currency_code FROM products"""

    q["catalog_bridge"] = """
SELECT CASE WHEN p_size > 40 THEN 'N' ELSE '' END || p_partkey AS product_id, category
FROM part, (VALUES (0), (1)) s(i), LATERAL (SELECT CASE i WHEN 0 THEN p_type ELSE p_brand END AS category) c
WHERE p_size <> 2"""

    q["fx_convert"] = f"""
WITH {HEADERS}, {LINES},
priced AS (SELECT * FROM lines JOIN headers ON l_orderkey = o_orderkey),
{fx("priced", "cur", "cents // 100", "(cents % 100) * 10000000", "'JPY'",
    "l_orderkey, l_partkey, line, supp, cur")}
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
       line, supp, cur AS currency_code, units, nanos,
       '¥' || units || '.' || lpad(CAST(nanos // 10000000 AS VARCHAR), 2, '0') AS shown
FROM converted"""

    q["supported_currencies"] = f"""
WITH {HEADERS}
SELECT c AS currency_code, count(cur) AS orders,
       c IN ('USD','EUR','CAD','JPY','GBP','TRY') AS offered
FROM (SELECT unnest(map_keys({RATE_MAP})) AS c) k LEFT JOIN headers ON cur = c GROUP BY 1"""

    q["money_sum"] = """
WITH m AS (
  SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
         CAST(round(l_extendedprice * l_discount * 100) AS BIGINT) AS off FROM lineitem),
p AS (
  SELECT *, cents // 100 AS u, (cents % 100) * 10000000 AS n, -(off // 100) AS ou,
         CASE WHEN l_linenumber = 7 THEN (off % 100) * 10000000 + 1 ELSE -(off % 100) * 10000000 END AS on_
  FROM m),
e AS (
  SELECT *, CASE
      WHEN ou <> 0 AND on_ <> 0 AND (ou < 0) <> (on_ < 0) THEN 'one of the specified money values is invalid'
      WHEN l_returnflag = 'R' THEN 'mismatching currency codes' END AS error,
    CAST(u + ou AS HUGEINT) * 1000000000 + n + on_ AS total
  FROM p)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, error,
       CASE WHEN error IS NULL THEN CAST(sign(total) * (abs(total) // 1000000000) AS BIGINT) END AS units,
       CASE WHEN error IS NULL THEN CAST(sign(total) * (abs(total) % 1000000000) AS BIGINT) END AS nanos
FROM e"""

    q["order_totals"] = f"""
WITH {HEADERS}, {LINES},
{fx("headers", "cur", "CAST(8 AS BIGINT)", "CAST(990000000 AS BIGINT)", "cur", "o_orderkey, cur", "'USD'")},
sums AS (SELECT l_orderkey, sum(CAST(cents * quantity AS HUGEINT)) AS cents FROM lines GROUP BY 1),
t AS (
  SELECT o_orderkey, cur, CAST(units AS HUGEINT) * 1000000000 + nanos + coalesce(cents, 0) * 10000000 AS total
  FROM converted LEFT JOIN sums ON l_orderkey = o_orderkey)
SELECT o_orderkey AS order_id, cur AS currency_code, CAST(total // 1000000000 AS BIGINT) AS units,
       CAST(total % 1000000000 AS BIGINT) AS nanos, CAST(NULL AS VARCHAR) AS error,
       CASE cur WHEN 'JPY' THEN '¥' WHEN 'EUR' THEN '€' WHEN 'TRY' THEN '₺' WHEN 'GBP' THEN '£' ELSE '$' END
         || CAST(total // 1000000000 AS BIGINT) || '.'
         || lpad(CAST(CAST(total % 1000000000 AS BIGINT) // 10000000 AS VARCHAR), 2, '0') AS shown
FROM t"""

    q["shipping_quote"] = """
SELECT o_orderkey AS order_id, CAST(coalesce(sum(l_quantity), 0) AS BIGINT) AS quantity,
       'USD' AS currency_code,
       CAST(CASE WHEN coalesce(sum(l_quantity), 0) = 0 THEN 0 ELSE 8 END AS BIGINT) AS units,
       CAST(CASE WHEN coalesce(sum(l_quantity), 0) = 0 THEN 0 ELSE 990000000 END AS INTEGER) AS nanos
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1"""

    cart_prices = f"""{PRODUCTS}, {CARTS},
lines AS (SELECT user_id, product_id, quantity, price_units, price_nanos, id,
                 ['USD','EUR','CAD','JPY','GBP','TRY'][user_id % 6 + 1] AS cur
          FROM carts LEFT JOIN products ON product_id = id),
{fx("lines", "'USD'", "price_units", "CAST(price_nanos AS BIGINT)", "cur", "user_id, product_id, quantity, cur, id")}"""

    q["cart_lines_priced"] = f"""
WITH {cart_prices}
SELECT CAST(user_id AS VARCHAR) AS user_id, product_id, quantity,
       CASE WHEN id IS NOT NULL THEN cur END AS currency_code, units, nanos,
       CASE WHEN id IS NULL THEN 'failed to get product #"' || product_id || '"' END AS error
FROM converted"""

    q["cart_totals"] = f"""
WITH {cart_prices},
t AS (
  SELECT user_id, CAST(sum(quantity) AS BIGINT) AS cart_size, count(*) AS lines,
         max(CASE WHEN id IS NOT NULL THEN cur END) AS currency_code,
         sum((CAST(units AS HUGEINT) * 1000000000 + nanos) * quantity) AS total,
         min(CASE WHEN id IS NULL THEN 'failed to get product #"' || product_id || '"' END) AS error
  FROM converted GROUP BY 1)
SELECT CAST(user_id AS VARCHAR) AS user_id, cart_size, lines, currency_code,
       CASE WHEN error IS NULL THEN CAST(total // 1000000000 AS BIGINT) END AS units,
       CASE WHEN error IS NULL THEN CAST(total % 1000000000 AS BIGINT) END AS nanos, error
FROM t"""

    q["recommendations"] = f"""
WITH RECURSIVE {CARTS},
numbered AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id,
         row_number() OVER (ORDER BY substr(md5(CAST(p_partkey AS VARCHAR)), 1, 2), CAST(p_partkey AS VARCHAR)) - 1 AS number
  FROM part),
grid AS (
  SELECT n, a, CAST(ceil(n / a) AS BIGINT) AS b
  FROM (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS a FROM part)),
asked AS (
  SELECT user_id, (SELECT count(*) FROM carts c WHERE c.user_id = u.user_id) + 5 AS wanted,
         {", ".join(f"CAST('0x' || substr(md5(user_id || '|7'), {1 + 7 * i}, 7) AS BIGINT) AS k{i}" for i in range(4))}
  FROM (SELECT DISTINCT user_id FROM events) u),
walk AS (
  SELECT user_id, i AS step, k0, k1, k2, k3, n, a, b, {_turn("i")} AS number
  FROM asked, grid, range((SELECT max(wanted) FROM asked)) r(i)
  WHERE i < least(wanted, n)
  UNION ALL
  SELECT user_id, step, k0, k1, k2, k3, n, a, b, {_turn("number")} FROM walk WHERE number >= n),
read AS (
  SELECT w.user_id, w.step, p.product_id FROM walk w JOIN numbered p ON p.number = w.number),
ranked AS (
  SELECT user_id, product_id, row_number() OVER (PARTITION BY user_id ORDER BY step) AS rank
  FROM read r WHERE NOT EXISTS (SELECT 1 FROM carts c WHERE c.user_id = r.user_id AND c.product_id = r.product_id))
SELECT CAST(user_id AS VARCHAR) AS request_id, product_id, CAST(rank AS INTEGER) AS rank, rank <= 4 AS shown
FROM ranked WHERE rank <= 5"""

    q["ads_for_request"] = f"""
WITH {ADS} SELECT request_id, key_pos, redirect_url, text, fallback FROM served"""

    q["chosen_ads"] = f"""
WITH {ADS}
SELECT request_id, redirect_url FROM (
  SELECT *, row_number() OVER (PARTITION BY request_id
     ORDER BY md5(request_id || '|' || key_pos || '|' || redirect_url || '|7'), redirect_url) AS rn
  FROM served) t WHERE rn = 1"""

    q["vector_topk"] = """
WITH v AS (
  SELECT vec_id, label, CASE vec_id % 50 WHEN 7 THEN [CAST(0 AS FLOAT) FOR x IN embedding] WHEN 8 THEN NULL ELSE embedding END AS embedding
  FROM embeddings),
parts AS (
  SELECT label, i AS pos, avg(CAST(embedding[i] AS DOUBLE)) AS x
  FROM v, range(1, (SELECT max(len(embedding)) + 1 FROM v)) r(i)
  GROUP BY 1, 2),
q AS (SELECT CAST(label AS BIGINT) AS query_id, list(x ORDER BY pos) AS query FROM parts GROUP BY 1),
s AS (SELECT query_id, vec_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), query) AS score
      FROM v, q WHERE vec_id % 50 NOT IN (7, 8)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, vec_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10"""

    q["vector_topk_indexed"] = """
WITH s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_cosine_similarity(CAST(v.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) AS score
  FROM embeddings v, embeddings q WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s WHERE NOT isnan(score))
SELECT CAST(query_id AS BIGINT) AS query_id, CAST(vec_id AS BIGINT) AS vec_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10"""

    q["payload_screen"] = """
SELECT c_custkey AS checkout_id, CASE
  WHEN c_nationkey = 0 THEN 'email' WHEN c_nationkey = 1 THEN 'street_address'
  WHEN c_nationkey = 2 THEN 'zip_code' WHEN c_nationkey = 3 THEN 'city' WHEN c_nationkey = 4 THEN 'state'
  WHEN c_nationkey = 5 THEN 'country' WHEN c_nationkey = 6 OR c_custkey % 4 = 3 THEN 'cc_number'
  WHEN c_nationkey IN (7, 8) THEN 'cc_month' WHEN c_nationkey = 9 THEN 'cc_year'
  WHEN c_nationkey = 10 THEN 'cc_cvv' END AS first_error
FROM customer"""

    q["card_screen"] = """
WITH c AS (
  SELECT *, lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS d,
    CASE WHEN c_nationkey = 7 THEN 0 WHEN c_nationkey = 8 THEN 13 ELSE c_custkey % 12 + 1 END AS m,
    CASE WHEN c_nationkey = 9 THEN 0 ELSE c_custkey % 4 + 2023 END AS y
  FROM customer)
SELECT c_custkey AS checkout_id, CASE
    WHEN c_nationkey = 6 OR c_custkey % 4 = 3 THEN 'invalid'
    WHEN c_custkey % 4 = 2 THEN 'unaccepted'
    WHEN y * 12 + m < 2025 * 12 + 6 THEN 'expired' END AS first_error,
  CASE WHEN c_nationkey = 6 THEN '0000' ELSE
    substr(d, 6, 1) || translate(substr(d, 6, 1), '0123456789', '0864297531') ||
    CASE WHEN c_custkey % 4 = 3 THEN '01'
         ELSE substr(d, 7, 1) || translate(substr(d, 7, 1), '0123456789', '0864297531') END END AS last_four
FROM c"""

    q["cart_add_screen"] = """
SELECT event_id, CASE WHEN NOT (floor(value) BETWEEN 1 AND 10) THEN 'quantity'
                      WHEN event_type = 'error' THEN 'product_id' END AS first_error FROM events"""

    q["currency_screen"] = """
SELECT c_custkey,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN substr(n_name, 1, 3)
            ELSE ['USD','EUR','CAD','JPY','GBP','TRY'][c_nationkey % 6 + 1] END AS currency,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN 'currency' END AS first_error
FROM customer JOIN nation ON n_nationkey = c_nationkey"""

    q["cdc_inserts"] = f"""
WITH {PRODUCTS}
SELECT 'cdc_product_changes' AS topic, id AS key, id, name, CAST(price_units AS VARCHAR) AS price_units,
       CAST(price_nanos AS VARCHAR) AS price_nanos FROM products WHERE p_size <= 40"""

    q["cdc_captured"] = f"WITH {PRODUCTS} SELECT id, name FROM products WHERE p_size <= 40"

    q["retention_kept"] = """
SELECT CAST(o_orderdate AS DATE) AS _event_date, count(*) AS rows FROM orders
WHERE CAST(o_orderdate AS DATE) >= DATE '2001-08-01' - 90 GROUP BY 1"""

    q["retention_expired"] = """
SELECT CAST(o_orderdate AS DATE) AS _event_date, count(*) AS rows FROM orders
WHERE CAST(o_orderdate AS DATE) < DATE '2001-08-01' - 90 GROUP BY 1"""

    q["prune_candidates"] = f"""
WITH {EVENTS}
SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS event_date, CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) AS file_created_at
FROM events_seen WHERE ts < TIMESTAMP '1999-01-01' AND CAST(ts AS DATE) + 1 < TIMESTAMP '1998-12-31' - INTERVAL 30 DAY"""

    q["orphans"] = f"""
WITH {HEADERS} SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS event_date FROM headers WHERE o_orderkey % 5 = 0"""

    q["stream_order_items"] = f"""
WITH {GOLD},
fine AS (SELECT DISTINCT l_orderkey FROM lines WHERE l_orderkey % 97 NOT BETWEEN 1 AND 8)
SELECT order_id, product_id, quantity, currency_code, unit_price, total_price,
       event_timestamp, status, event_date FROM gold SEMI JOIN fine USING (l_orderkey)"""

    q["stream_outcomes"] = f"""
WITH {ROUTES},
copies AS (SELECT r.* FROM routes r, (VALUES (0), (1)) c(copy) WHERE copy = 0 OR o_orderkey % 10 = 0),
ended AS (
  -- An envelope of attempt 1 with items is sent twice more before it is given up.
  SELECT unnest(CASE WHEN status = 'retry' THEN ['retry', 'retry', 'dlq'] ELSE [status] END) AS status FROM copies)
SELECT status, count(*) AS n FROM ended GROUP BY 1"""

    q["bronze_first_load"] = f"""
WITH {EVENTS} SELECT CAST(ts AS DATE) AS _event_date, count(*) AS rows FROM events_seen WHERE copy = 0 GROUP BY 1"""

    q["bronze_backfill"] = f"""
WITH {EVENTS}
SELECT CAST(ts AS DATE) AS _event_date, count(*) FILTER (WHERE year(ts) < 1996) AS missing, CAST(0 AS BIGINT) AS left,
       count(*) FILTER (WHERE copy = 0) AS events FROM events_seen GROUP BY 1"""

    q["stream_cdc_table"] = f"""
WITH {PRODUCTS}
SELECT 'cdc_product_changes' AS topic, id AS key, id, CASE WHEN p_size % 14 = 0 THEN 'again ' || name ELSE name END AS name,
       CAST(CASE WHEN p_size % 14 = 0 THEN 5 WHEN p_size % 5 = 0 THEN price_units + 2
                 WHEN p_size % 3 = 0 THEN price_units + 1 ELSE price_units END AS VARCHAR) AS price_units,
       CAST(price_nanos AS VARCHAR) AS price_nanos FROM products WHERE p_size % 7 <> 0 OR p_size % 14 = 0"""

    q["stream_lag_alert"] = q["lag_alert"]
    q["stream_cart_fold"] = q["cart_fold"]
    q["gold_from_deltas"] = q["gold_fact_order_items"]
    return q
