"""The change stream and the alert that must hold, batch after batch."""

import datetime
import json

from pyspark.sql import functions as F

from ordermill.streaming import alerts, cdc_stream


def message(key, op, position, **row):
    after = json.dumps(row) if row else None
    return (key, json.dumps({"op": op, "after": row or None, "source": {"lsn": position}}), "dbserver1.public.products", after)


def test_changes_in_any_order_leave_the_same_table(spark, folder):
    log = [
        message("a", "r", 10, v=1), message("a", "u", 20, v=2), message("a", "u", 30, v=3),
        message("b", "r", 10, v=1), message("b", "d", 25), message("b", "u", 15, v=9),
        message("c", "c", 40, v=1), message("c", "d", 41), message("c", "c", 42, v=7),
    ]
    odd = [("a", None, "t", None), ("a", "no json", "t", None), ("a", '{"op":"u","after":{"v":99}}', "t", None), (None, log[2][1], "t", None), ("a", '{"op":"x","source":{"lsn":99}}', "t", None)]
    want = {("a", 30, '{"v":3}'), ("c", 42, '{"v":7}')}
    orders = [[log], [log[::-1], log], [log[6:], log[3:6] + odd, log[:3], log[::2]]]
    for n, batches in enumerate(orders):
        root = f"{folder}/{n}"
        for batch in batches:
            frame = spark.createDataFrame([m[:3] for m in batch], cdc_stream.MESSAGE)
            frame.coalesce(1).write.mode("append").parquet(f"{root}/messages")
        cdc_stream.run_available(spark, f"{root}/messages", root, max_files=1)
        got = {(r["key"], r["position"], r["after"]) for r in cdc_stream.current(spark, root).collect()}
        assert got == want, n
        # Nothing new: the next run changes nothing.
        cdc_stream.run_available(spark, f"{root}/messages", root)
        assert cdc_stream.current(spark, root).count() == 2
    assert [r["topic"] for r in cdc_stream.current(spark, root).select("topic").distinct().collect()] == ["cdc_product_changes"]


def test_alert_is_pending_then_fires_then_resolves(spark, folder):
    start = datetime.datetime(2026, 1, 1, 10, 0, 7)

    def samples(topic, *runs):
        at, out = start, []
        for steps, lag in runs:
            for _ in range(steps):
                if lag is not None:
                    out.append((at, topic, lag))
                at += datetime.timedelta(seconds=15)
        return out

    rows = samples("held", (3, 10), (21, 400), (2, 10), (19, 500))  # fires twice, resolved; then pending, one step short
    rows += samples("gap", (10, 400), (5, None), (10, 350), (60, None), (1, 400))  # fires over unseen steps, resolved by silence
    rows += [(at, "held", 1) for at, topic, lag in rows if topic == "held" and lag == 400]  # lower samples of a step do not count
    cut = start + datetime.timedelta(seconds=20 * 15)
    early, late = [r for r in rows if r[0] < cut], [r for r in rows if r[0] >= cut]
    beat = [(start + datetime.timedelta(hours=k), None, 0) for k in (1, 2)]
    for part in (early, late, beat[:1], beat[1:]):
        spark.createDataFrame(part, alerts.SAMPLE).coalesce(1).write.mode("append").parquet(f"{folder}/samples")
    alerts.run_available(spark, f"{folder}/samples", folder)
    got = spark.read.schema(alerts.ALERT).parquet(f"{folder}/alerts").withColumn("step", ((F.unix_timestamp("since") - int(start.replace(tzinfo=datetime.timezone.utc).timestamp()) + 7) / 15).cast("int"))
    seen = sorted((r["topic"], r["step"], r["state"], r["lag"]) for r in got.collect())
    held = [s for s in seen if s[0] == "held"]
    assert held == sorted([("held", 3, "pending", 400), ("held", 3, "firing", 400), ("held", 4, "firing", 400), ("held", 24, "resolved", 10), ("held", 26, "pending", 500)])
    gap = [s for s in seen if s[0] == "gap" and s[2] != "pending"]
    # Steps 0 to 24, of which 10 to 14 were not seen: windows need their first and last step.
    want = [("gap", k, "firing", 350) for k in range(6) if k + 19 >= 15 and not 10 <= k + 19 <= 14 and k + 19 <= 24]
    assert [s for s in gap if s[2] == "firing"] == want and [s for s in gap if s[2] == "resolved"] == [("gap", 24, "resolved", 350)]
