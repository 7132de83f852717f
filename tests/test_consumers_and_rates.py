"""Consumer counters, trailing shares, several quantiles, stage times, rates on a grid, header texts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventide.operators import dlq, listeners, metrics, promql, saga

T0 = dt.datetime(2024, 1, 1)
MIN = dt.timedelta(minutes=1)


def test_consumer_counters(spark):
    rows = [
        ("a", "k1", 1, False), ("a", "k1", 2, False),  # processed, duplicate
        ("a", "k2", 3, True), ("a", "k2", 4, False),  # failed; its retry finds the key marked
        ("a", "old", 5, False),  # known to the store
        ("a", None, 6, False), ("a", None, 7, None),  # no key: each handled; a null flag is no failure
        ("b", "k1", 8, False), ("b", "old", 9, True), ("b", "tie", 10, True), ("b", "tie", 10, False),
    ]
    r = spark.createDataFrame(rows, "svc string, key string, seq long, bad boolean")
    seen = spark.createDataFrame([("a", "old"), ("a", "old"), ("c", "old")], "svc string, key string")
    got = {x.service: (x.received, x.processed, x.duplicate, x.failed)
           for x in metrics.consumer_counters(r, "svc", "key", ["seq"], F.col("bad"), seen).collect()}
    assert got == {"a": (7, 3, 3, 1), "b": (4, 2, 1, 1)}
    alone = {x.service: x.processed for x in metrics.consumer_counters(r, "svc", "key", ["seq"], F.col("bad")).collect()}
    assert alone == {"a": 4, "b": 2}
    assert metrics.consumer_counters(r.limit(0), "svc", "key", ["seq"], F.col("bad"), seen).count() == 0


def test_compensation_counters(spark):
    def env(oid):
        return f'{{"orderId":"{oid}","payload":{{"orderId":"{oid}"}}}}'

    msgs = spark.createDataFrame([("a", env("a"), 1), ("a", env("a"), 2), ("b", env("b"), 3), ("c", "{bad", 4), ("d", env("d"), 5)],
                                 "key string, value string, offset long")
    status = spark.createDataFrame([("a", "CHARGED"), ("b", "REFUNDED"), ("d", "CHARGED")], "order_id string, status string")
    seen = spark.createDataFrame([("payment.refund", "d"), ("inventory.release", "a")], "scope string, key string")
    done = listeners.applied_refunds(status, msgs, seen=seen)
    assert [r.order_id for r in done.collect()] == ["a"]
    got = listeners.compensation_counters(msgs, "pay", "payment.refund", done, seen).collect()
    assert [tuple(r) for r in got] == [("pay", 5, 2, 1)]
    none = listeners.compensation_counters(msgs.limit(0), "pay", "payment.refund", done.limit(0)).collect()
    assert [tuple(r) for r in none] == [("pay", 0, 0, 0)]


def test_trailing_share(spark):
    rows = [(T0, "main"), (T0 + 59 * dt.timedelta(seconds=1), "canary"), (T0 + 3 * MIN, "main"), (T0 + 20 * MIN, "canary")]
    df = spark.createDataFrame(rows, "ts timestamp, channel string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = {r.eval_time: (r.main, r.canary, r.canary_share_pct) for r in metrics.trailing_share(df, "channel", "ts").collect()}
    assert got[T0 + MIN] == (1, 1, 50.0)
    assert got[T0 + 5 * MIN] == (2, 1, pytest.approx(33.333333))
    assert got[T0 + 6 * MIN] == (1, 0, 0.0)  # the first minute has left the range
    assert got[T0 + 21 * MIN] == (0, 1, 100.0)
    assert T0 + 9 * MIN not in got and T0 not in got


def test_quantiles_in_one_pass(spark):
    df = spark.createDataFrame([("x", float(v)) for v in range(1, 101)] + [("y", None)], "g string, v double")
    h = metrics.latency_histogram(df, "v", ["g"], [10.0, 50.0, 100.0])
    got = metrics.histogram_quantiles(h, {"a": 0.05, "b": 0.5, "c": 0.95, "d": 1.0}, ["g"]).collect()
    assert [tuple(r) for r in got] == [("x", 5.0, 50.0, 95.0, 100.0)]  # an empty group has none
    for q in (0.05, 0.5, 0.95):
        assert metrics.histogram_quantile(h, q, ["g"]).collect()[0].quantile == pytest.approx(100 * q)


def _events(spark, rows):
    named = [(o, s, T0 + dt.timedelta(seconds=t), e, None, None, None) for o, s, t, e in rows]
    df = spark.createDataFrame(named, "order_id string, seq long, ts timestamp, event_type string, ref_id string, reason string, shipping_address string")
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_stage_and_recent_durations(spark):
    ev = _events(spark, [
        ("o", 1, 0, "OrderCreated"), ("o", 2, 4, "PaymentCompleted"), ("o", 3, 5, "InventoryRequested"), ("o", 4, 7, "InventoryReserved"),
        ("o", 5, 17, "ShippingCompleted"), ("p", 6, 20, "OrderCreated"), ("p", 7, 21, "InventoryFailed"), ("p", 8, 19, "PaymentFailed"),
        ("q", 9, 30, "ShippingCompleted"), ("q", 10, 31, "OrderCreated"),
    ])
    t = saga.saga_transitions(ev)
    got = sorted((r.order_id, r.service, r.duration_ms) for r in saga.stage_durations(t).collect())
    # p's inventory was never asked, and its payment answer is dated before the request
    assert got == [("o", "inventory-svc", 2000.0), ("o", "payment-svc", 4000.0), ("o", "shipping-svc", 10000.0)]
    since, until = T0, T0 + dt.timedelta(seconds=40)
    recent = saga.recent_durations(ev, since, until)
    assert [(r.order_id, r.duration_ms) for r in recent.collect()] == [("o", 17000.0)]  # q's completion precedes its start
    assert saga.recent_durations(ev, T0 + dt.timedelta(seconds=17), until).count() == 0
    every = saga.processing_durations(t)
    assert sorted(map(tuple, recent.collect())) == sorted(map(tuple, every.collect()))


def test_rates_on_a_grid(spark):
    def at(m):
        return T0 + m * MIN

    rows = [("ok", "a", at(1), 0.0), ("ok", "a", at(31), 6.0), ("ok", "a", at(60), 2.0),  # reset: 2 more
            ("bad", "a", at(10), 1.0), ("bad", "a", at(50), 5.0), ("ok", "b", at(5), 0.0), ("ok", "b", at(6), 10.0), ("ok", "a", at(300), 9.0)]
    df = spark.createDataFrame(rows, "metric string, app string, ts timestamp, value double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    rates = promql.counter_rate_grid(df, "1 hour", "1 hour", ["metric", "app"])
    got = {(r.metric, r.app, r.ts): r.rate for r in rates.collect()}
    assert got == {("ok", "a", at(60)): pytest.approx(8 / 3600), ("bad", "a", at(60)): pytest.approx(4 / 3600), ("ok", "b", at(60)): pytest.approx(10 / 3600)}
    # b has no failures series, so it is in the numerator only, as in PromQL
    rate = promql.success_rate_of_rates(rates, "ok", "bad", ["app"]).collect()
    assert [(r.ts, round(r.success_rate_pct, 6)) for r in rate] == [(at(60), 150.0)]
    idle = spark.createDataFrame([("ok", "a", T0, 0.0), ("bad", "a", T0, 0.0)], "metric string, app string, ts timestamp, rate double")
    assert promql.success_rate_of_rates(idle, "ok", "bad", ["app"]).collect()[0].success_rate_pct == 0.0


def test_header_text_of_records_without_it(spark):
    df = spark.sql("SELECT array(named_struct('key', 'h', 'value', CAST('x' AS BINARY))) AS headers UNION ALL SELECT array() UNION ALL SELECT NULL")
    assert sorted(str(r[0]) for r in df.select(dlq.header_text("headers", "h")).collect()) == ["None", "None", "x"]
