"""Dead letters, replay, metrics and listener effects (reference DLQ/replay/SLO/listener tests)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventide.operators import dlq, listeners, metrics, promql, slo

T0 = dt.datetime(2024, 1, 1)
REC = "key string, value string, topic string, partition int, offset long, timestamp timestamp"


def recs(spark, rows):
    return spark.createDataFrame([(k, v, t, p, o, T0 + dt.timedelta(seconds=o)) for k, v, t, p, o in rows], REC)


def test_dlt_listing_count_peek(spark):
    r = recs(spark, [("k", "v", "A", 0, 0), ("k", "v", "order.created.dlt", 0, 1),
                     ("k", "v", "payment.requested.dlt", 0, 2), ("k", "v", "x-DLT", 0, 3)])
    assert [x.topic for x in dlq.dlt_topics(r).collect()] == ["order.created.dlt", "payment.requested.dlt", "x-DLT"]
    asked = spark.createDataFrame([("order.created.dlt",), ("missing.dlt",), ("A",)], "topic string")
    assert {x.topic: x.cnt for x in dlq.dlt_count(r, asked).collect()} == {"order.created.dlt": 1, "missing.dlt": 0}
    assert dlq.dlt_peek(r, 10, "missing.dlt").count() == 0


def test_replay_and_range(spark):
    r = recs(spark, [("k1", "a", "orders.dlt", 0, 0), ("k2", "b", "orders.dlt", 0, 1),
                     ("k", "v", "events.dlt", 0, 5), ("k", "v", "events.dlt", 0, 6), ("k", "v", "events.dlt", 0, 11)])
    rep = dlq.dlt_replay(r.where("topic = 'orders.dlt'")).collect()
    assert sorted((x.topic, x.key, x.value) for x in rep) == [("orders", "k1", "a"), ("orders", "k2", "b")]
    assert dlq.dlt_replay_range(r, "events.dlt", 5, 10).count() == 2
    up = dlq.dlt_replay(r.where("topic = 'orders.dlt'"), transform=F.upper).collect()
    assert {x.value for x in up} == {"A", "B"}


def test_replay_from_time(spark):
    r = spark.createDataFrame(
        [("t", 0, o, T0 + dt.timedelta(minutes=o)) for o in range(0, 100)]
        + [("t", 1, o, T0 + dt.timedelta(minutes=o - 100)) for o in range(100, 200)],
        "topic string, partition int, offset long, timestamp timestamp")
    committed = spark.createDataFrame([("g", "t", 0, 100), ("g", "t", 1, 200)],
                                      "group_id string, topic string, partition int, committed long")
    as_of = T0 + dt.timedelta(minutes=99)
    got = {x.partition: x.new_offset for x in dlq.replay_from_time(r, committed, as_of, "49m").collect()}
    assert got == {0: 50, 1: 150}
    assert dlq.replay_from_time(r, committed.limit(0), as_of, "1h").count() == 0
    assert dlq.parse_duration("PTPT5M") == 300 and dlq.parse_duration("1h") == 3600
    with pytest.raises(ValueError):
        dlq.parse_duration("soon")


def test_histogram_quantile_matches_interpolation(spark):
    vals = list(range(1, 101))
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    h = metrics.latency_histogram(df, "v", None, [10.0, 50.0, 100.0])
    q = metrics.histogram_quantile(h, 0.95).collect()[0].quantile
    # rank 95 falls in (50, 100] holding 50 values: 50 + 50 * (95 - 50) / 50
    assert q == pytest.approx(95.0)
    empty = metrics.histogram_quantile(metrics.latency_histogram(df.limit(0), "v", None, [1.0]), 0.5)
    assert empty.collect()[0].quantile is None  # empty histogram -> NULL


def test_counter_increase_with_reset(spark):
    pts = [(0, 10.0), (60, 20.0), (120, 5.0), (180, 15.0)]
    df = spark.createDataFrame([(T0 + dt.timedelta(seconds=s), "m", v) for s, v in pts], "ts timestamp, metric string, value double")
    inc = {r.ts: r.increase for r in promql.counter_increase(df, "5 minutes", ["metric"]).collect()}
    assert inc[T0] is None
    assert inc[T0 + dt.timedelta(seconds=180)] == pytest.approx(10 + 5 + 10)
    rate = promql.counter_rate(df, "5 minutes", ["metric"]).collect()
    assert max(r.rate for r in rate if r.rate is not None) == pytest.approx(25 / 300, abs=1e-6)


def test_slo_summary_missing_parts(spark):
    p95 = spark.createDataFrame([(1234.5,)], "quantile double")
    r = slo.slo_summary(p95, None, None).collect()[0]
    assert (r.p95_latency_ms, r.dlt_count, r.slo_burn_rate_1h) == (1234.5, 0, 0)
    empty = spark.createDataFrame([], "dlt_total long")
    r = slo.slo_summary(None, empty, spark.createDataFrame([(7,)], "burn_rate long")).collect()[0]
    assert (r.p95_latency_ms, r.dlt_count, r.slo_burn_rate_1h) == (0.0, 0, 7)


def _cmd(spark, rows):
    return spark.createDataFrame(rows, "key string, value string, offset long")


def env(payload):
    import json
    return json.dumps({"orderId": "o", "eventId": "e", "type": "T", "payload": json.dumps(payload)})


def test_refund_matrix(spark):
    status = spark.createDataFrame([("a", "CHARGED"), ("b", "REFUNDED"), ("c", "PENDING")], "order_id string, status string")
    msgs = _cmd(spark, [("a", env({"orderId": "a"}), 1), ("a", env({"orderId": "a"}), 2),
                        ("b", env({"orderId": "b"}), 3), ("c", env({"orderId": "c"}), 4),
                        ("z", env({"orderId": "z"}), 5), ("q", "{bad", 6)])
    new, results = listeners.apply_refunds(status, msgs)
    assert {r.order_id: r.status for r in new.collect()} == {"a": "REFUNDED", "b": "REFUNDED", "c": "PENDING"}
    res = {r.order_id: r.value for r in results.collect()}
    assert len(res) == 5 and '"success":false' in res["q"] and '"success":true' in res["z"]


def test_cancel_and_status_updates(spark):
    u1, u2 = "e7a4f431-b2e3-4b43-8a24-8e2b1d3a0e46", "e7a4f431-b2e3-4b43-8a24-8e2b1d3a0e47"
    orders = spark.createDataFrame([(u1, "NEW", None), (u2, "COMPLETED", None)],
                                   "id string, status string, review_reason string")
    msgs = _cmd(spark, [(u1, env({"orderId": u1, "reason": "r1"}), 1), (u2, env({"orderId": u2}), 2),
                        ("bad", env({"orderId": "not-a-uuid"}), 3)])
    new, results = listeners.apply_cancellations(orders, msgs)
    got = {r.id: (r.status, r.review_reason) for r in new.collect()}
    assert got == {u1: ("CANCELLED", "Cancelled: r1"), u2: ("COMPLETED", None)}
    assert '"success":false' in {r.order_id: r.value for r in results.collect()}["not-a-uuid"]
    import json
    st = _cmd(spark, [(u1, json.dumps({"orderId": u1, "status": "WEIRD", "reason": ""}), 1),
                      (u2, json.dumps({"orderId": u2, "status": "PAYMENT_FAILED", "reason": "x"}), 2)])
    got = {r.id: (r.status, r.review_reason) for r in listeners.apply_status_updates(orders, st).collect()}
    assert got == {u1: ("FAILED", None), u2: ("PAYMENT_FAILED", "x")}


def test_quantile_in_inf_bucket_and_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 500.0), ("a", 900.0), ("b", 3.0)], "g string, v double")
    h = metrics.latency_histogram(df, "v", ["g"], [2.0, 10.0])
    got = {r.g: r.quantile for r in metrics.histogram_quantile(h, 0.95, ["g"]).collect()}
    assert got["a"] == 10.0  # rank lands in +Inf: highest finite bound
    assert got["b"] == pytest.approx(2.0 + 8.0 * 0.95)


def test_consumer_lag_and_paging(spark):
    from eventide.operators import orders

    r = recs(spark, [("k", "v", "t", 0, o) for o in range(10)] + [("k", "v", "t", 1, o) for o in range(5)])
    committed = spark.createDataFrame([("g", "t", 0, 4), ("g", "t", 1, 9)],
                                      "group_id string, topic string, partition int, committed long")
    assert metrics.consumer_lag(r, committed).collect()[0].lag == 6  # (10 - 4) + max(5 - 9, 0)
    o = spark.createDataFrame([(i, T0 + dt.timedelta(days=i % 3)) for i in range(250)], "id long, created_at timestamp")
    page = orders.orders_page(o, page=0, size=500).collect()
    assert len(page) == 100  # size capped at 100
    info = orders.orders_page_info(o, page=2, size=100).collect()[0]
    assert (info.total_pages, info.has_next, info.has_previous) == (3, False, True)
    top = [r.id for r in orders.recent(o, "created_at", "id", 3).collect()]
    assert top == [248, 245, 242]


def test_release_counting(spark):
    res = spark.createDataFrame([("a", "r-a"), ("b", "r-b")], "order_id string, reservation_id string")
    msgs = _cmd(spark, [("a", env({"orderId": "a"}), 1), ("c", env({"orderId": "c", "reservationId": "r-c"}), 2),
                        ("d", env({"orderId": "d"}), 3), ("a", env({"orderId": "a"}), 4)])
    remaining, released, results = listeners.apply_releases(res, msgs)
    assert [r.order_id for r in remaining.collect()] == ["b"]
    got = {r.order_id: (r.counted, r.reservation_id) for r in released.collect()}
    assert got == {"a": (True, "r-a"), "c": (True, "r-c"), "d": (False, None)}  # duplicate "a" skipped
    assert results.count() == 3
