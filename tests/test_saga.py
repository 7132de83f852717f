"""Saga state machine cases (reference orchestrator tests)."""

import datetime as dt

from eventide.operators import saga

T0 = dt.datetime(2024, 1, 1, 12, 0)
SCHEMA = "order_id string, seq long, ts timestamp, event_type string, ref_id string, reason string, " \
         "shipping_address string"


def run(spark, events):
    rows = [(o, i, T0 + dt.timedelta(minutes=i), e, ref, rsn, addr)
            for i, (o, e, ref, rsn, addr) in enumerate(events)]
    t = saga.saga_transitions(spark.createDataFrame(rows, SCHEMA))
    state = {r.order_id: r for r in saga.saga_current_state(t).collect()}
    cmds = sorted((r.order_id, r.cmd_order, r.compensation_type, r.ref_id) for r in saga.compensation_plan(t).collect())
    return t, state, cmds


def ev(o, e, ref=None, rsn=None, addr=None):
    return (o, e, ref, rsn, addr)


def test_happy_path(spark):
    _, s, c = run(spark, [ev("a", "OrderCreated", addr="X"), ev("a", "PaymentCompleted", "p1"),
                          ev("a", "InventoryReserved", "r1"), ev("a", "ShippingCompleted", "s1")])
    assert s["a"].state == "COMPLETED" and s["a"].shipping_id == "s1" and c == []


def test_payment_failed_cancels(spark):
    _, s, c = run(spark, [ev("a", "OrderCreated"), ev("a", "PaymentFailed", rsn="declined")])
    assert (s["a"].state, s["a"].failed_state, s["a"].failure_reason) == ("COMPENSATING", "PAYMENT_FAILED", "declined")
    assert c == [("a", 3, "CANCEL", None)]


def test_inventory_failed_refunds_and_cancels(spark):
    _, _, c = run(spark, [ev("a", "OrderCreated"), ev("a", "PaymentCompleted", "p1"), ev("a", "InventoryFailed")])
    assert c == [("a", 2, "REFUND", "p1"), ("a", 3, "CANCEL", None)]
    _, _, c = run(spark, [ev("b", "OrderCreated"), ev("b", "InventoryFailed")])
    assert c == [("b", 3, "CANCEL", None)]


def test_shipping_failed_full_compensation(spark):
    _, _, c = run(spark, [ev("a", "OrderCreated"), ev("a", "PaymentCompleted", "p1"),
                          ev("a", "InventoryReserved", "r1"), ev("a", "ShippingFailed")])
    assert c == [("a", 1, "RELEASE", "r1"), ("a", 2, "REFUND", "p1"), ("a", 3, "CANCEL", None)]


def test_compensated_unknown_and_unguarded(spark):
    _, s, _ = run(spark, [ev("a", "OrderCreated"), ev("a", "PaymentFailed"), ev("a", "CompensationCompleted"),
                          ev("x", "PaymentCompleted", "p"), ev("b", "OrderCreated"), ev("b", "InventoryReserved", "r"),
                          ev("b", "OrderCreated")])
    assert s["a"].state == "COMPENSATED"
    assert "x" not in s  # events without a start are ignored
    assert s["b"].state == "INVENTORY_RESERVED"  # no guard, duplicate start is a no-op


def test_status_feed_and_counters(spark):
    t, _, _ = run(spark, [ev("a", "OrderCreated"), ev("a", "PaymentFailed", rsn="r"),
                          ev("a", "CompensationCompleted"), ev("b", "OrderCreated"), ev("b", "ShippingCompleted", "s")])
    feed = sorted((r.order_id, r.status) for r in saga.saga_status_feed(t).collect())
    assert feed == [("a", "CANCELLED"), ("a", "PAYMENT_FAILED"), ("b", "COMPLETED")]
    c = saga.saga_counters(t).collect()[0]
    assert (c.started, c.failed, c.compensations_completed, c.succeeded) == (2, 1, 1, 1)


def test_timeouts_and_retries(spark):
    _, _, _ = None, None, None
    t, _, _ = run(spark, [ev("a", "OrderCreated"), ev("b", "OrderCreated"), ev("b", "PaymentCompleted", "p"),
                          ev("b", "InventoryFailed", rsn="oos")])
    state = saga.saga_current_state(t)
    as_of = T0 + dt.timedelta(hours=1)
    new_state, cmds = saga.stuck_pending(state, as_of)
    s = {r.order_id: r for r in new_state.collect()}
    assert s["a"].state == "COMPENSATING" and s["a"].failure_reason == "Timeout waiting for PAYMENT_PENDING response"
    assert [r.compensation_type for r in cmds.collect()] == ["CANCEL"]
    st2, cmds2 = saga.stuck_compensations(state, as_of)
    assert {r.order_id: r.retry_count for r in st2.collect()} == {"a": 0, "b": 1}
    assert sorted((r.compensation_type, r.reason) for r in cmds2.collect()) == [
        ("CANCEL", "Retry compensation attempt #1"), ("REFUND", "Retry compensation attempt #1")]
    # not yet old enough
    assert saga.stuck_pending(state, T0 + dt.timedelta(minutes=5))[1].count() == 0


def test_carry_forward_across_ranges(spark):
    """The range-split carry equals a plain per-key window, hot key included."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from eventide.operators.carry import carry_last_before

    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise((F.col("id") % 13).cast("string")).alias("k"),
        F.col("id").alias("o"),
        F.when(F.col("id") % 17 == 0, F.concat(F.lit("v"), F.col("id").cast("string"))).alias("x"),
        (F.col("id") % 5 == 0).alias("flag"))
    got = carry_last_before(df, "k", "o", {"c": (F.col("flag"), F.col("x"))}, num_ranges=7)
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("c", F.last(F.when(F.col("flag"), F.struct(F.col("x").alias("v"))), True).over(w)["v"])
    a = sorted((r.k, r.o, r.c) for r in got.collect())
    b = sorted((r.k, r.o, r.c) for r in want.collect())
    assert a == b


def test_direct_state_equals_transition_state(spark):
    from eventide.sources import driver_tables as dt

    from .conftest import SF01

    ev = dt.saga_events(dt.table(spark, SF01, "events"))
    extra = spark.createDataFrame(  # pre-start events, duplicate starts, unknown orders
        [("z", 1, T0, "PaymentFailed", None, "early", None), ("z", 2, T0, "OrderCreated", None, None, "A"),
         ("z", 3, T0, "OrderCreated", None, None, "B"), ("y", 5, T0, "PaymentCompleted", "p", None, None)], SCHEMA)
    ev = ev.unionByName(extra)
    a = saga.saga_state(ev)
    b = saga.saga_current_state(saga.saga_transitions(ev))
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    ra = sorted(tuple(str(r[c]) for c in cols) for r in a.collect())
    rb = sorted(tuple(str(r[c]) for c in cols) for r in b.collect())
    assert ra == rb


def test_pending_inventory_timeout_refunds_and_default_address(spark):
    t, s, _ = run(spark, [ev("a", "OrderCreated"), ev("a", "PaymentCompleted", "p1"), ev("a", "InventoryRequested"),
                          ev("b", "OrderCreated", addr="  "), ev("b", "ShippingRequested")])
    state = saga.saga_current_state(t)
    new_state, cmds = saga.stuck_pending(state, T0 + dt.timedelta(hours=2))
    got = {r.order_id: (r.state, r.failed_state) for r in new_state.collect()}
    assert got["a"] == ("COMPENSATING", "INVENTORY_FAILED") and got["b"] == ("COMPENSATING", "SHIPPING_FAILED")
    c = sorted((r.order_id, r.compensation_type, r.ref_id) for r in cmds.collect())
    assert c == [("a", "CANCEL", None), ("a", "REFUND", "p1"), ("b", "CANCEL", None)]
    req = t.where("event_type = 'ShippingRequested'").select("order_id", "seq")
    addr = {r.order_id: r.address for r in saga.enrich_shipping_address(req, state).collect()}
    assert addr == {"b": "Default Address - Please Update"}
