"""Fraud scoring cases (reference fraud-detection tests)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from eventide.operators import fraud

T0 = dt.datetime(2024, 1, 1, 12, 0)


def score(spark, rows, **kw):
    df = spark.createDataFrame(
        [(str(i), c, T0 + dt.timedelta(minutes=m), Decimal(t)) for i, (c, m, t) in enumerate(rows)],
        "order_id string, customer_id string, created_at timestamp, total decimal(12,2)")
    return {r.order_id: r for r in fraud.fraud_score(df, **kw).collect()}


def test_value_tiers(spark):
    r = score(spark, [("a", 0, "1500.00"), ("b", 0, "2500.00"), ("c", 0, "6000.00"), ("d", 0, "500.00")])
    assert r["0"].action == "REVIEW" and r["0"].fraud_score >= 20 and "High value order" in r["0"].reason
    assert r["1"].fraud_score >= 35 and r["2"].fraud_score >= 50
    assert "High value order" not in r["3"].reason
    assert r["0"].reason.startswith("High value order: $1500.00 (score +20.0)")


def test_velocity(spark):
    rows = [("a", i, "50.00") for i in range(6)]
    r = score(spark, rows)
    assert r["5"].velocity_count == 5 and "Velocity anomaly" in r["5"].reason and r["5"].fraud_score > 0
    assert r["0"].velocity_count == 0
    r2 = score(spark, [("a", 0, "100.00"), ("b", 1, "100.00")])
    assert "Velocity" not in r2["1"].reason


def test_velocity_window_edges_and_ties(spark):
    # 60 min window: an order exactly 60 min earlier is outside
    r = score(spark, [("a", 0, "10.00"), ("a", 60, "10.00"), ("a", 60, "10.00")])
    assert r["1"].velocity_count == 0  # ties: the earlier id counts, not the later one
    assert r["2"].velocity_count == 1


def test_round_amounts(spark):
    r = score(spark, [("a", 0, "100.00"), ("b", 0, "150.00"), ("c", 0, "123.45"), ("d", 0, "1000.00"),
                      ("e", 0, "0.00")])
    assert "round amount" in r["0"].reason and "round amount" in r["1"].reason
    assert "round amount" not in r["2"].reason
    assert "High value" not in r["3"].reason and "round amount" in r["3"].reason
    assert r["4"].action == "APPROVE"


def test_actions(spark):
    r = score(spark, [("a", 0, "50.00"), ("b", 0, "1001.00")])
    assert r["0"].action == "APPROVE" and r["1"].action == "REVIEW"
    rows = [("a", i, "50.00") for i in range(5)] + [("a", 5, "5000.00")]
    r = score(spark, rows)
    assert r["5"].fraud_score >= 90 and r["5"].action == "REJECT"
    rows = [("a", i, "100.00") for i in range(10)] + [("a", 10, "10000.00")]
    assert score(spark, rows)["10"].fraud_score <= 100


def test_null_customer_and_off_hours(spark):
    r = score(spark, [(None, 0, "100.00"), (None, 1, "100.00")])
    assert r["1"].velocity_count == 0
    df = spark.createDataFrame([("x", "c", dt.datetime(2024, 1, 1, 3, 0), Decimal("10.00"))],
                               "order_id string, customer_id string, created_at timestamp, total decimal(12,2)")
    assert fraud.fraud_score(df).collect()[0].off_hours_score == 10


def test_admission_and_review(spark):
    rows = [("a", 0, "50.00"), ("b", 0, "1500.00"), ("c", 0, "1600.00")]
    df = spark.createDataFrame(
        [(str(i), c, T0 + dt.timedelta(minutes=m), Decimal(t)) for i, (c, m, t) in enumerate(rows)],
        "order_id string, customer_id string, created_at timestamp, total decimal(12,2)")
    orders, outbox = fraud.order_admission(fraud.fraud_score(df))
    st = {r.id: r.status for r in orders.collect()}
    assert st == {"0": "NEW", "1": "PENDING_REVIEW", "2": "PENDING_REVIEW"}
    assert [r.aggregate_id for r in outbox.collect()] == ["0"]
    dec = spark.createDataFrame([("1", "APPROVE", None, T0), ("2", "REJECT", None, T0), ("0", "APPROVE", None, T0)],
                                "order_id string, decision string, reason string, ts timestamp")
    o2, ob2, rej = fraud.apply_review_decisions(orders, dec)
    st2 = {r.id: (r.status, r.review_reason) for r in o2.collect()}
    assert st2["1"][0] == "APPROVED" and st2["2"] == ("REJECTED", "Rejected during manual review")
    assert [r.aggregate_id for r in ob2.collect()] == ["1"]
    assert [r.order_id for r in rej.collect()] == ["0"]


def test_review_decisions_one_after_the_other(spark):
    """Ties, late approvals, missing orders: against a loop over the decisions in order."""
    import random

    rnd = random.Random(4)
    orders = [(str(i), rnd.choice(["PENDING_REVIEW", "PENDING_REVIEW", "NEW", "REJECTED"])) for i in range(60)]
    made = [(str(rnd.randrange(70)), rnd.choice(["APPROVE", "APPROVE", "REJECT"]), rnd.choice([None, "why", "other"]),
             T0 + dt.timedelta(hours=rnd.randrange(3)), f"d{k:04d}") for k in range(300)]
    odf = spark.createDataFrame([(i, "c", Decimal("5.00"), T0, None, s, None) for i, s in orders],
                                "id string, customer_id string, total decimal(12,2), created_at timestamp, review_reason string, status string, shipping_address string")
    ddf = spark.createDataFrame(made, "order_id string, decision string, reason string, ts timestamp, decision_id string")
    status, reason, sent, refused = dict(orders), {}, {}, {}
    for i, decision, why, ts, did in sorted(made, key=lambda d: (d[3], d[4])):
        if i not in status:
            refused[did] = f"Order not found: {i}"
        elif decision == "REJECT":
            status[i], reason[i] = "REJECTED", why or "Rejected during manual review"
        elif status[i] == "PENDING_REVIEW":
            status[i], sent[i] = "APPROVED", ts
        else:
            refused[did] = f"Cannot approve order in status: {status[i]}"
    o, outbox, ref = fraud.apply_review_decisions(odf, ddf)
    assert {r.id: (r.status, r.review_reason) for r in o.collect()} == {i: (s, reason.get(i)) for i, s in status.items()}
    assert {r.aggregate_id: r.occurred_at for r in outbox.collect()} == sent and outbox.count() == len(sent)
    assert {r.decision_id: r.error_reason for r in ref.collect()} == refused
    # equal decisions without ids: one is legal, the others are refused
    twice = spark.createDataFrame([("p", "APPROVE", None, T0)] * 3, "order_id string, decision string, reason string, ts timestamp")
    one = odf.limit(1).withColumn("id", F.lit("p")).withColumn("status", F.lit("PENDING_REVIEW"))
    _, outbox, ref = fraud.apply_review_decisions(one, twice)
    assert outbox.count() == 1 and [r.error_reason for r in ref.collect()] == ["Cannot approve order in status: APPROVED"] * 2


def _brute_velocity(rows, minutes):
    """rows: (order_id, customer, time)."""
    out = {}
    for i, c, t in rows:
        out[i] = 0 if c is None else sum(
            1 for j, d, u in rows if d == c and t - dt.timedelta(minutes=minutes) < u and (u, j) < (t, i))
    return out


def test_velocity_equals_brute_force(spark):
    """Numeric ids at one instant (9, 10, 11 sort as numbers), one customer with a third of the rows in a burst,
    orders exactly a window apart, orders without a customer."""
    import random

    rnd = random.Random(2)
    rows = [(i, "tie", T0) for i in (9, 10, 11)]
    rows += [(100 + i, "hot", T0 + dt.timedelta(milliseconds=rnd.randrange(0, 90_000))) for i in range(200)]
    rows += [(400 + i, f"c{i % 5}", T0 + dt.timedelta(minutes=rnd.randrange(0, 240))) for i in range(300)]
    rows += [(800 + i, None, T0) for i in range(20)]
    rows += [(900 + i, "edge", T0 + dt.timedelta(minutes=60 * i)) for i in range(4)]
    rows += [(950, "edge", T0 + dt.timedelta(minutes=59, seconds=59, microseconds=999_999))]
    df = spark.createDataFrame(rows, "order_id bigint, customer_id string, created_at timestamp")
    for minutes in (1, 60):
        got = {r.order_id: r.velocity_count for r in fraud.velocity_counts(df, minutes).collect()}
        assert got == _brute_velocity(rows, minutes)
        assert [got[i] for i in (9, 10, 11)] == [0, 1, 2]


def test_velocity_runs_no_job_while_built(spark):
    df = spark.createDataFrame([(1, "a", T0)], "order_id bigint, customer_id string, created_at timestamp")
    spark.sparkContext.setJobGroup("velocity-build", "no job expected")
    fraud.velocity_counts(df, 60)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("velocity-build")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
