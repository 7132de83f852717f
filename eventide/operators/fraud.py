"""Rule-based fraud scoring with a per-customer trailing velocity window,
order admission, review decisions and counters.

Velocity is the number of the customer's *earlier* orders whose time lies in
the trailing window ``(t - W, t)``; orders at the same instant count as
earlier when their id sorts first.  The count is exact and needs one plan for
any distribution.  Time is cut into grains of ``W / GRAINS``:

* whole grains between the window's two ends come from counts per
  (customer, grain), a partial aggregate, summed by a RANGE frame over those
  few rows;
* within its own grain an order counts the orders before it;
* at the window's far end it takes off the orders that have left the window:
  each order is copied once, as a ghost, to one window length later, where it
  meets the orders of that grain.

So a window group holds one customer's orders of a single grain (and as many
ghosts), and a busy customer is spread over as many tasks as it has grains.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.columns import epoch_micros


def _dec(x) -> Column:
    return F.lit(x).cast("decimal(12,2)")


#: grains of a velocity window; divides any whole number of minutes in microseconds
GRAINS = 64


def velocity_counts(
    orders: DataFrame,
    window_minutes: int = codes.FRAUD_VELOCITY_WINDOW_MINUTES,
    customer: str = "customer_id",
    ts: str = "created_at",
    order_id: str = "order_id",
) -> DataFrame:
    """Add ``velocity_count``; NULL customers get 0 and are never counted."""
    w_us = int(window_minutes) * 60 * 1_000_000
    width = w_us // GRAINS
    known = F.col(customer).isNotNull()

    def grain(us: Column) -> Column:
        return us - F.pmod(us, F.lit(width))

    base = orders.withColumn("_us", epoch_micros(orders, ts))
    counts = base.where(known).groupBy(customer, grain(F.col("_us")).alias("_g")).agg(F.count(F.lit(1)).alias("_n"))
    whole = F.sum("_n").over(Window.partitionBy(customer).orderBy("_g").rangeBetween(-w_us, -1))
    counts = counts.select(customer, "_g", F.coalesce(whole, F.lit(0)).alias("_whole"))

    def place(real: bool, us: Column, g: Column) -> Column:
        return F.struct(F.lit(real).alias("real"), us.alias("us"), g.alias("g"))

    us = F.col("_us")
    # orders without a customer go apart, each by its id
    places = F.when(known, F.array(place(True, us, grain(us)), place(False, us + w_us, grain(us + w_us)))).otherwise(
        F.array(place(True, us, F.xxhash64(order_id))))
    both = base.withColumn("_at", F.explode(places)).withColumn("_g", F.col("_at.g"))
    before = Window.partitionBy(customer, "_g").orderBy("_at.us", "_at.real", order_id).rowsBetween(
        Window.unboundedPreceding, -1)
    gained = F.coalesce(F.sum(F.when(F.col("_at.real"), 1).otherwise(-1)).over(before), F.lit(0))
    rows = both.withColumn("_gained", gained).where("_at.real").join(counts, [customer, "_g"], "left")
    velocity = F.when(known, F.coalesce("_whole", F.lit(0)) + F.col("_gained")).otherwise(0).cast("bigint")
    return rows.select(*orders.columns, velocity.alias("velocity_count"))


def fraud_score(
    orders: DataFrame,
    window_minutes: int = codes.FRAUD_VELOCITY_WINDOW_MINUTES,
    max_orders: int = codes.FRAUD_VELOCITY_MAX_ORDERS,
    customer: str = "customer_id",
    ts: str = "created_at",
    total: str = "total",
    order_id: str = "order_id",
) -> DataFrame:
    """Score every order: the four parts, the capped score, action and reason."""
    t = F.col(total)
    hv = t > _dec(codes.FRAUD_HIGH_VALUE)
    value_score = F.when(~hv, F.lit(0))
    for bound, pts in codes.FRAUD_VALUE_TIERS:
        value_score = value_score.when(t >= _dec(bound), F.lit(pts))
    value_score = value_score.otherwise(F.lit(codes.FRAUD_VALUE_BASE))
    v = F.col("velocity_count")
    velocity_score = (
        F.when(F.col(customer).isNull(), F.lit(0))
        .when(v >= max_orders, F.lit(codes.FRAUD_VELOCITY_HIGH))
        .when(v >= max_orders // 2, F.lit(codes.FRAUD_VELOCITY_LOW))
        .otherwise(F.lit(0))
    )
    rem = t % _dec(100)
    round_score = F.when((rem == 0) | (rem == 50), F.lit(codes.FRAUD_ROUND_SCORE)).otherwise(F.lit(0))
    lo, hi = codes.FRAUD_OFF_HOURS
    off_score = F.when(F.hour(ts).between(lo, hi), F.lit(codes.FRAUD_OFF_HOURS_SCORE)).otherwise(F.lit(0))

    scored = velocity_counts(orders, window_minutes, customer, ts, order_id).select(
        "*",
        value_score.alias("value_score"),
        velocity_score.alias("velocity_score"),
        round_score.alias("round_score"),
        off_score.alias("off_hours_score"),
    )
    raw = F.col("value_score") + F.col("velocity_score") + F.col("round_score") + F.col("off_hours_score")
    score = F.least(raw, F.lit(codes.FRAUD_SCORE_CAP)).cast("decimal(5,2)")
    reason = F.concat_ws(
        "; ",
        F.when(hv, F.format_string(codes.REASON_HIGH_VALUE, t.cast("double"), F.col("value_score").cast("double"))),
        F.when(F.col("velocity_score") > 0,
               F.format_string(codes.REASON_VELOCITY, F.col("velocity_score").cast("double"))),
        F.when(F.col("round_score") > 0, F.lit(codes.REASON_ROUND)),
        F.when(F.col("off_hours_score") > 0, F.lit(codes.REASON_OFF_HOURS)),
    )
    scored = scored.withColumn("fraud_score", score).withColumn("reason", reason)
    action = (
        F.when(F.col("fraud_score") >= codes.FRAUD_REJECT_SCORE, F.lit("REJECT"))
        .when((F.col("fraud_score") >= codes.FRAUD_REVIEW_SCORE) | hv, F.lit("REVIEW"))
        .otherwise(F.lit("APPROVE"))
    )
    return scored.withColumn("action", action)


def order_admission(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(orders, outbox).  REJECT -> REJECTED, REVIEW -> PENDING_REVIEW with the
    reason, APPROVE -> NEW plus one ``OrderCreated`` outbox row."""
    status = (
        F.when(F.col("action") == "REJECT", F.lit("REJECTED"))
        .when(F.col("action") == "REVIEW", F.lit("PENDING_REVIEW"))
        .otherwise(F.lit("NEW"))
    )
    orders = scored.select(
        F.col("order_id").alias("id"),
        "customer_id", "total", "created_at",
        F.col("fraud_score"),
        F.when(F.col("action") != "APPROVE", F.col("reason")).alias("review_reason"),
        status.alias("status"),
        *([F.col("shipping_address")] if "shipping_address" in scored.columns
          else [F.lit(None).cast("string").alias("shipping_address")]),
    )
    outbox = outbox_rows(orders.where(F.col("status") == "NEW"), "created_at")
    return orders, outbox


def outbox_rows(orders: DataFrame, at: str) -> DataFrame:
    """``order_outbox`` rows for published orders; id is a deterministic hash."""
    payload = F.to_json(
        F.struct(
            F.col("id").alias("orderId"),
            F.col("total").cast("double").alias("total"),
            F.lit(codes.CURRENCY_DEFAULT).alias("currency"),
            F.col("customer_id").alias("customerId"),
            F.col("shipping_address").alias("shippingAddress"),
        ),
        {"ignoreNullFields": "false"},
    )
    return orders.select(
        F.md5(F.concat_ws(":", F.col("id"), F.lit("OrderCreated"),
                          epoch_micros(orders, at).cast("string"))).alias("id"),
        F.col("id").alias("aggregate_id"),
        F.lit("Order").alias("aggregate_type"),
        F.lit("OrderCreated").alias("type"),
        payload.alias("payload"),
        F.col(at).alias("occurred_at"),
    )


def _numbered(decisions: DataFrame) -> DataFrame:
    """Decisions with an id each; equal rows without one are told apart by number."""
    if "decision_id" in decisions.columns:
        return decisions
    same = Window.partitionBy("order_id", "ts", "decision", "reason").orderBy(F.lit(1))
    return decisions.withColumn("decision_id", F.concat_ws(":", "decision", F.format_string("%012d", F.row_number().over(same)), "reason"))


def apply_review_decisions(orders: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Apply approve/reject decisions (order_id, decision, reason, ts, decision_id) one after the other.

    The decisions of an order take effect by (ts, decision_id); the id tells
    decisions of one instant apart.  An approval is legal if the order is in
    PENDING_REVIEW at that time; a rejection is legal from any status (default
    reason).  Since the first decision ends PENDING_REVIEW either way, only an
    order's first decision can be a legal approval, and the status at any time
    follows from the first decision and the first rejection: both are partial
    aggregates, so a flood of decisions for one order is combined map-side and
    no order's decisions form a window group.

    Returns (orders, outbox, refused): refused decisions carry the error with
    the status at their time, or that there is no such order.
    """
    decisions = _numbered(decisions)
    at = F.struct("ts", "decision_id")
    reject = F.col("decision") == "REJECT"
    per = decisions.groupBy("order_id").agg(
        F.min(F.struct("ts", "decision_id", "decision")).alias("_first"),
        F.min(F.when(reject, at)).alias("_rejected"),
        F.max_by(F.struct(F.coalesce(F.col("reason"), F.lit(codes.DEFAULT_REJECT_REASON)).alias("v")), F.when(reject, at))["v"].alias("_reject_reason"),
    )
    approved = (F.col("status") == "PENDING_REVIEW") & (F.col("_first.decision") == "APPROVE")
    j = orders.join(per.withColumnRenamed("order_id", "_order_id"), orders["id"] == F.col("_order_id"), "left").drop("_order_id")
    out = (
        j.withColumn("_approved", F.coalesce(approved, F.lit(False)))
        .withColumn("review_reason", F.when(F.col("_rejected").isNotNull(), F.col("_reject_reason")).otherwise(F.col("review_reason")))
        .withColumn("status", F.when(F.col("_rejected").isNotNull(), "REJECTED").when(F.col("_approved"), "APPROVED").otherwise(F.col("status")))
        .withColumn("_at", F.col("_first.ts"))
    )
    outbox = outbox_rows(out.where("_approved"), "_at")
    orders_out = out.select(*orders.columns)

    known = per.join(orders.select(F.col("id").alias("order_id"), "status"), "order_id", "left")
    now = (
        F.when(F.col("_rejected") < at, F.lit("REJECTED"))
        .when((F.struct(F.col("_first.ts").alias("ts"), F.col("_first.decision_id").alias("decision_id")) < at) & approved, F.lit("APPROVED"))
        .otherwise(F.col("status"))
    )
    refused = decisions.join(known, "order_id").select(
        "order_id", "decision", "ts", "decision_id",
        F.when(F.col("status").isNull(), F.concat(F.lit(codes.ERROR_ORDER_NOT_FOUND), F.col("order_id")))
        .when(~reject & (now != "PENDING_REVIEW"), F.concat(F.lit(codes.ERROR_CANNOT_APPROVE), now)).alias("error_reason"),
    ).where(F.col("error_reason").isNotNull())
    return orders_out, outbox, refused


def fraud_counters(scored: DataFrame) -> DataFrame:
    """scanned, flagged (REVIEW), auto_rejected (REJECT) in one pass."""
    return scored.agg(
        F.count(F.lit(1)).alias("scanned"),
        F.count_if(F.col("action") == "REVIEW").alias("flagged"),
        F.count_if(F.col("action") == "REJECT").alias("auto_rejected"),
    )


def fraud_flag_ratio(scored: DataFrame, total: str = "total") -> DataFrame:
    """Share of high-value orders that were flagged or rejected (objective >= 95 %)."""
    hv = F.col(total) > _dec(codes.FRAUD_HIGH_VALUE)
    flagged = hv & F.col("action").isin("REVIEW", "REJECT")
    return scored.agg(
        F.count_if(hv).alias("high_value"),
        F.count_if(flagged).alias("flagged_high_value"),
    ).withColumn(
        "flag_ratio_pct",
        F.when(F.col("high_value") > 0,
               F.round(F.lit(100.0) * F.col("flagged_high_value") / F.col("high_value"), 6)),
    )
