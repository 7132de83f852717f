"""Event-sourced order saga in batch form.

Input is a typed event log ``(order_id, seq, ts, event_type, ref_id, reason,
shipping_address)``.  The reference mutates one ``saga_instance`` row per
event; here every step is a set operation over the log:

* ``saga_transitions`` - gate: an order's events count only from its first
  ``OrderCreated`` on (later starts are no-ops, events for unknown orders are
  ignored), then each event sets the next state.  There is no guard on the
  previous state, as in the reference.  The gate is one aggregate (min seq of
  the start events, partial-aggregated map-side) joined back on ``order_id``;
  the join side is one row per order, so AQE can split a hot order's events
  across tasks.
* ``saga_current_state`` - one ``groupBy(order_id)`` with ``max_by`` per
  column: the latest state, the latest failure, the id written by the latest
  event that sets it.  All are partial aggregates (no group is materialised).
* ``compensation_plan`` - ids carried forward to each failure (latest earlier
  payment / reservation of the order) with the skew-safe range-partitioned
  carry of ``operators.carry``, then 1..3 commands per failure via
  ``explode`` of a filtered array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.columns import case_map, epoch_micros
from .carry import carry_last_before

EVENT_STATE = [(e, s) for e, s, _ in codes.SAGA_EVENTS]
EVENT_FAILED = [(e, f) for e, _, f in codes.SAGA_EVENTS if f]
FAILURE_EVENTS = [e for e, _ in EVENT_FAILED]
PENDING_TO_FAILED = [
    ("PAYMENT_PENDING", "PAYMENT_FAILED"),
    ("INVENTORY_PENDING", "INVENTORY_FAILED"),
    ("SHIPPING_PENDING", "SHIPPING_FAILED"),
]

STATE_COLUMNS = [
    "order_id", "state", "failed_state", "payment_id", "inventory_reservation_id",
    "shipping_id", "shipping_address", "failure_reason", "retry_count",
    "created_at", "updated_at",
]


def saga_transitions(events: DataFrame) -> DataFrame:
    """One row per applied event: the state it leads to and what it records."""
    known = events.where(F.col("event_type").isin(*[e for e, _ in EVENT_STATE]))
    starts = (
        known.where(F.col("event_type") == codes.SAGA_START_EVENT)
        .groupBy("order_id")
        .agg(
            F.min_by(F.struct(F.col("seq"), F.col("ts"), F.col("shipping_address")), F.col("seq")).alias("_s")
        )
        .select(
            "order_id",
            F.col("_s.seq").alias("start_seq"),
            F.col("_s.ts").alias("created_at"),
            F.col("_s.shipping_address").alias("saga_address"),
        )
    )
    gated = known.join(starts, "order_id").where(
        (F.col("seq") == F.col("start_seq"))
        | ((F.col("seq") > F.col("start_seq")) & (F.col("event_type") != codes.SAGA_START_EVENT))
    )
    return gated.select(
        "order_id", "seq", "ts", "event_type",
        case_map("event_type", EVENT_STATE).alias("state"),
        case_map("event_type", EVENT_FAILED).alias("failed_state"),
        "ref_id", "reason", "created_at", "saga_address",
    )


def _latest(value: Column, when: Column) -> Column:
    """Value written by the latest event satisfying ``when`` (NULL kept)."""
    return F.max_by(F.struct(value.alias("v")), F.when(when, F.col("seq")))["v"]


def saga_current_state(transitions: DataFrame) -> DataFrame:
    """The ``saga_instance`` table: one row per started order."""
    et = F.col("event_type")
    return transitions.groupBy("order_id").agg(
        F.max_by(F.col("state"), F.col("seq")).alias("state"),
        _latest(F.col("failed_state"), et.isin(*FAILURE_EVENTS)).alias("failed_state"),
        _latest(F.col("ref_id"), et == "PaymentCompleted").alias("payment_id"),
        _latest(F.col("ref_id"), et == "InventoryReserved").alias("inventory_reservation_id"),
        _latest(F.col("ref_id"), et == "ShippingCompleted").alias("shipping_id"),
        F.max(F.col("saga_address")).alias("shipping_address"),
        _latest(F.col("reason"), et.isin(*FAILURE_EVENTS)).alias("failure_reason"),
        F.lit(0).alias("retry_count"),
        F.min(F.col("created_at")).alias("created_at"),
        F.max_by(F.col("ts"), F.col("seq")).alias("updated_at"),
    ).select(*STATE_COLUMNS)


def with_carried_ids(transitions: DataFrame) -> DataFrame:
    """Add payment_id / reservation_id as known just before each event.

    Only the rows that set or need an id take part (payments, reservations,
    failures); the as-of carry is skew-safe (``carry.carry_last_before``)."""
    et = F.col("event_type")
    needed = transitions.where(et.isin("PaymentCompleted", "InventoryReserved", *FAILURE_EVENTS))
    return carry_last_before(needed, "order_id", "seq", {
        "payment_id": (et == "PaymentCompleted", F.col("ref_id")),
        "reservation_id": (et == "InventoryReserved", F.col("ref_id")),
    })


def _commands(failed_state: Column, payment_id: Column, reservation_id: Column, reason: Column) -> Column:
    """Array of command structs for one failure (filtered to the applicable)."""

    def cmd(topic, ctype, etype, ref, order):
        return F.struct(
            F.lit(order).alias("cmd_order"),
            F.lit(topic).alias("topic"),
            F.lit(ctype).alias("compensation_type"),
            F.lit(etype).alias("envelope_type"),
            ref.cast("string").alias("ref_id"),
        )

    release = F.when((failed_state == "SHIPPING_FAILED") & reservation_id.isNotNull(),
                     cmd(codes.TOPIC_INVENTORY_RELEASE, codes.COMPENSATION_RELEASE, codes.ENVELOPE_RELEASE,
                         reservation_id, 1))
    refund = F.when(failed_state.isin("INVENTORY_FAILED", "SHIPPING_FAILED") & payment_id.isNotNull(),
                    cmd(codes.TOPIC_PAYMENT_REFUND, codes.COMPENSATION_REFUND, codes.ENVELOPE_REFUND,
                        payment_id, 2))
    cancel = F.when(failed_state.isNotNull(),
                    cmd(codes.TOPIC_ORDER_CANCEL, codes.COMPENSATION_CANCEL, codes.ENVELOPE_CANCEL,
                        F.lit(None), 3))
    return F.filter(F.array(release, refund, cancel), lambda x: x.isNotNull())


def _command_rows(df: DataFrame, failed_state: Column, reason: Column, keep: list[str]) -> DataFrame:
    exploded = df.select(
        *keep, reason.alias("reason"),
        F.explode(_commands(failed_state, F.col("payment_id"), F.col("reservation_id"), reason)).alias("c"),
    )
    ref_name = (
        F.when(F.col("c.compensation_type") == codes.COMPENSATION_REFUND, F.lit("paymentId"))
        .when(F.col("c.compensation_type") == codes.COMPENSATION_RELEASE, F.lit("reservationId"))
    )
    payload = F.when(
        ref_name.isNull(),
        F.to_json(F.struct(F.col("order_id").alias("orderId"), F.col("reason").alias("reason"),
                           F.col("c.compensation_type").alias("compensationType")),
                  {"ignoreNullFields": "false"}),
    ).when(
        ref_name == "paymentId",
        F.to_json(F.struct(F.col("order_id").alias("orderId"), F.col("c.ref_id").alias("paymentId"),
                           F.col("reason").alias("reason"),
                           F.col("c.compensation_type").alias("compensationType")),
                  {"ignoreNullFields": "false"}),
    ).otherwise(
        F.to_json(F.struct(F.col("order_id").alias("orderId"), F.col("c.ref_id").alias("reservationId"),
                           F.col("reason").alias("reason"),
                           F.col("c.compensation_type").alias("compensationType")),
                  {"ignoreNullFields": "false"}),
    )
    return exploded.select(
        *keep,
        F.col("c.cmd_order").alias("cmd_order"),
        F.col("c.topic").alias("topic"),
        F.col("order_id").alias("key"),
        F.col("c.compensation_type").alias("compensation_type"),
        F.col("c.envelope_type").alias("envelope_type"),
        F.col("c.ref_id").alias("ref_id"),
        "reason",
        payload.alias("payload"),
    )


def compensation_plan(transitions: DataFrame) -> DataFrame:
    """Compensation commands for every failure event, in the reference's order
    (release, refund, cancel) per failure."""
    carried = with_carried_ids(transitions).where(F.col("failed_state").isNotNull())
    return _command_rows(carried, F.col("failed_state"), F.col("reason"), ["order_id", "seq"])


def saga_status_feed(transitions: DataFrame) -> DataFrame:
    """Rows for ``order.status.update``: failures, completion, compensation."""
    et = F.col("event_type")
    status = (
        F.when(F.col("failed_state").isNotNull(), F.col("failed_state"))
        .when(et == "ShippingCompleted", F.lit("COMPLETED"))
        .when(et == "CompensationCompleted", F.lit("CANCELLED"))
    )
    reason = (
        F.when(F.col("failed_state").isNotNull(), F.col("reason"))
        .when(et == "CompensationCompleted", F.lit(codes.REASON_COMPENSATED))
    )
    out = transitions.select("order_id", "seq", status.alias("status"), reason.alias("reason")).where(
        F.col("status").isNotNull())
    return out.withColumn(
        "value",
        F.to_json(F.struct(F.col("order_id").alias("orderId"), F.col("status").alias("status"),
                           F.col("reason").alias("reason")), {"ignoreNullFields": "false"}),
    )


def saga_counters(transitions: DataFrame) -> DataFrame:
    """started, failed (each failure once), compensations triggered/completed, succeeded."""
    et = F.col("event_type")
    return transitions.agg(
        F.count_if(et == codes.SAGA_START_EVENT).alias("started"),
        F.count_if(F.col("failed_state").isNotNull()).alias("failed"),
        F.count_if(F.col("failed_state").isNotNull()).alias("compensations_triggered"),
        F.count_if(et == "CompensationCompleted").alias("compensations_completed"),
        F.count_if(et == "ShippingCompleted").alias("succeeded"),
    )


def burn_rate_cumulative(transitions: DataFrame) -> DataFrame:
    """Orchestrator burn rate: (failed / started) * 100 truncated; NULL if none started."""
    c = saga_counters(transitions)
    return c.select(
        "started", "failed",
        F.when(F.col("started") > 0, (F.lit(100.0) * F.col("failed") / F.col("started")).cast("bigint"))
        .alias("burn_rate"),
    )


def _millis(df: DataFrame, later: str, earlier: str) -> Column:
    return (epoch_micros(df, later) - epoch_micros(df, earlier)).cast("double") / F.lit(1000.0).cast("double")


def processing_durations(transitions: DataFrame, keep: tuple[str, ...] = ("order_id", "seq")) -> DataFrame:
    """Saga processing time created -> completed, in milliseconds."""
    done = transitions.where(F.col("event_type") == "ShippingCompleted")
    return done.select(*keep, _millis(done, "ts", "created_at").alias("duration_ms"))


def recent_durations(events: DataFrame, since, until) -> DataFrame:
    """``processing_durations`` of the sagas completed in (since, until], from the event log.

    Only the completions of that range are taken (the range reaches the scan),
    and only the starts of their orders are aggregated; no other event moves."""
    s, u = (F.lit(x).cast("timestamp_ntz") if not isinstance(x, Column) else x for x in (since, until))
    done = events.where((F.col("ts") > s) & (F.col("ts") <= u)).where(F.col("event_type") == "ShippingCompleted").select("order_id", "seq", "ts")
    started = events.where(F.col("event_type") == codes.SAGA_START_EVENT).select("order_id", "seq", "ts")
    own = started.join(done.select("order_id").distinct(), "order_id", "left_semi")
    first = own.groupBy("order_id").agg(F.min("seq").alias("_start"), F.min_by("ts", "seq").alias("created_at"))
    j = done.join(first, "order_id").where(F.col("seq") > F.col("_start"))
    return j.select("order_id", "seq", _millis(j, "ts", "created_at").alias("duration_ms"))


#: service -> events that ask it for something, events that answer
STAGES = {
    "payment-svc": (["OrderCreated"], ["PaymentCompleted", "PaymentFailed"]),
    "inventory-svc": (["PaymentCompleted", "InventoryRequested"], ["InventoryReserved", "InventoryFailed"]),
    "shipping-svc": (["InventoryReserved", "ShippingRequested"], ["ShippingCompleted", "ShippingFailed"]),
}


def stage_durations(transitions: DataFrame) -> DataFrame:
    """How long each service took for a message: (order_id, seq, service, duration_ms).

    From the order's latest request to the service to the service's answer; an
    answer without an earlier request, or that is dated before it, is left out.
    The latest request is carried along ranges (``carry_last_before``), so a hot
    order is split over tasks."""
    et = F.col("event_type")
    asked = {f"_at{k}": (et.isin(*ask), F.col("ts")) for k, (ask, _) in enumerate(STAGES.values())}
    t = carry_last_before(transitions.select("order_id", "seq", "ts", "event_type"), "order_id", "seq", asked)
    service, since = F.lit(None).cast("string"), F.lit(None).cast("timestamp_ntz")
    for k, (name, (_, answers)) in enumerate(STAGES.items()):
        service = F.when(et.isin(*answers), F.lit(name)).otherwise(service)
        since = F.when(et.isin(*answers), F.col(f"_at{k}")).otherwise(since)
    t = t.withColumn("service", service).withColumn("_since", since).where(F.col("_since") <= F.col("ts"))
    return t.select("order_id", "seq", "service", _millis(t, "ts", "_since").alias("duration_ms"))


# ---- scheduled sweeps over the state table (explicit as_of, no wall clock) ----

def find_stuck_sagas(state: DataFrame, states: list[str], cutoff) -> DataFrame:
    return state.where(F.col("state").isin(*states) & (F.col("updated_at") < F.lit(cutoff).cast("timestamp_ntz")))


def sagas_by_state(state: DataFrame, s: str) -> DataFrame:
    return state.where(F.col("state") == s)


def count_by_state(state: DataFrame) -> DataFrame:
    return state.groupBy("state").agg(F.count(F.lit(1)).alias("cnt"))


def _as_of(as_of, minutes: int) -> Column:
    return F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(minutes)} MINUTES")


def stuck_compensations(state: DataFrame, as_of, min_age_minutes: int = 5) -> tuple[DataFrame, DataFrame]:
    """COMPENSATING sagas older than the cutoff: retry_count + 1, updated_at as_of
    (so the next sweep leaves them until they are old again), and re-emitted
    commands with ``Retry compensation attempt #n``.  Returns (state, commands)."""
    stuck = state.where(
        (F.col("state") == "COMPENSATING") & (F.col("updated_at") < _as_of(as_of, min_age_minutes)))
    bumped = stuck.withColumn("retry_count", F.col("retry_count") + 1)
    reason = F.format_string(codes.REASON_RETRY, F.col("retry_count"))
    cmds = _command_rows(
        bumped.withColumnRenamed("inventory_reservation_id", "reservation_id"),
        F.lit("SHIPPING_FAILED"),  # full set: release + refund (when known) + cancel
        reason,
        ["order_id", "retry_count"],
    )
    new_state = state.join(bumped.select("order_id", F.col("retry_count").alias("_rc")), "order_id", "left")
    new_state = new_state.withColumn("updated_at", F.when(F.col("_rc").isNotNull(), F.lit(as_of).cast("timestamp_ntz")).otherwise(
        F.col("updated_at"))).withColumn("retry_count", F.coalesce(F.col("_rc"), F.col("retry_count"))).drop("_rc")
    return new_state.select(*STATE_COLUMNS), cmds


def stuck_pending(state: DataFrame, as_of, min_age_minutes: int = 10) -> tuple[DataFrame, DataFrame]:
    """*_PENDING sagas older than the cutoff fail with ``Timeout waiting for X
    response`` exactly like the matching failure event.  Returns (state, commands)."""
    stuck = state.where(
        F.col("state").isin(*codes.SAGA_PENDING_STATES) & (F.col("updated_at") < _as_of(as_of, min_age_minutes)))
    failed = case_map("state", PENDING_TO_FAILED)
    reason = F.format_string(codes.REASON_TIMEOUT, F.col("state"))
    timed = stuck.select(
        "order_id", failed.alias("_failed"), reason.alias("_reason"),
        F.col("payment_id"), F.col("inventory_reservation_id").alias("reservation_id"),
    )
    cmds = _command_rows(timed, F.col("_failed"), F.col("_reason"), ["order_id"])
    upd = timed.select("order_id", "_failed", "_reason")
    new_state = state.join(upd, "order_id", "left").select(
        "order_id",
        F.when(F.col("_failed").isNotNull(), F.lit("COMPENSATING")).otherwise(F.col("state")).alias("state"),
        F.coalesce(F.col("_failed"), F.col("failed_state")).alias("failed_state"),
        "payment_id", "inventory_reservation_id", "shipping_id", "shipping_address",
        F.coalesce(F.col("_reason"), F.col("failure_reason")).alias("failure_reason"),
        "retry_count", "created_at",
        F.when(F.col("_failed").isNotNull(), F.lit(as_of).cast("timestamp_ntz"))
        .otherwise(F.col("updated_at")).alias("updated_at"),
    )
    return new_state, cmds


def stuck_pending_feed(state: DataFrame, as_of, min_age_minutes: int = 10) -> DataFrame:
    """``order.status.update`` rows of the pending sagas that time out, as of any failure."""
    stuck = state.where(
        F.col("state").isin(*codes.SAGA_PENDING_STATES) & (F.col("updated_at") < _as_of(as_of, min_age_minutes)))
    out = stuck.select("order_id", case_map("state", PENDING_TO_FAILED).alias("status"),
                       F.format_string(codes.REASON_TIMEOUT, F.col("state")).alias("reason"))
    return out.withColumn("value", F.to_json(F.struct(
        F.col("order_id").alias("orderId"), "status", "reason"), {"ignoreNullFields": "false"}))


def enrich_shipping_address(requests: DataFrame, state: DataFrame) -> DataFrame:
    """Shipping requests get the saga's address, or the default placeholder."""
    from ..functions.columns import default_address

    addr = state.select("order_id", F.col("shipping_address").alias("_addr"))
    return requests.join(addr, "order_id", "left").withColumn(
        "address", default_address("_addr")).drop("_addr")


def saga_state(events: DataFrame) -> DataFrame:
    """``saga_instance`` rows straight from the event log in ONE aggregation.

    Transitions carry no guard on the previous state, so order matters only
    through the start gate: an order exists from its first ``OrderCreated``,
    later starts are no-ops, earlier events are ignored.  Every event before
    the first start has a smaller seq, so for each field the latest event
    that sets it either comes after the start (and counts) or the field was
    never set after the start (NULL).  All parts are ``min_by``/``max_by``
    partial aggregates, so the same plan runs as a streaming aggregation in
    update mode (state = one aggregation buffer per order) and a hot order is
    combined map-side.  Equals ``saga_current_state(saga_transitions(events))``.
    """
    et, seq = F.col("event_type"), F.col("seq")
    known = events.where(et.isin(*[e for e, _ in EVENT_STATE]))
    is_start = et == codes.SAGA_START_EVENT

    def latest(cond: Column, *fields: Column) -> Column:
        return F.max_by(F.struct(seq.alias("s"), *fields), F.when(cond, seq))

    agg = known.groupBy("order_id").agg(
        F.min(F.when(is_start, seq)).alias("_start_seq"),
        F.min_by(F.struct(F.col("ts").alias("ts"), F.col("shipping_address").alias("a")),
                 F.when(is_start, seq)).alias("_start"),
        latest(~is_start, case_map("event_type", EVENT_STATE).alias("v"), F.col("ts").alias("ts")).alias("_last"),
        latest(et.isin(*FAILURE_EVENTS), case_map("event_type", EVENT_FAILED).alias("v"),
               F.col("reason").alias("r")).alias("_fail"),
        latest(et == "PaymentCompleted", F.col("ref_id").alias("v")).alias("_pay"),
        latest(et == "InventoryReserved", F.col("ref_id").alias("v")).alias("_res"),
        latest(et == "ShippingCompleted", F.col("ref_id").alias("v")).alias("_shp"),
    ).where(F.col("_start_seq").isNotNull())

    def after(c: str) -> Column:
        return F.col(f"{c}.s") > F.col("_start_seq")

    return agg.select(
        "order_id",
        F.when(after("_last"), F.col("_last.v")).otherwise(F.lit(_start_state())).alias("state"),
        F.when(after("_fail"), F.col("_fail.v")).alias("failed_state"),
        F.when(after("_pay"), F.col("_pay.v")).alias("payment_id"),
        F.when(after("_res"), F.col("_res.v")).alias("inventory_reservation_id"),
        F.when(after("_shp"), F.col("_shp.v")).alias("shipping_id"),
        F.col("_start.a").alias("shipping_address"),
        F.when(after("_fail"), F.col("_fail.r")).alias("failure_reason"),
        F.lit(0).alias("retry_count"),
        F.col("_start.ts").alias("created_at"),
        F.when(after("_last"), F.col("_last.ts")).otherwise(F.col("_start.ts")).alias("updated_at"),
    )


def _start_state() -> str:
    return dict(EVENT_STATE)[codes.SAGA_START_EVENT]
