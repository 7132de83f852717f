"""Queries: saga state machine, compensation, sweeps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import saga
from ..sources import driver_tables as dt
from .registry import query
from .sql_inputs import SAGA_EVENTS, with_

AS_OF = "2024-01-31 00:00:00"


def _events(spark, sf_dir):
    return dt.saga_events(dt.table(spark, sf_dir, "events"))


def _transitions(spark, sf_dir):
    return saga.saga_transitions(_events(spark, sf_dir))


def _state(spark, sf_dir):
    return saga.saga_state(_events(spark, sf_dir))


TRANSITIONS = with_(SAGA_EVENTS) + """,
known AS (
  SELECT * FROM saga_events WHERE event_type IN ('OrderCreated', 'PaymentCompleted', 'PaymentFailed',
    'InventoryRequested', 'InventoryReserved', 'InventoryFailed', 'ShippingRequested', 'ShippingCompleted',
    'ShippingFailed', 'CompensationCompleted')
),
starts AS (
  SELECT order_id, min(seq) AS start_seq FROM known WHERE event_type = 'OrderCreated' GROUP BY order_id
),
st AS (
  SELECT s.order_id, s.start_seq, k.ts AS created_at, k.shipping_address AS saga_address
  FROM starts s JOIN known k ON k.order_id = s.order_id AND k.seq = s.start_seq
),
transitions AS (
  SELECT k.order_id, k.seq, k.ts, k.event_type,
    CASE k.event_type WHEN 'OrderCreated' THEN 'PAYMENT_PENDING' WHEN 'PaymentCompleted' THEN 'PAYMENT_COMPLETED'
      WHEN 'PaymentFailed' THEN 'COMPENSATING' WHEN 'InventoryRequested' THEN 'INVENTORY_PENDING'
      WHEN 'InventoryReserved' THEN 'INVENTORY_RESERVED' WHEN 'InventoryFailed' THEN 'COMPENSATING'
      WHEN 'ShippingRequested' THEN 'SHIPPING_PENDING' WHEN 'ShippingCompleted' THEN 'COMPLETED'
      WHEN 'ShippingFailed' THEN 'COMPENSATING' WHEN 'CompensationCompleted' THEN 'COMPENSATED' END AS state,
    CASE k.event_type WHEN 'PaymentFailed' THEN 'PAYMENT_FAILED' WHEN 'InventoryFailed' THEN 'INVENTORY_FAILED'
      WHEN 'ShippingFailed' THEN 'SHIPPING_FAILED' END AS failed_state,
    k.ref_id, k.reason, st.created_at, st.saga_address
  FROM known k JOIN st USING (order_id)
  WHERE k.seq = st.start_seq OR (k.seq > st.start_seq AND k.event_type <> 'OrderCreated')
),
state AS (
  SELECT order_id, arg_max(state, seq) AS state,
    arg_max_null(failed_state, seq) FILTER (WHERE event_type IN ('PaymentFailed', 'InventoryFailed', 'ShippingFailed')) AS failed_state,
    arg_max_null(ref_id, seq) FILTER (WHERE event_type = 'PaymentCompleted') AS payment_id,
    arg_max_null(ref_id, seq) FILTER (WHERE event_type = 'InventoryReserved') AS inventory_reservation_id,
    arg_max_null(ref_id, seq) FILTER (WHERE event_type = 'ShippingCompleted') AS shipping_id,
    max(saga_address) AS shipping_address,
    arg_max_null(reason, seq) FILTER (WHERE event_type IN ('PaymentFailed', 'InventoryFailed', 'ShippingFailed')) AS failure_reason,
    0 AS retry_count, min(created_at) AS created_at, arg_max(ts, seq) AS updated_at
  FROM transitions GROUP BY order_id
)
"""

# compensation command rows from a relation with order_id, <keep>, failed_state,
# payment_id, reservation_id, reason
def _commands_sql(src: str, keep: str) -> str:
    def one(order, topic, ctype, etype, ref, cond, payload):
        return f"""SELECT order_id, {keep}, {order} AS cmd_order, '{topic}' AS topic, order_id AS key,
  '{ctype}' AS compensation_type, '{etype}' AS envelope_type, {ref} AS ref_id, reason, {payload} AS payload
FROM {src} WHERE {cond}"""
    return "\nUNION ALL\n".join([
        one(1, "inventory.release", "RELEASE", "InventoryReleaseRequested", "reservation_id",
            "failed_state = 'SHIPPING_FAILED' AND reservation_id IS NOT NULL",
            "CAST(json_object('orderId', order_id, 'reservationId', reservation_id, 'reason', reason, 'compensationType', 'RELEASE') AS VARCHAR)"),
        one(2, "payment.refund", "REFUND", "PaymentRefundRequested", "payment_id",
            "failed_state IN ('INVENTORY_FAILED', 'SHIPPING_FAILED') AND payment_id IS NOT NULL",
            "CAST(json_object('orderId', order_id, 'paymentId', payment_id, 'reason', reason, 'compensationType', 'REFUND') AS VARCHAR)"),
        one(3, "order.cancel", "CANCEL", "OrderCancellationRequested", "CAST(NULL AS VARCHAR)",
            "failed_state IS NOT NULL",
            "CAST(json_object('orderId', order_id, 'reason', reason, 'compensationType', 'CANCEL') AS VARCHAR)"),
    ])


@query("saga_transitions", TRANSITIONS + "SELECT * FROM transitions")
def q_saga_transitions(spark, sf_dir):
    return _transitions(spark, sf_dir)


@query("saga_current_state", TRANSITIONS + "SELECT * FROM state")
def q_saga_current_state(spark, sf_dir):
    return _state(spark, sf_dir)


@query("compensation_plan", TRANSITIONS + """,
carried AS (
  SELECT order_id, seq, failed_state, reason,
    (last_value(CASE WHEN event_type = 'PaymentCompleted' THEN {'v': ref_id} END IGNORE NULLS)
       OVER (PARTITION BY order_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)).v AS payment_id,
    (last_value(CASE WHEN event_type = 'InventoryReserved' THEN {'v': ref_id} END IGNORE NULLS)
       OVER (PARTITION BY order_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)).v AS reservation_id
  FROM transitions
)
""" + _commands_sql("carried", "seq"))
def q_compensation_plan(spark, sf_dir):
    return saga.compensation_plan(_transitions(spark, sf_dir))


@query("saga_status_feed", TRANSITIONS + """
SELECT order_id, seq, status, reason,
       CAST(json_object('orderId', order_id, 'status', status, 'reason', reason) AS VARCHAR) AS value
FROM (
  SELECT order_id, seq,
    CASE WHEN failed_state IS NOT NULL THEN failed_state WHEN event_type = 'ShippingCompleted' THEN 'COMPLETED'
         WHEN event_type = 'CompensationCompleted' THEN 'CANCELLED' END AS status,
    CASE WHEN failed_state IS NOT NULL THEN reason
         WHEN event_type = 'CompensationCompleted' THEN 'Order cancelled after compensation' END AS reason
  FROM transitions) WHERE status IS NOT NULL""")
def q_saga_status_feed(spark, sf_dir):
    return saga.saga_status_feed(_transitions(spark, sf_dir))


COUNTERS_SQL = """
SELECT count(*) FILTER (WHERE event_type = 'OrderCreated') AS started,
       count(*) FILTER (WHERE failed_state IS NOT NULL) AS failed,
       count(*) FILTER (WHERE failed_state IS NOT NULL) AS compensations_triggered,
       count(*) FILTER (WHERE event_type = 'CompensationCompleted') AS compensations_completed,
       count(*) FILTER (WHERE event_type = 'ShippingCompleted') AS succeeded
FROM transitions"""


@query("saga_counters", TRANSITIONS + COUNTERS_SQL)
def q_saga_counters(spark, sf_dir):
    return saga.saga_counters(_transitions(spark, sf_dir))


@query("burn_rate_cumulative", TRANSITIONS + f"""
SELECT started, failed, CASE WHEN started > 0 THEN CAST(trunc(100.0 * failed / started) AS BIGINT) END AS burn_rate
FROM ({COUNTERS_SQL})""")
def q_burn_rate_cumulative(spark, sf_dir):
    return saga.burn_rate_cumulative(_transitions(spark, sf_dir))


@query("count_by_status_sagas", TRANSITIONS + "SELECT state, count(*) AS cnt FROM state GROUP BY state")
def q_count_by_status_sagas(spark, sf_dir):
    return saga.count_by_state(_state(spark, sf_dir))


@query("sagas_by_state", TRANSITIONS + "SELECT * FROM state WHERE state = 'COMPENSATING'")
def q_sagas_by_state(spark, sf_dir):
    return saga.sagas_by_state(_state(spark, sf_dir), "COMPENSATING")


@query("find_stuck_sagas", TRANSITIONS + """
SELECT * FROM state WHERE state IN ('PAYMENT_PENDING', 'INVENTORY_PENDING', 'SHIPPING_PENDING')
  AND updated_at < TIMESTAMP '2024-01-15 00:00:00'""")
def q_find_stuck_sagas(spark, sf_dir):
    return saga.find_stuck_sagas(_state(spark, sf_dir), ["PAYMENT_PENDING", "INVENTORY_PENDING", "SHIPPING_PENDING"],
                                 "2024-01-15 00:00:00")


@query("stuck_compensations", TRANSITIONS + f""",
stuck AS (
  SELECT order_id, retry_count + 1 AS retry_count, payment_id, inventory_reservation_id AS reservation_id,
         'SHIPPING_FAILED' AS failed_state, 'Retry compensation attempt #' || (retry_count + 1) AS reason
  FROM state WHERE state = 'COMPENSATING' AND updated_at < TIMESTAMP '{AS_OF}' - INTERVAL 5 MINUTE
)
""" + _commands_sql("stuck", "retry_count"))
def q_stuck_compensations(spark, sf_dir):
    _, cmds = saga.stuck_compensations(_state(spark, sf_dir), AS_OF)
    return cmds


@query("stuck_pending", TRANSITIONS + f""",
timed AS (
  SELECT order_id, payment_id, inventory_reservation_id AS reservation_id,
    CASE state WHEN 'PAYMENT_PENDING' THEN 'PAYMENT_FAILED' WHEN 'INVENTORY_PENDING' THEN 'INVENTORY_FAILED'
               ELSE 'SHIPPING_FAILED' END AS failed_state,
    'Timeout waiting for ' || state || ' response' AS reason
  FROM state WHERE state IN ('PAYMENT_PENDING', 'INVENTORY_PENDING', 'SHIPPING_PENDING')
    AND updated_at < TIMESTAMP '{AS_OF}' - INTERVAL 10 MINUTE
)
SELECT s.order_id,
  CASE WHEN t.failed_state IS NOT NULL THEN 'COMPENSATING' ELSE s.state END AS state,
  coalesce(t.failed_state, s.failed_state) AS failed_state,
  s.payment_id, s.inventory_reservation_id, s.shipping_id, s.shipping_address,
  coalesce(t.reason, s.failure_reason) AS failure_reason, s.retry_count, s.created_at,
  CASE WHEN t.failed_state IS NOT NULL THEN TIMESTAMP '{AS_OF}' ELSE s.updated_at END AS updated_at
FROM state s LEFT JOIN timed t USING (order_id)""")
def q_stuck_pending(spark, sf_dir):
    new_state, _ = saga.stuck_pending(_state(spark, sf_dir), AS_OF)
    return new_state


@query("stuck_pending_commands", TRANSITIONS + f""",
timed AS (
  SELECT order_id, payment_id, inventory_reservation_id AS reservation_id,
    CASE state WHEN 'PAYMENT_PENDING' THEN 'PAYMENT_FAILED' WHEN 'INVENTORY_PENDING' THEN 'INVENTORY_FAILED'
               ELSE 'SHIPPING_FAILED' END AS failed_state,
    'Timeout waiting for ' || state || ' response' AS reason, 0 AS dummy
  FROM state WHERE state IN ('PAYMENT_PENDING', 'INVENTORY_PENDING', 'SHIPPING_PENDING')
    AND updated_at < TIMESTAMP '{AS_OF}' - INTERVAL 10 MINUTE
)
SELECT * EXCLUDE (dummy) FROM (""" + _commands_sql("timed", "dummy") + ")")
def q_stuck_pending_commands(spark, sf_dir):
    _, cmds = saga.stuck_pending(_state(spark, sf_dir), AS_OF)
    return cmds


@query("processing_time_stats", TRANSITIONS + """
SELECT count(*) AS completed, round(avg(d), 3) AS avg_ms, min(d) AS min_ms, max(d) AS max_ms
FROM (SELECT CAST(epoch_us(ts) - epoch_us(created_at) AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS d
      FROM transitions WHERE event_type = 'ShippingCompleted')""")
def q_processing_time_stats(spark, sf_dir):
    d = saga.processing_durations(_transitions(spark, sf_dir))
    return d.agg(
        F.count(F.lit(1)).alias("completed"),
        F.round(F.avg("duration_ms"), 3).alias("avg_ms"),
        F.min("duration_ms").alias("min_ms"),
        F.max("duration_ms").alias("max_ms"),
    )


@query("enrich_shipping_address", TRANSITIONS + """
SELECT t.order_id, t.seq,
       coalesce(CASE WHEN trim(s.shipping_address) <> '' THEN s.shipping_address END,
                'Default Address - Please Update') AS address
FROM transitions t LEFT JOIN state s USING (order_id) WHERE t.event_type = 'ShippingRequested'""")
def q_enrich_shipping_address(spark, sf_dir):
    t = _transitions(spark, sf_dir)
    req = t.where(F.col("event_type") == "ShippingRequested").select("order_id", "seq")
    return saga.enrich_shipping_address(req, saga.saga_current_state(t)).select("order_id", "seq", "address")
