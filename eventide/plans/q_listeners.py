"""Queries: consumers' effects (status updates, cancel/refund/release),
result parsing, outbox feed, validation and scalar helpers (SURVEY 2.A-2.F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import envelope, fraud, listeners, saga, status_counts, tables
from ..operators.faults import canary_split
from ..sources import driver_tables as dt
from . import q_fraud, q_saga
from .registry import query
from .sql_inputs import PAYMENT_RECORDS, PAYMENT_STATUS, with_

UUID_RE = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
TERMINAL = "('COMPLETED', 'CANCELLED', 'FAILED', 'REJECTED', 'PAYMENT_FAILED', 'INVENTORY_FAILED', 'SHIPPING_FAILED')"


LOST_COMMAND = '{"orderId":"none","payload":{"reason":"lost"}}'


def _ts(spark, sf_dir):
    return q_saga._transitions(spark, sf_dir), q_saga._state(spark, sf_dir)


def _orders(state):
    return state.select(F.col("order_id").alias("id"), F.lit("NEW").alias("status"),
                        F.lit(None).cast("string").alias("review_reason"), "created_at")


def _status_msgs(t):
    return saga.saga_status_feed(t).select(F.col("order_id").alias("key"), "value", F.col("seq").alias("offset"))


def _command_records(t, topic):
    cmds = saga.compensation_plan(t).where(F.col("topic") == topic)
    env = envelope.build_envelope(
        cmds.withColumn("event_id", F.concat(F.lit("cmd-"), F.col("seq").cast("string"), F.lit("-"),
                                             F.col("cmd_order").cast("string"))),
        "order_id", "event_id", "envelope_type", "payload", out="value")
    # some commands arrive cut off, some without an order id
    value = F.when(F.col("seq") % 13 == 0, F.substring("value", 1, 20)).when(F.col("seq") % 17 == 0, F.lit(LOST_COMMAND)).otherwise(F.col("value"))
    return env.select("key", value.alias("value"), "topic", (F.col("seq") * 10 + F.col("cmd_order")).alias("offset"))


BASE = q_saga.TRANSITIONS + f""",
orders0 AS (SELECT order_id AS id, 'NEW' AS status, CAST(NULL AS VARCHAR) AS review_reason, created_at FROM state),
feed AS (
  SELECT order_id AS key, seq AS "offset", CAST(json_object('orderId', order_id, 'status', status, 'reason', reason) AS VARCHAR) AS value
  FROM (
    SELECT order_id, seq,
      CASE WHEN failed_state IS NOT NULL THEN failed_state WHEN event_type = 'ShippingCompleted' THEN 'COMPLETED'
           WHEN event_type = 'CompensationCompleted' THEN 'CANCELLED' END AS status,
      CASE WHEN failed_state IS NOT NULL THEN reason
           WHEN event_type = 'CompensationCompleted' THEN 'Order cancelled after compensation' END AS reason
    FROM transitions) WHERE status IS NOT NULL
),
carried AS (
  SELECT order_id, seq, failed_state, reason,
    (last_value(CASE WHEN event_type = 'PaymentCompleted' THEN {{'v': ref_id}} END IGNORE NULLS)
       OVER (PARTITION BY order_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)).v AS payment_id,
    (last_value(CASE WHEN event_type = 'InventoryReserved' THEN {{'v': ref_id}} END IGNORE NULLS)
       OVER (PARTITION BY order_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)).v AS reservation_id
  FROM transitions
),
cmds AS ({q_saga._commands_sql("carried", "seq")}),
cmd_records AS (
  SELECT key, topic, seq * 10 + cmd_order AS "offset",
         CAST(json_object('orderId', order_id, 'eventId', 'cmd-' || seq || '-' || cmd_order, 'type', envelope_type,
                     'payload', CAST(payload AS VARCHAR)) AS VARCHAR) AS value
  FROM cmds
),
cmd_delivered AS (
  SELECT key, topic, "offset", CASE WHEN ("offset" // 10) % 13 = 0 THEN substr(value, 1, 20)
                                    WHEN ("offset" // 10) % 17 = 0 THEN '{LOST_COMMAND}' ELSE value END AS value
  FROM cmd_records
),
cmd_body AS (SELECT *, CASE WHEN json_valid(value) THEN json_extract_string(value, '$.payload') END AS body FROM cmd_delivered),
cmd_parsed AS (
  SELECT * FROM (
    SELECT key, topic, "offset", body IS NOT NULL AS ok, json_extract_string(body, '$.orderId') AS oid,
      coalesce(json_extract_string(body, '$.reason'), 'Saga compensation') AS reason,
      json_extract_string(body, '$.paymentId') AS pay_ref, json_extract_string(body, '$.reservationId') AS res_ref,
      row_number() OVER (PARTITION BY topic, key ORDER BY "offset") AS rn
    FROM cmd_body) WHERE rn = 1
)
"""


@query("apply_status_updates", BASE + f""",
p AS (
  SELECT json_extract_string(value, '$.orderId') AS id, json_extract_string(value, '$.status') AS st,
         json_extract_string(value, '$.reason') AS rs, "offset" AS seq FROM feed
),
last AS (
  SELECT id,
    arg_max(CASE WHEN st IN ('COMPLETED', 'CANCELLED', 'PAYMENT_FAILED', 'INVENTORY_FAILED', 'SHIPPING_FAILED')
                 THEN st ELSE 'FAILED' END, seq) AS st,
    arg_max(rs, seq) FILTER (WHERE rs IS NOT NULL AND rs <> '') AS rs
  FROM p WHERE id IS NOT NULL AND st IS NOT NULL AND regexp_matches(id, '{UUID_RE}') GROUP BY id
)
SELECT o.id, coalesce(l.st, o.status) AS status, coalesce(l.rs, o.review_reason) AS review_reason, o.created_at
FROM orders0 o LEFT JOIN last l USING (id)""")
def q_apply_status_updates(spark, sf_dir):
    t, s = _ts(spark, sf_dir)
    return listeners.apply_status_updates(_orders(s), _status_msgs(t))


@query("order_status_flags", BASE + f""",
p AS (
  SELECT json_extract_string(value, '$.orderId') AS id, json_extract_string(value, '$.status') AS st,
         "offset" AS seq FROM feed
),
last AS (SELECT id, arg_max(st, seq) AS st FROM p GROUP BY id),
o AS (SELECT o.id, coalesce(l.st, o.status) AS status FROM orders0 o LEFT JOIN last l USING (id))
SELECT id, status, status = 'PENDING_REVIEW' AS requires_review, status IN {TERMINAL} AS is_terminal,
       status IN ('NEW', 'APPROVED') AS can_proceed_to_payment FROM o""")
def q_order_status_flags(spark, sf_dir):
    t, s = _ts(spark, sf_dir)
    o = listeners.apply_status_updates(_orders(s), _status_msgs(t))
    return o.select("id", "status", C.order_requires_review("status").alias("requires_review"),
                    C.order_is_terminal("status").alias("is_terminal"),
                    C.order_can_pay("status").alias("can_proceed_to_payment"))


@query("apply_cancellations", BASE + f""",
c AS (SELECT oid AS id, reason FROM cmd_parsed WHERE topic = 'order.cancel' AND regexp_matches(oid, '{UUID_RE}'))
SELECT o.id,
  CASE WHEN c.id IS NOT NULL AND o.status NOT IN {TERMINAL} THEN 'CANCELLED' ELSE o.status END AS status,
  CASE WHEN c.id IS NOT NULL AND o.status NOT IN {TERMINAL} THEN 'Cancelled: ' || c.reason ELSE o.review_reason END
    AS review_reason,
  o.created_at
FROM orders0 o LEFT JOIN c USING (id)""")
def q_apply_cancellations(spark, sf_dir):
    t, s = _ts(spark, sf_dir)
    new_orders, _ = listeners.apply_cancellations(_orders(s), _command_records(t, "order.cancel"))
    return new_orders


@query("cancellation_results", BASE + """
SELECT CASE WHEN ok THEN oid ELSE key END AS order_id, "offset" AS seq,
  CAST(json_object('orderId', CASE WHEN ok THEN oid ELSE key END, 'compensationType', 'ORDER_CANCEL', 'success', ok, 'service', 'order-api') AS VARCHAR) AS value
FROM cmd_parsed WHERE topic = 'order.cancel' AND NOT (ok AND oid IS NULL)""")
def q_cancellation_results(spark, sf_dir):
    t, s = _ts(spark, sf_dir)
    _, results = listeners.apply_cancellations(_orders(s), _command_records(t, "order.cancel"))
    return results


def _payment_status(state):
    return state.select("order_id", F.when(F.col("payment_id").isNotNull(), F.lit("CHARGED"))
                        .otherwise(F.lit("CHARGE_FAILED")).alias("status"))


@query("apply_refunds", BASE + """,
ps AS (SELECT order_id, CASE WHEN payment_id IS NOT NULL THEN 'CHARGED' ELSE 'CHARGE_FAILED' END AS status FROM state),
r AS (SELECT DISTINCT oid AS order_id FROM cmd_parsed WHERE topic = 'payment.refund')
SELECT ps.order_id, CASE WHEN r.order_id IS NOT NULL AND ps.status = 'CHARGED' THEN 'REFUNDED' ELSE ps.status END
  AS status
FROM ps LEFT JOIN r USING (order_id)""")
def q_apply_refunds(spark, sf_dir):
    t, s = _ts(spark, sf_dir)
    new_status, _ = listeners.apply_refunds(_payment_status(s), _command_records(t, "payment.refund"))
    return new_status


@query("apply_releases", BASE + """,
res AS (SELECT order_id, inventory_reservation_id AS reservation_id FROM state
        WHERE inventory_reservation_id IS NOT NULL),
rl AS (SELECT oid, "offset", res_ref FROM cmd_parsed WHERE topic = 'inventory.release' AND oid IS NOT NULL)
SELECT rl.oid AS order_id, rl."offset" AS seq, (res.reservation_id IS NOT NULL OR rl.res_ref IS NOT NULL) AS counted,
       coalesce(rl.res_ref, res.reservation_id) AS reservation_id
FROM rl LEFT JOIN res ON res.order_id = rl.oid""")
def q_apply_releases(spark, sf_dir):
    t, s = _ts(spark, sf_dir)
    res = s.where(F.col("inventory_reservation_id").isNotNull()).select(
        "order_id", F.col("inventory_reservation_id").alias("reservation_id"))
    _, released, _ = listeners.apply_releases(res, _command_records(t, "inventory.release"))
    return released


PR = with_(PAYMENT_RECORDS)
BODY = "CASE WHEN json_valid(value) THEN json_extract_string(value, '$.payload') END"


@query("payment_status_lookup", PR + f"""
SELECT order_id, arg_max(st, "offset") AS status FROM (
  SELECT json_extract_string({BODY}, '$.orderId') AS order_id, json_extract_string({BODY}, '$.status') AS st, "offset"
  FROM payment_records WHERE json_valid({BODY}))
WHERE order_id IS NOT NULL AND st IS NOT NULL GROUP BY order_id""")
def q_payment_status_lookup(spark, sf_dir):
    return listeners.payment_status_lookup(dt.payment_result_records(dt.table(spark, sf_dir, "events")))


@query("inventory_request_from_payment", PR + f"""
SELECT order_id, CAST(json_object('orderId', order_id, 'items', 1) AS VARCHAR) AS value FROM (
  SELECT json_extract_string({BODY}, '$.orderId') AS order_id, json_extract_string({BODY}, '$.status') AS st
  FROM payment_records WHERE json_valid({BODY}))
WHERE order_id IS NOT NULL AND st = 'CHARGED'""")
def q_inventory_request_from_payment(spark, sf_dir):
    req, _ = listeners.inventory_request_from_payment(dt.payment_result_records(dt.table(spark, sf_dir, "events")))
    return req


@query("order_compensation", PR + f"""
SELECT order_id, CAST(json_object('orderId', order_id, 'reason', 'PAYMENT_FAILED', 'originalStatus', st) AS VARCHAR) AS value FROM (
  SELECT json_extract_string({BODY}, '$.orderId') AS order_id, json_extract_string({BODY}, '$.status') AS st
  FROM payment_records WHERE json_valid({BODY}))
WHERE order_id IS NOT NULL AND coalesce(st, '') <> 'CHARGED'""")
def q_order_compensation(spark, sf_dir):
    _, comp = listeners.inventory_request_from_payment(dt.payment_result_records(dt.table(spark, sf_dir, "events")))
    return comp


@query("parse_payment_result", PR + f"""
SELECT key, "offset", json_extract_string(b, '$.orderId') AS order_id,
       coalesce(json_extract_string(b, '$.status'), 'UNKNOWN') AS status,
       json_extract_string(b, '$.paymentId') AS payment_id,
       coalesce(json_extract_string(b, '$.reason'), 'Payment declined') AS reason,
       upper(coalesce(json_extract_string(b, '$.status'), 'UNKNOWN')) = 'CHARGED' AS success,
       CASE WHEN b IS NULL OR NOT json_valid(b) THEN 'Failed to parse payment.result'
            WHEN json_extract_string(b, '$.orderId') IS NULL OR trim(json_extract_string(b, '$.orderId')) = ''
            THEN 'Missing orderId' END AS error_reason
FROM (SELECT key, "offset", CASE WHEN json_valid({BODY}) THEN {BODY} END AS b FROM payment_records)""")
def q_parse_payment_result(spark, sf_dir):
    p = envelope.parse_payment_result(dt.payment_result_records(dt.table(spark, sf_dir, "events")))
    return p.select("key", "offset", "order_id", "status", "payment_id", "reason", "success", "error_reason")


RESULTS = q_saga.TRANSITIONS.replace("WITH ", "WITH ", 1) + """,
rr AS (
  SELECT order_id AS key, seq AS "offset", event_type,
    CAST(json_object('orderId', order_id, 'eventId', 'ev-' || seq, 'type', event_type, 'payload', payload) AS VARCHAR) AS value,
    CASE WHEN event_type LIKE 'Inventory%' THEN 'inventory.result' ELSE 'shipping.result' END AS topic
  FROM (
    SELECT *, replace(CAST(json_object('orderId', order_id, 'status', st, 'ref', ref_id, 'reason', reason) AS VARCHAR), '"ref":',
                      CASE WHEN event_type LIKE 'Inventory%' THEN '"reservationId":' ELSE '"shippingId":' END) AS payload
    FROM (
      SELECT *, CASE WHEN event_type = 'InventoryReserved' THEN 'RESERVED'
                     WHEN event_type = 'InventoryFailed' THEN CASE WHEN seq % 2 = 0 THEN 'OUT_OF_STOCK' ELSE 'BACKORDER' END
                     WHEN event_type = 'ShippingCompleted' THEN CASE WHEN seq % 2 = 0 THEN 'DELIVERED' ELSE 'SHIPPED' END
                     WHEN event_type = 'ShippingFailed' THEN CASE WHEN seq % 2 = 0 THEN 'FAILED' ELSE 'LOST' END END AS st
      FROM saga_events) WHERE st IS NOT NULL)
)
"""


def _results(spark, sf_dir, topic):
    r = dt.result_records(q_saga._events(spark, sf_dir))
    return r.where(F.col("topic") == topic)


@query("parse_inventory_result", RESULTS + """
SELECT key, "offset", json_extract_string(value, '$.orderId') AS order_id, st AS status,
       json_extract_string(b, '$.reservationId') AS reservation_id, st = 'RESERVED' AS success,
       CASE WHEN st = 'RESERVED' THEN NULL WHEN st = 'OUT_OF_STOCK' THEN 'Inventory out of stock'
            ELSE 'Unknown inventory status: ' || st END AS reason,
       CAST(NULL AS VARCHAR) AS error_reason
FROM (SELECT *, json_extract_string(value, '$.payload') AS b,
             coalesce(json_extract_string(json_extract_string(value, '$.payload'), '$.status'), '') AS st
      FROM rr WHERE topic = 'inventory.result')""")
def q_parse_inventory_result(spark, sf_dir):
    p = envelope.parse_inventory_result(_results(spark, sf_dir, "inventory.result"))
    return p.select("key", "offset", "order_id", "status", "reservation_id", "success", "reason", "error_reason")


@query("parse_shipping_result", RESULTS + """
SELECT key, "offset", json_extract_string(value, '$.orderId') AS order_id, st AS status,
       json_extract_string(b, '$.shippingId') AS shipping_id, st IN ('DELIVERED', 'SHIPPED') AS success,
       CASE WHEN st IN ('DELIVERED', 'SHIPPED') THEN NULL
            WHEN st = 'FAILED' THEN coalesce(json_extract_string(b, '$.reason'), 'Shipping failed')
            ELSE 'Unknown shipping status: ' || st END AS reason,
       CAST(NULL AS VARCHAR) AS error_reason
FROM (SELECT *, json_extract_string(value, '$.payload') AS b,
             coalesce(json_extract_string(json_extract_string(value, '$.payload'), '$.status'), '') AS st
      FROM rr WHERE topic = 'shipping.result')""")
def q_parse_shipping_result(spark, sf_dir):
    p = envelope.parse_shipping_result(_results(spark, sf_dir, "shipping.result"))
    return p.select("key", "offset", "order_id", "status", "shipping_id", "success", "reason", "error_reason")


@query("saga_state_attrs", q_saga.TRANSITIONS + """
SELECT order_id, state,
  CASE state WHEN 'STARTED' THEN 'INITIAL' WHEN 'COMPLETED' THEN 'TERMINAL' WHEN 'COMPENSATED' THEN 'TERMINAL'
    WHEN 'COMPENSATING' THEN 'COMPENSATING' ELSE split_part(state, '_', 1) END AS phase,
  state IN ('PAYMENT_FAILED', 'INVENTORY_FAILED', 'SHIPPING_FAILED') AS is_failure,
  state IN ('COMPLETED', 'COMPENSATED') AS is_terminal,
  state = 'COMPENSATING' AS is_compensating,
  CASE failed_state WHEN 'PAYMENT_FAILED' THEN 'CANCEL_ORDER_ONLY' WHEN 'INVENTORY_FAILED' THEN 'REFUND_AND_CANCEL'
    WHEN 'SHIPPING_FAILED' THEN 'FULL_COMPENSATION' ELSE 'NONE' END AS strategy
FROM state""")
def q_saga_state_attrs(spark, sf_dir):
    _, s = _ts(spark, sf_dir)
    return s.select("order_id", "state", C.saga_phase("state").alias("phase"),
                    C.saga_is_failure("state").alias("is_failure"), C.saga_is_terminal("state").alias("is_terminal"),
                    C.saga_is_compensating("state").alias("is_compensating"),
                    C.saga_strategy("failed_state").alias("strategy"))


@query("upsert_saga_state", q_saga.TRANSITIONS + """,
early AS (SELECT * FROM state),
upd AS (
  SELECT order_id, 'COMPENSATED' AS state, failed_state, payment_id, inventory_reservation_id, shipping_id,
         shipping_address, failure_reason, retry_count + 1 AS retry_count, created_at,
         updated_at + INTERVAL 1 HOUR AS updated_at
  FROM state WHERE state = 'COMPENSATING'
)
SELECT * FROM early WHERE order_id NOT IN (SELECT order_id FROM upd)
UNION ALL SELECT * FROM upd""")
def q_upsert_saga_state(spark, sf_dir):
    _, s = _ts(spark, sf_dir)
    upd = s.where(F.col("state") == "COMPENSATING").withColumn("state", F.lit("COMPENSATED")).withColumn(
        "retry_count", F.col("retry_count") + 1).withColumn("updated_at", F.col("updated_at") + F.expr(
            "INTERVAL 1 HOUR"))
    return tables.upsert_table(s, upd, ["order_id"], ["updated_at"])


def _outbox(spark, sf_dir):
    _, outbox = fraud.order_admission(fraud.fraud_score(q_fraud._orders(spark, sf_dir), window_minutes=1440))
    return outbox


OUTBOX = q_fraud._score_sql(1440) + """,
outbox AS (
  SELECT md5(order_id || ':OrderCreated:' || CAST(epoch_us(created_at) AS VARCHAR)) AS id, order_id AS aggregate_id,
         '{"orderId":"' || order_id || '","total":' || CAST(CAST(total AS DOUBLE) AS VARCHAR)
           || ',"currency":"USD","customerId":"' || customer_id || '","shippingAddress":null}' AS payload,
         created_at AS occurred_at
  FROM scored WHERE action = 'APPROVE'
)
"""


@query("outbox_change_feed", OUTBOX + """
SELECT aggregate_id AS key, payload AS value, 'order.created' AS topic, occurred_at AS "timestamp" FROM outbox""")
def q_outbox_change_feed(spark, sf_dir):
    return tables.outbox_change_feed(_outbox(spark, sf_dir)).drop("headers")


@query("parse_order_created", OUTBOX + """
SELECT aggregate_id AS key, json_extract_string(payload, '$.orderId') AS order_id,
       coalesce(TRY_CAST(json_extract_string(payload, '$.total') AS DOUBLE), 0.0) AS total,
       coalesce(json_extract_string(payload, '$.currency'), 'USD') AS currency,
       coalesce(json_extract_string(payload, '$.customerId'), 'N/A') AS customer_id,
       json_extract_string(payload, '$.shippingAddress') AS shipping_address,
       CAST(NULL AS VARCHAR) AS error_reason
FROM outbox""")
def q_parse_order_created(spark, sf_dir):
    feed = tables.outbox_change_feed(_outbox(spark, sf_dir))
    p = envelope.parse_order_created(feed)
    return p.select("key", "order_id", "total", "currency", "customer_id", "shipping_address", "error_reason")


@query("build_payment_request", OUTBOX + """,
req AS (
  SELECT json_extract_string(payload, '$.orderId') AS order_id,
         coalesce(TRY_CAST(json_extract_string(payload, '$.total') AS DOUBLE), 0.0) AS total,
         coalesce(json_extract_string(payload, '$.currency'), 'USD') AS currency
  FROM outbox
)
SELECT order_id,
  CASE WHEN CAST(('0x' || substr(md5(order_id), 1, 8)) AS BIGINT) % 10000 < 500 THEN 'canary' ELSE 'main' END AS channel,
  CAST(json_object('orderId', order_id, 'amount', total, 'currency', currency) AS VARCHAR) AS payment_request
FROM req""")
def q_build_payment_request(spark, sf_dir):
    p = envelope.parse_order_created(tables.outbox_change_feed(_outbox(spark, sf_dir)))
    r = envelope.build_payment_request(p)
    return canary_split(r, 0.05, "order_id").select("order_id", "payment_request", "channel")


@query("validate_create_order", q_fraud._score_sql(60) + """
SELECT order_id, CASE WHEN total IS NULL OR total < 0.01 THEN 'total must be >= 0.01' END AS error_reason
FROM fraud_orders""")
def q_validate_create_order(spark, sf_dir):
    o = q_fraud._orders(spark, sf_dir).withColumn("currency", F.lit("USD"))
    return envelope.validate_create_order(o).select("order_id", "error_reason")


@query("money_scale", """
SELECT l_orderkey, l_linenumber,
  CAST(round(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(12,2)) AS discount_amount
FROM lineitem""")
def q_money_scale(spark, sf_dir):
    li = dt.table(spark, sf_dir, "lineitem")
    amt = li["l_extendedprice"].cast("decimal(15,2)") * li["l_discount"].cast("decimal(4,2)")
    return li.select("l_orderkey", "l_linenumber", C.money(amt).alias("discount_amount"))


@query("query_window_store", PR + f"""
SELECT * FROM (
  SELECT time_bucket(INTERVAL '1 hour', "timestamp") AS window_start,
         time_bucket(INTERVAL '1 hour', "timestamp") + INTERVAL '1 hour' AS window_end,
         {PAYMENT_STATUS} AS status, count(*) AS cnt
  FROM payment_records GROUP BY 1, 2, 3)
WHERE status = 'CHARGED' AND window_start BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 00:00:00'""")
def q_query_window_store(spark, sf_dir):
    start, end = "2024-01-10 00:00:00", "2024-01-12 00:00:00"
    records = status_counts.records_of_windows(dt.payment_result_records(dt.table(spark, sf_dir, "events")), "1 hour", start, end)
    return status_counts.query_window_store(status_counts.status_count_window(records, "1 hour"), "CHARGED", start, end)


@query("burn_rate_current", PR + f""",
counts AS (
  SELECT time_bucket(INTERVAL '6 hours', "timestamp") AS window_start,
         time_bucket(INTERVAL '6 hours', "timestamp") + INTERVAL '6 hours' AS window_end,
         {PAYMENT_STATUS} AS status, count(*) AS cnt
  FROM payment_records GROUP BY 1, 2, 3
)
SELECT window_start, window_end,
  CAST(coalesce(sum(cnt) FILTER (WHERE status = 'CHARGED'), 0) AS BIGINT) AS charged,
  CAST(coalesce(sum(cnt) FILTER (WHERE status = 'CHARGE_FAILED'), 0) AS BIGINT) AS charge_failed,
  CAST(CASE WHEN coalesce(sum(cnt) FILTER (WHERE status IN ('CHARGED', 'CHARGE_FAILED')), 0) = 0 THEN 0
       ELSE coalesce(sum(cnt) FILTER (WHERE status = 'CHARGE_FAILED'), 0) * 100
            // sum(cnt) FILTER (WHERE status IN ('CHARGED', 'CHARGE_FAILED')) END AS BIGINT) AS burn_rate
FROM counts WHERE window_start <= TIMESTAMP '2024-01-15 12:34:00' AND TIMESTAMP '2024-01-15 12:34:00' < window_end
GROUP BY 1, 2""")
def q_burn_rate_current(spark, sf_dir):
    as_of = "2024-01-15 12:34:00"
    records = status_counts.records_of_windows(dt.payment_result_records(dt.table(spark, sf_dir, "events")), "6 hours", as_of, as_of)
    return status_counts.burn_rate_at(status_counts.status_count_window(records, "6 hours"), as_of)
