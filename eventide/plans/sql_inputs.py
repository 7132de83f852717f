"""SQL (DuckDB dialect) versions of the stand-in inputs of
``sources.driver_tables``, used as CTEs by the oracle queries."""


def uuid(expr: str) -> str:
    """8-4-4-4-12 formatting of md5(expr), as ``functions.columns.uuid_from``."""
    h = f"md5(CAST({expr} AS VARCHAR))"
    return (f"concat_ws('-', substr({h}, 1, 8), substr({h}, 9, 4), substr({h}, 13, 4), "
            f"substr({h}, 17, 4), substr({h}, 21, 12))")


PAYMENT_RECORDS = """
pr_base AS (
  SELECT event_id, user_id, ts,
         '{"orderId":"ord-' || event_id || '","paymentId":"pay-' || event_id || '"'
           || coalesce(',"status":"' || CASE event_type WHEN 'purchase' THEN 'CHARGED'
                                                        WHEN 'error' THEN 'CHARGE_FAILED' END || '"', '')
           || ',"amount":' || CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) || '}' AS payload,
         '{"orderId":"ord-' || event_id || '","eventId":"ev-' || event_id
           || '","type":"PaymentResult","payload":' AS head
  FROM events
),
pr_full AS (
  SELECT *, CASE WHEN event_id % 2 = 0 THEN head || '"' || replace(payload, '"', '\\"') || '"}'
                 ELSE head || payload || '}' END AS v0
  FROM pr_base
),
payment_records AS (
  SELECT 'ord-' || event_id AS key,
         CASE WHEN event_id % 50 = 7 THEN substr(v0, 1, CAST(floor(length(v0) / 2) AS INTEGER)) ELSE v0 END AS value,
         'payment.result' AS topic,
         CAST(user_id % 3 AS INTEGER) AS "partition",
         event_id AS "offset",
         ts AS "timestamp"
  FROM pr_full
)"""

# payment status of an envelope: payload.status, payload as text or object
PAYMENT_STATUS = """CASE WHEN json_valid(value) AND json_valid(json_extract_string(value, '$.payload'))
     THEN coalesce(json_extract_string(json_extract_string(value, '$.payload'), '$.status'), 'UNKNOWN')
     ELSE 'UNKNOWN' END"""

FRAUD_ORDERS = """
fraud_orders AS (
  SELECT CAST(event_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS customer_id,
         ts AS created_at, CAST(CAST(value AS DECIMAL(12,2)) * 50 AS DECIMAL(12,2)) AS total
  FROM events
)"""

SAGA_EVENTS = f"""
saga_events AS (
  SELECT {uuid("'ord-' || user_id || '-' || strftime(ts, '%Y%m%d')")} AS order_id,
         event_id AS seq, ts,
         CASE event_type
           WHEN 'signup' THEN 'OrderCreated'
           WHEN 'click' THEN 'PaymentCompleted'
           WHEN 'view' THEN CASE WHEN event_id % 2 = 0 THEN 'InventoryReserved' ELSE 'InventoryRequested' END
           WHEN 'purchase' THEN CASE WHEN event_id % 2 = 0 THEN 'ShippingCompleted' WHEN event_id % 5 = 1 THEN 'CompensationCompleted' ELSE 'ShippingRequested' END
           WHEN 'error' THEN CASE event_id % 3 WHEN 0 THEN 'PaymentFailed' WHEN 1 THEN 'InventoryFailed'
                                               ELSE 'ShippingFailed' END
         END AS event_type,
         CASE WHEN event_type = 'click' THEN 'pay-' || event_id
              WHEN event_type = 'view' AND event_id % 2 = 0 THEN 'res-' || event_id
              WHEN event_type = 'purchase' AND event_id % 2 = 0 THEN 'shp-' || event_id END AS ref_id,
         CASE WHEN event_type = 'error' THEN 'declined ' || props END AS reason,
         CASE WHEN event_type = 'signup' AND value >= 5 THEN 'Street ' || user_id END AS shipping_address
  FROM events
)"""

TOPIC_RECORDS = """
topic_records AS (
  SELECT 'ord-' || user_id AS key,
         '{"orderId":"ord-' || user_id || '","eventId":"ev-' || event_id || '","type":"' || event_type
           || '","payload":' || props || '}' AS value,
         CASE event_type WHEN 'signup' THEN 'order.created' WHEN 'click' THEN 'payment.requested'
                         WHEN 'view' THEN 'inventory.requested' WHEN 'purchase' THEN 'payment.result'
              ELSE CASE event_id % 4 WHEN 0 THEN 'order.created.dlt' WHEN 1 THEN 'payment.requested-dlt'
                                     WHEN 2 THEN 'inventory.requested.DLT' ELSE 'shipping.requested-DLT' END
         END AS topic,
         CAST(user_id % 3 AS INTEGER) AS "partition",
         event_id AS "offset",
         ts AS "timestamp",
         CASE WHEN event_type = 'error' THEN
           CASE WHEN value < 50 THEN 'Envelope parse failed'
                WHEN value < 150 THEN 'Timeout waiting for response'
                ELSE 'Payment declined' END END AS exception_message
  FROM events
)"""

LATENCY_SAMPLES = """
latency_samples AS (
  SELECT l_returnflag AS service, l_linestatus AS channel, l_extendedprice / 50.0 AS latency_ms
  FROM lineitem
)"""

COUNTER_SAMPLES = """
cs_min AS (
  SELECT 'events_' || event_type || '_total' AS metric, 'app-' || (user_id % 3) AS app,
         date_trunc('minute', ts) AS ts, count(*) AS n
  FROM events GROUP BY 1, 2, 3
),
counter_samples AS (
  SELECT ts, metric, app,
         CAST(sum(n) OVER (PARTITION BY metric, app, CAST(ts AS DATE) ORDER BY ts
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS value
  FROM cs_min
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"

ORDER_TABLE = """
order_table AS (
  SELECT o_orderkey AS id, o_custkey AS customer_id, o_orderstatus AS status, o_totalprice AS total,
         o_orderdate AS created_at
  FROM orders
)"""


def unit_draw(expr: str, salt: str) -> str:
    """Same as ``functions.columns.unit_draw``: md5 -> 32 bits -> [0, 1)."""
    return (f"CAST(('0x' || substr(md5(CAST({expr} AS VARCHAR) || '{salt}'), 1, 8)) AS BIGINT)"
            f" / CAST(4294967296.0 AS DOUBLE)")

# faulted topic records: the rules below are fault-injection configuration
FAULT_RULES = [
    ("topic:payment.requested", 0.05, 0.10, 2000, 0.03),
    ("topic:order.created", 0.0, 0.25, 0, 0.0),
    ("type:view", 0.02, 0.05, 500, 0.05),
]


def faulted_records(seed: int = 42) -> str:
    rules = " UNION ALL ".join(
        f"SELECT '{k}' AS key, CAST({a} AS DOUBLE) AS p_drop, CAST({b} AS DOUBLE) AS p_dup, "
        f"CAST({c} AS INTEGER) AS max_delay_ms, CAST({d} AS DOUBLE) AS p_corrupt"
        for k, a, b, c, d in FAULT_RULES)
    rid = f"'{seed}/' || topic || '/' || \"partition\" || '/' || \"offset\""
    return f"""
fault_rules AS ({rules}),
fr_rule AS (
  SELECT t.*, coalesce(rt.p_drop, ry.p_drop, 0.0) AS p_drop, coalesce(rt.p_dup, ry.p_dup, 0.0) AS p_dup,
         coalesce(rt.max_delay_ms, ry.max_delay_ms, 0) AS max_delay_ms,
         coalesce(rt.p_corrupt, ry.p_corrupt, 0.0) AS p_corrupt
  FROM topic_records t
  LEFT JOIN fault_rules rt ON rt.key = 'topic:' || t.topic
  LEFT JOIN fault_rules ry ON ry.key = 'type:' || json_extract_string(t.value, '$.type')
),
fr_draw AS (
  SELECT *, {unit_draw(rid, ':drop')} AS u_drop, {unit_draw(rid, ':dup')} AS u_dup,
            {unit_draw(rid, ':corrupt')} AS u_cor, {unit_draw(rid, ':delay')} AS u_delay
  FROM fr_rule
),
faulted AS (
  SELECT key,
         CASE WHEN u_cor < p_corrupt THEN substr(value, 1, CAST(greatest(1, floor(length(value) / 2)) AS INTEGER))
              ELSE value END AS value,
         topic, "partition", "offset",
         "timestamp" + to_microseconds(CAST(floor(u_delay * (max_delay_ms + 1)) AS BIGINT) * 1000) AS "timestamp",
         u_cor < p_corrupt AS corrupted,
         CAST(c.copy AS INTEGER) AS copy
  FROM fr_draw, LATERAL (SELECT unnest(generate_series(1, CASE WHEN u_dup < p_dup THEN 2 ELSE 1 END)) AS copy) c
  WHERE NOT (u_drop < p_drop)
)"""

MIXED_MESSAGES = """
mixed_ids AS (
  SELECT event_id, event_type, user_id, value AS v, CASE event_id % 16 WHEN 1 THEN '"not-a-uuid"' WHEN 2 THEN '" \\t"' WHEN 3 THEN 'null'
    ELSE '"' || substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) || '"' END AS oid
  FROM (SELECT *, md5(CAST(event_id AS VARCHAR)) AS h FROM events)
),
mixed_bodies AS (
  SELECT event_id, oid, '{"orderId":' || oid || ',"status":' || CASE event_id % 10 WHEN 0 THEN '"RESERVED"' WHEN 1 THEN '"OUT_OF_STOCK"' WHEN 2 THEN '"BACKORDER"' WHEN 3 THEN '"DELIVERED"' WHEN 4 THEN '"FAILED"' WHEN 5 THEN '"COMPLETED"' WHEN 6 THEN '"PAYMENT_FAILED"' WHEN 8 THEN '"CHARGED"' WHEN 9 THEN '"charged"' ELSE 'null' END || ',"paymentId":' || CASE event_id % 4 WHEN 0 THEN '"pay-' || user_id || '"' ELSE 'null' END || ',"items":' || CASE event_id % 5 WHEN 0 THEN '0' WHEN 1 THEN '3' WHEN 2 THEN '-1' WHEN 3 THEN '"x"' ELSE 'null' END
    || ',"address":' || CASE event_id % 4 WHEN 0 THEN '"12 Main St"' WHEN 1 THEN '"UNKNOWN"' WHEN 2 THEN '"  "' ELSE 'null' END || ',"reason":' || CASE event_id % 3 WHEN 0 THEN '"' || event_type || '"' ELSE 'null' END
    || ',"total":' || CASE event_id % 6 WHEN 0 THEN CAST(CAST(v AS DECIMAL(12,2)) AS VARCHAR) WHEN 1 THEN '0' WHEN 2 THEN '"abc"' WHEN 3 THEN '0.01' WHEN 5 THEN '-3' ELSE 'null' END || ',"currency":' || CASE event_id % 3 WHEN 0 THEN '"EUR"' WHEN 1 THEN '" "' ELSE 'null' END
    || ',"customerId":' || CASE event_id % 3 WHEN 0 THEN '"c-' || user_id || '"' WHEN 1 THEN '""' ELSE 'null' END || '}' AS body
  FROM mixed_ids
),
mixed_messages AS (
  SELECT event_id AS "offset", CASE WHEN event_id % 13 = 4 THEN substr(body, 1, 20)
    WHEN event_id % 13 = 5 THEN '{"orderId":' || oid || ',"payload":"{oops"}'
    WHEN event_id % 13 < 8 THEN body
    WHEN event_id % 13 < 10 THEN '{"orderId":' || oid || ',"payload":' || body || '}'
    ELSE '{"orderId":' || oid || ',"payload":"' || replace(replace(body, '\\', '\\\\'), '"', '\\"') || '"}' END AS value
  FROM mixed_bodies
)"""
