"""Queries: fraud scoring, admission, counters."""

from __future__ import annotations

from ..operators import fraud
from ..sources import driver_tables as dt
from .registry import query
from .sql_inputs import FRAUD_ORDERS, with_


def _orders(spark, sf_dir):
    return dt.fraud_orders(dt.table(spark, sf_dir, "events"))


def _score_sql(minutes: int) -> str:
    return with_(FRAUD_ORDERS) + f""",
v AS (
  SELECT o.*, CASE WHEN o.customer_id IS NULL THEN 0 ELSE (
      SELECT count(*) FROM fraud_orders p
      WHERE p.customer_id = o.customer_id
        AND p.created_at > o.created_at - INTERVAL {minutes} MINUTE
        AND (p.created_at < o.created_at OR (p.created_at = o.created_at AND p.order_id < o.order_id))
    ) END AS velocity_count
  FROM fraud_orders o
),
s AS (
  SELECT *,
    CASE WHEN total > 1000 THEN CASE WHEN total >= 5000 THEN 50 WHEN total >= 2000 THEN 35 ELSE 20 END
         ELSE 0 END AS value_score,
    CASE WHEN customer_id IS NULL THEN 0 WHEN velocity_count >= 5 THEN 40
         WHEN velocity_count >= 2 THEN 20 ELSE 0 END AS velocity_score,
    CASE WHEN total % 100 IN (0, 50) THEN 15 ELSE 0 END AS round_score,
    CASE WHEN hour(created_at) BETWEEN 1 AND 5 THEN 10 ELSE 0 END AS off_hours_score
  FROM v
),
f AS (
  SELECT *, CAST(least(value_score + velocity_score + round_score + off_hours_score, 100) AS DECIMAL(5,2)) AS fraud_score,
    concat_ws('; ',
      CASE WHEN total > 1000 THEN printf('High value order: $%.2f (score +%.1f)', total, CAST(value_score AS DOUBLE)) END,
      CASE WHEN velocity_score > 0 THEN printf('Velocity anomaly detected (score +%.1f)', CAST(velocity_score AS DOUBLE)) END,
      CASE WHEN round_score > 0 THEN 'Suspiciously round amount (score +15)' END,
      CASE WHEN off_hours_score > 0 THEN 'Off-hours order (score +10)' END) AS reason
  FROM s
),
scored AS (
  SELECT *, CASE WHEN fraud_score >= 90 THEN 'REJECT' WHEN fraud_score >= 70 OR total > 1000 THEN 'REVIEW'
                 ELSE 'APPROVE' END AS action
  FROM f
)
"""


@query("fraud_score", _score_sql(60) + "SELECT * FROM scored")
def q_fraud_score(spark, sf_dir):
    return fraud.fraud_score(_orders(spark, sf_dir))


@query("fraud_score_24h", _score_sql(1440) + "SELECT * FROM scored")
def q_fraud_score_24h(spark, sf_dir):
    return fraud.fraud_score(_orders(spark, sf_dir), window_minutes=1440)


@query("order_admission", _score_sql(1440) + """
SELECT order_id AS id, customer_id, total, created_at, fraud_score,
       CASE WHEN action <> 'APPROVE' THEN reason END AS review_reason,
       CASE action WHEN 'REJECT' THEN 'REJECTED' WHEN 'REVIEW' THEN 'PENDING_REVIEW' ELSE 'NEW' END AS status,
       CAST(NULL AS VARCHAR) AS shipping_address
FROM scored""")
def q_order_admission(spark, sf_dir):
    orders, _ = fraud.order_admission(fraud.fraud_score(_orders(spark, sf_dir), window_minutes=1440))
    return orders


ORDER_OUTBOX_SQL = _score_sql(1440) + """
SELECT md5(order_id || ':OrderCreated:' || CAST(epoch_us(created_at) AS VARCHAR)) AS id,
       order_id AS aggregate_id, 'Order' AS aggregate_type, 'OrderCreated' AS type,
       '{"orderId":"' || order_id || '","total":' || CAST(CAST(total AS DOUBLE) AS VARCHAR)
         || ',"currency":"USD","customerId":"' || customer_id || '","shippingAddress":null}' AS payload,
       created_at AS occurred_at
FROM scored WHERE action = 'APPROVE'"""


@query("order_outbox", ORDER_OUTBOX_SQL)
def q_order_outbox(spark, sf_dir):
    _, outbox = fraud.order_admission(fraud.fraud_score(_orders(spark, sf_dir), window_minutes=1440))
    return outbox


@query("fraud_counters", _score_sql(1440) + """
SELECT count(*) AS scanned, count(*) FILTER (WHERE action = 'REVIEW') AS flagged,
       count(*) FILTER (WHERE action = 'REJECT') AS auto_rejected FROM scored""")
def q_fraud_counters(spark, sf_dir):
    return fraud.fraud_counters(fraud.fraud_score(_orders(spark, sf_dir), window_minutes=1440))


@query("fraud_flag_ratio", _score_sql(60) + """
SELECT count(*) FILTER (WHERE total > 1000) AS high_value,
       count(*) FILTER (WHERE total > 1000 AND action IN ('REVIEW', 'REJECT')) AS flagged_high_value,
       CASE WHEN count(*) FILTER (WHERE total > 1000) > 0 THEN
         round(100.0 * count(*) FILTER (WHERE total > 1000 AND action IN ('REVIEW', 'REJECT'))
               / count(*) FILTER (WHERE total > 1000), 6) END AS flag_ratio_pct
FROM scored""")
def q_fraud_flag_ratio(spark, sf_dir):
    return fraud.fraud_flag_ratio(fraud.fraud_score(_orders(spark, sf_dir)))
