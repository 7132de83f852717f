"""Queries: the second outputs of the state operators, and trailing rates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import is_dlt_topic
from ..operators import faults, listeners, metrics, saga
from ..sources import driver_tables as dt
from . import q_listeners, q_saga
from .registry import query
from .sql_inputs import TOPIC_RECORDS, with_

AS_OF = q_saga.AS_OF


def _result_sql(topic: str, ctype: str, service: str) -> str:
    return f"""
SELECT CASE WHEN ok THEN oid ELSE key END AS order_id, "offset" AS seq,
  CAST(json_object('orderId', CASE WHEN ok THEN oid ELSE key END, 'compensationType', '{ctype}', 'success', ok, 'service', '{service}') AS VARCHAR) AS value
FROM cmd_parsed WHERE topic = '{topic}' AND NOT (ok AND oid IS NULL)"""


@query("refund_results", q_listeners.BASE + _result_sql("payment.refund", "PAYMENT_REFUND", "payment-svc"))
def q_refund_results(spark, sf_dir):
    t, s = q_listeners._ts(spark, sf_dir)
    _, results = listeners.apply_refunds(q_listeners._payment_status(s), q_listeners._command_records(t, "payment.refund"))
    return results


def _releases(spark, sf_dir):
    t, s = q_listeners._ts(spark, sf_dir)
    res = s.where(F.col("inventory_reservation_id").isNotNull()).select(
        "order_id", F.col("inventory_reservation_id").alias("reservation_id"))
    return listeners.apply_releases(res, q_listeners._command_records(t, "inventory.release"))


@query("release_results", q_listeners.BASE + _result_sql("inventory.release", "INVENTORY_RELEASE", "inventory-svc"))
def q_release_results(spark, sf_dir):
    return _releases(spark, sf_dir)[2]


@query("reservations_remaining", q_listeners.BASE + """
SELECT order_id, inventory_reservation_id AS reservation_id FROM state
WHERE inventory_reservation_id IS NOT NULL
  AND order_id NOT IN (SELECT oid FROM cmd_parsed WHERE topic = 'inventory.release' AND oid IS NOT NULL)""")
def q_reservations_remaining(spark, sf_dir):
    return _releases(spark, sf_dir)[0]


@query("compensation_counters", q_listeners.BASE + """,
delivered AS (SELECT * FROM cmd_records UNION ALL SELECT * FROM cmd_records WHERE ("offset" // 10) % 4 = 0),
n AS (SELECT topic, count(*) AS received, count(*) - count(DISTINCT key) AS duplicate FROM delivered GROUP BY topic),
refunded AS (SELECT count(*) AS n FROM (SELECT DISTINCT oid FROM cmd_parsed WHERE topic = 'payment.refund') JOIN state ON order_id = oid WHERE payment_id IS NOT NULL),
freed AS (SELECT count(*) AS n FROM cmd_parsed LEFT JOIN state ON order_id = oid
          WHERE topic = 'inventory.release' AND (res_ref IS NOT NULL OR inventory_reservation_id IS NOT NULL))
SELECT 'payment-svc-refund' AS service, received, duplicate, (SELECT n FROM refunded) AS applied FROM n WHERE topic = 'payment.refund'
UNION ALL
SELECT 'inventory-svc-release' AS service, received, duplicate, (SELECT n FROM freed) AS applied FROM n WHERE topic = 'inventory.release'""")
def q_compensation_counters(spark, sf_dir):
    """Refund and release counters; some commands are delivered twice."""
    t, s = q_listeners._ts(spark, sf_dir)

    def delivered(topic):
        sent = q_listeners._command_records(t, topic)
        return sent.unionByName(sent.where(F.floor(F.col("offset") / 10) % 4 == 0))

    refunds, releases = delivered("payment.refund"), delivered("inventory.release")
    held = s.where(F.col("inventory_reservation_id").isNotNull()).select("order_id", F.col("inventory_reservation_id").alias("reservation_id"))
    freed = listeners.apply_releases(held, releases)[1].where("counted")
    refunded = listeners.applied_refunds(q_listeners._payment_status(s), refunds)
    counted = listeners.compensation_counters(refunds, "payment-svc-refund", "payment.refund", refunded).unionByName(
        listeners.compensation_counters(releases, "inventory-svc-release", "inventory.release", freed))
    return counted.where(F.col("received") > 0)  # a service whose topic is empty has no row


@query("stuck_compensations_state", q_saga.TRANSITIONS + f"""
SELECT order_id, state, failed_state, payment_id, inventory_reservation_id, shipping_id, shipping_address, failure_reason,
  CAST(retry_count + CASE WHEN stuck THEN 1 ELSE 0 END AS INTEGER) AS retry_count, created_at,
  CASE WHEN stuck THEN TIMESTAMP '{AS_OF}' ELSE updated_at END AS updated_at
FROM (SELECT *, state = 'COMPENSATING' AND updated_at < TIMESTAMP '{AS_OF}' - INTERVAL 5 MINUTE AS stuck FROM state)""")
def q_stuck_compensations_state(spark, sf_dir):
    new_state, _ = saga.stuck_compensations(q_saga._state(spark, sf_dir), AS_OF)
    return new_state


@query("stuck_pending_status_feed", q_saga.TRANSITIONS + f"""
SELECT order_id, replace(state, '_PENDING', '_FAILED') AS status, 'Timeout waiting for ' || state || ' response' AS reason
FROM state WHERE state IN ('PAYMENT_PENDING', 'INVENTORY_PENDING', 'SHIPPING_PENDING')
  AND updated_at < TIMESTAMP '{AS_OF}' - INTERVAL 10 MINUTE""")
def q_stuck_pending_status_feed(spark, sf_dir):
    return saga.stuck_pending_feed(q_saga._state(spark, sf_dir), AS_OF).select("order_id", "status", "reason")


@query("success_rate_24h", q_saga.TRANSITIONS + """,
h AS (
  SELECT time_bucket(INTERVAL '1 hour', ts) AS h, count(*) FILTER (WHERE event_type = 'ShippingCompleted') AS s,
         count(*) FILTER (WHERE failed_state IS NOT NULL) AS f FROM transitions GROUP BY 1
),
w AS (SELECT h, CAST(sum(s) OVER r AS BIGINT) AS s, CAST(sum(f) OVER r AS BIGINT) AS f
      FROM h WINDOW r AS (ORDER BY h RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW))
SELECT h + INTERVAL 1 HOUR AS eval_time, s AS succeeded, f AS failed, round(100.0 * s / greatest(s + f, 1), 6) AS success_rate_pct FROM w""")
def q_success_rate_24h(spark, sf_dir):
    t = q_saga._transitions(spark, sf_dir)
    return metrics.trailing_success_rate(t, F.col("event_type") == "ShippingCompleted", F.col("failed_state").isNotNull(), "ts")


@query("canary_dlt_rate", with_(TOPIC_RECORDS) + """,
c AS (SELECT *, CASE WHEN CAST(('0x' || substr(md5(key), 1, 8)) AS BIGINT) % 10000 < 1000 THEN 'canary' ELSE 'main' END AS channel
      FROM topic_records)
SELECT channel, count(*) FILTER (WHERE regexp_matches(topic, '[-.](dlt|DLT)$')) AS dead, count(*) AS messages,
       round(100.0 * count(*) FILTER (WHERE regexp_matches(topic, '[-.](dlt|DLT)$')) / count(*), 6) AS dlt_rate_pct
FROM c GROUP BY channel""")
def q_canary_dlt_rate(spark, sf_dir):
    records = faults.canary_split(dt.topic_records(dt.table(spark, sf_dir, "events")), 0.1, "key")
    return metrics.channel_dlt_rate(records, "channel", is_dlt_topic("topic"))
