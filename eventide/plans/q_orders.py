"""Queries: order-table repository queries, paging, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import fraud
from ..operators import orders as o
from ..sources import driver_tables as dt
from . import q_fraud
from .registry import query
from .sql_inputs import ORDER_TABLE, with_


def _orders(spark, sf_dir):
    return dt.order_table(dt.table(spark, sf_dir, "orders"))


OT = with_(ORDER_TABLE)


@query("orders_page", OT + "SELECT * FROM order_table ORDER BY created_at DESC, id DESC LIMIT 20 OFFSET 60")
def q_orders_page(spark, sf_dir):
    return o.orders_page(_orders(spark, sf_dir), page=3, size=20)


@query("orders_page_deep", OT + "SELECT * FROM order_table ORDER BY created_at DESC, id DESC LIMIT 50 OFFSET 1250")
def q_orders_page_deep(spark, sf_dir):
    return o.orders_page(_orders(spark, sf_dir), 25, 50)


@query("orders_page_info", OT + """
SELECT 3 AS page, 20 AS size, count(*) AS total_elements, CAST(ceil(count(*) / 20) AS BIGINT) AS total_pages,
       4 < CAST(ceil(count(*) / 20) AS BIGINT) AS has_next, true AS has_previous FROM order_table""")
def q_orders_page_info(spark, sf_dir):
    return o.orders_page_info(_orders(spark, sf_dir), page=3, size=20)


@query("orders_all", OT + "SELECT * FROM order_table ORDER BY created_at DESC, id DESC")
def q_orders_all(spark, sf_dir):
    return o.orders_all(_orders(spark, sf_dir))


@query("orders_by_status", OT + "SELECT * FROM order_table WHERE status = 'F'")
def q_orders_by_status(spark, sf_dir):
    return o.orders_by_status(_orders(spark, sf_dir), "F")


@query("orders_by_customer", OT + "SELECT * FROM order_table WHERE customer_id = 7")
def q_orders_by_customer(spark, sf_dir):
    return o.orders_by_customer(_orders(spark, sf_dir), 7)


@query("order_by_id", OT + "SELECT * FROM order_table WHERE id = 42")
def q_order_by_id(spark, sf_dir):
    return o.order_by_id(_orders(spark, sf_dir), 42)


@query("high_value_orders", OT + "SELECT * FROM order_table WHERE total > 400000 ORDER BY created_at DESC, id DESC")
def q_high_value_orders(spark, sf_dir):
    return o.high_value_orders(_orders(spark, sf_dir), 400000.0)


@query("count_by_status_orders", OT + "SELECT status, count(*) AS cnt FROM order_table GROUP BY status")
def q_count_by_status_orders(spark, sf_dir):
    return o.count_by_status(_orders(spark, sf_dir))


@query("recent_orders", OT + "SELECT * FROM order_table ORDER BY created_at DESC, id DESC LIMIT 5")
def q_recent_orders(spark, sf_dir):
    return o.recent(_orders(spark, sf_dir), "created_at", "id", 5)


def _admitted(spark, sf_dir):
    return fraud.order_admission(fraud.fraud_score(q_fraud._orders(spark, sf_dir), window_minutes=1440))


@query("pending_review", q_fraud._score_sql(1440) + """
SELECT order_id AS id, customer_id, total, created_at, fraud_score, reason AS review_reason,
       'PENDING_REVIEW' AS status, CAST(NULL AS VARCHAR) AS shipping_address
FROM scored WHERE action = 'REVIEW'""")
def q_pending_review(spark, sf_dir):
    orders, _ = _admitted(spark, sf_dir)
    return o.orders_by_status(orders, "PENDING_REVIEW")


@query("recent_outbox", q_fraud._score_sql(1440) + """
SELECT md5(order_id || ':OrderCreated:' || CAST(epoch_us(created_at) AS VARCHAR)) AS id,
       order_id AS aggregate_id, 'Order' AS aggregate_type, 'OrderCreated' AS type,
       '{"orderId":"' || order_id || '","total":' || CAST(CAST(total AS DOUBLE) AS VARCHAR)
         || ',"currency":"USD","customerId":"' || customer_id || '","shippingAddress":null}' AS payload,
       created_at AS occurred_at
FROM scored WHERE action = 'APPROVE' ORDER BY occurred_at DESC, id DESC LIMIT 5""")
def q_recent_outbox(spark, sf_dir):
    _, outbox = _admitted(spark, sf_dir)
    return o.recent(outbox, "occurred_at", "id", 5)


REVIEW_SQL = q_fraud._score_sql(1440) + """,
adm AS (
  SELECT order_id AS id, customer_id, total, created_at, fraud_score,
         CASE WHEN action <> 'APPROVE' THEN reason END AS review_reason,
         CASE action WHEN 'REJECT' THEN 'REJECTED' WHEN 'REVIEW' THEN 'PENDING_REVIEW' ELSE 'NEW' END AS status
  FROM scored
),
made AS (
  SELECT id, total, created_at, unnest(CASE
    WHEN status = 'PENDING_REVIEW' AND total >= 5000 THEN [
      {'k': 1, 'd': 'REJECT', 'h': 1, 'r': 'too large'}, {'k': 2, 'd': 'APPROVE', 'h': 2, 'r': NULL}, {'k': 3, 'd': 'REJECT', 'h': 3, 'r': NULL}]
    WHEN status = 'PENDING_REVIEW' THEN [{'k': 1, 'd': 'APPROVE', 'h': 1, 'r': NULL}, {'k': 2, 'd': 'APPROVE', 'h': 1, 'r': NULL}]
    WHEN status = 'REJECTED' THEN [{'k': 1, 'd': 'APPROVE', 'h': 1, 'r': NULL}, {'k': 2, 'd': 'REJECT', 'h': 1, 'r': NULL}]
    WHEN total >= 1000 THEN [{'k': 1, 'd': 'REJECT', 'h': 1, 'r': NULL}, {'k': 2, 'd': 'APPROVE', 'h': 1, 'r': NULL}]
    ELSE [] END) AS e
  FROM adm
),
decisions AS (
  SELECT CASE WHEN CAST(id AS BIGINT) % 17 = 3 THEN 'gone-' || id ELSE id END AS order_id, e.d AS decision, e.r AS reason,
         created_at + e.h * INTERVAL 1 HOUR AS ts, id || ':' || e.k AS decision_id
  FROM made
),
ranked AS (
  SELECT d.*, a.status AS before, row_number() OVER o AS n,
         count(*) FILTER (WHERE decision = 'REJECT') OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS rejects,
         first_value(decision) OVER o AS opening
  FROM decisions d LEFT JOIN adm a ON a.id = d.order_id WINDOW o AS (PARTITION BY order_id ORDER BY ts, decision_id)
),
judged AS (
  SELECT *, CASE WHEN rejects > 0 THEN 'REJECTED' WHEN n > 1 AND before = 'PENDING_REVIEW' AND opening = 'APPROVE' THEN 'APPROVED' ELSE before END AS status
  FROM ranked
)
"""


@query("apply_review_decisions", REVIEW_SQL + """,
rej AS (SELECT order_id, arg_max(coalesce(reason, 'Rejected during manual review'), struct_pack(t := ts, i := decision_id)) AS why
        FROM decisions WHERE decision = 'REJECT' GROUP BY order_id),
ok AS (SELECT DISTINCT order_id FROM judged WHERE decision = 'APPROVE' AND status = 'PENDING_REVIEW')
SELECT a.id, a.customer_id, a.total, a.created_at, a.fraud_score,
       CASE WHEN rej.order_id IS NOT NULL THEN rej.why ELSE a.review_reason END AS review_reason,
       CASE WHEN rej.order_id IS NOT NULL THEN 'REJECTED' WHEN ok.order_id IS NOT NULL THEN 'APPROVED' ELSE a.status END AS status,
       CAST(NULL AS VARCHAR) AS shipping_address
FROM adm a LEFT JOIN rej ON rej.order_id = a.id LEFT JOIN ok ON ok.order_id = a.id""")
def q_apply_review_decisions(spark, sf_dir):
    return _reviewed(spark, sf_dir)[0]


def _reviewed(spark, sf_dir):
    """Large pending orders are rejected, then (wrongly) approved, then rejected again; other pending ones
    get two approvals at one instant; some final ones an approval and a rejection; some ids do not exist."""
    orders, _ = _admitted(spark, sf_dir)
    big = F.col("total") >= F.lit(5000).cast("decimal(12,2)")
    pending = F.col("status") == "PENDING_REVIEW"

    def made(n, decision, hours, reason=None):
        return F.struct(F.lit(n).alias("n"), F.lit(decision).alias("decision"), F.lit(reason).cast("string").alias("reason"),
                        (F.col("created_at") + F.expr(f"INTERVAL {hours} HOUR")).alias("ts"))

    each = (
        F.when(pending & big, F.array(made(1, "REJECT", 1, "too large"), made(2, "APPROVE", 2), made(3, "REJECT", 3)))
        .when(pending, F.array(made(1, "APPROVE", 1), made(2, "APPROVE", 1)))
        .when(F.col("status") == "REJECTED", F.array(made(1, "APPROVE", 1), made(2, "REJECT", 1)))
        .when(F.col("total") >= F.lit(1000).cast("decimal(12,2)"), F.array(made(1, "REJECT", 1), made(2, "APPROVE", 1)))
    )
    decisions = orders.select("id", F.explode(each).alias("d")).select(
        F.when(F.col("id").cast("bigint") % 17 == 3, F.concat(F.lit("gone-"), "id")).otherwise(F.col("id")).alias("order_id"),
        "d.decision", "d.reason", "d.ts", F.concat_ws(":", "id", "d.n").alias("decision_id"))
    return fraud.apply_review_decisions(orders, decisions)


@query("review_outbox", REVIEW_SQL + """
SELECT md5(order_id || ':OrderCreated:' || CAST(epoch_us(ts) AS VARCHAR)) AS id, order_id AS aggregate_id, 'Order' AS aggregate_type,
       'OrderCreated' AS type, '{"orderId":"' || order_id || '","total":' || CAST(CAST(total AS DOUBLE) AS VARCHAR)
         || ',"currency":"USD","customerId":"' || customer_id || '","shippingAddress":null}' AS payload, ts AS occurred_at
FROM judged JOIN adm ON adm.id = order_id WHERE decision = 'APPROVE' AND judged.status = 'PENDING_REVIEW'""")
def q_review_outbox(spark, sf_dir):
    return _reviewed(spark, sf_dir)[1]


@query("review_rejected", REVIEW_SQL + """
SELECT order_id, decision, ts, decision_id,
  CASE WHEN before IS NULL THEN 'Order not found: ' || order_id ELSE 'Cannot approve order in status: ' || status END AS error_reason
FROM judged WHERE before IS NULL OR (decision = 'APPROVE' AND status <> 'PENDING_REVIEW')""")
def q_review_rejected(spark, sf_dir):
    return _reviewed(spark, sf_dir)[2]
