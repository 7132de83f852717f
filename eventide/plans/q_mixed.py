"""Queries: every parser and validator over messages of which many are faulty."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import envelope
from ..sources import driver_tables as dt
from .q_listeners import UUID_RE
from .registry import query
from .sql_inputs import MIXED_MESSAGES, with_

# payload in an envelope; the payload or else the message itself; each NULL unless it is JSON
BASE = with_(MIXED_MESSAGES) + """,
e AS (SELECT *, CASE WHEN json_valid(value) THEN value END AS doc FROM mixed_messages),
p AS (SELECT *, json_extract_string(doc, '$.payload') AS inner_text FROM e),
m AS (SELECT *, CASE WHEN json_valid(inner_text) THEN inner_text END AS body,
             CASE WHEN inner_text IS NULL THEN doc WHEN json_valid(inner_text) THEN inner_text END AS own FROM p)
"""


def _blank(x: str) -> str:
    return f"({x} IS NULL OR regexp_full_match({x}, '\\s*'))"


def _get(doc: str, field: str) -> str:
    return f"json_extract_string({doc}, '$.{field}')"


def _messages(spark, sf_dir):
    return dt.mixed_messages(dt.table(spark, sf_dir, "events"))


@query("parse_payment_result_mixed", BASE + f"""
SELECT "offset", {_get("body", "orderId")} AS order_id, coalesce({_get("body", "status")}, 'UNKNOWN') AS status, {_get("body", "paymentId")} AS payment_id,
  coalesce({_get("body", "reason")}, 'Payment declined') AS reason, upper(coalesce({_get("body", "status")}, 'UNKNOWN')) = 'CHARGED' AS success,
  CASE WHEN body IS NULL THEN 'Failed to parse payment.result' WHEN {_blank(_get("body", "orderId"))} THEN 'Missing orderId' END AS error_reason
FROM m""")
def q_parse_payment_result_mixed(spark, sf_dir):
    p = envelope.parse_payment_result(_messages(spark, sf_dir))
    return p.select("offset", "order_id", "status", "payment_id", "reason", "success", "error_reason")


@query("parse_inventory_result_mixed", BASE + f"""
SELECT "offset", {_get("doc", "orderId")} AS order_id, coalesce({_get("body", "status")}, '') AS status,
  CASE WHEN body IS NULL THEN 'Failed to parse inventory.result' WHEN {_blank(_get("doc", "orderId"))} THEN 'Missing orderId' END AS error_reason
FROM m""")
def q_parse_inventory_result_mixed(spark, sf_dir):
    return envelope.parse_inventory_result(_messages(spark, sf_dir)).select("offset", "order_id", "status", "error_reason")


@query("parse_shipping_result_mixed", BASE + f"""
SELECT "offset", {_get("doc", "orderId")} AS order_id, coalesce({_get("body", "status")}, '') AS status,
  CASE WHEN {_get("body", "status")} IN ('DELIVERED', 'SHIPPED') THEN NULL
       WHEN {_get("body", "status")} = 'FAILED' THEN coalesce({_get("body", "reason")}, 'Shipping failed')
       ELSE 'Unknown shipping status: ' || coalesce({_get("body", "status")}, '') END AS reason,
  CASE WHEN body IS NULL THEN 'Failed to parse shipping.result' WHEN {_blank(_get("doc", "orderId"))} THEN 'Missing orderId' END AS error_reason
FROM m""")
def q_parse_shipping_result_mixed(spark, sf_dir):
    return envelope.parse_shipping_result(_messages(spark, sf_dir)).select("offset", "order_id", "status", "reason", "error_reason")


@query("parse_status_update_mixed", BASE + f"""
SELECT "offset", {_get("doc", "orderId")} AS order_id,
  CASE WHEN {_get("doc", "status")} IN ('COMPLETED', 'CANCELLED', 'PAYMENT_FAILED', 'INVENTORY_FAILED', 'SHIPPING_FAILED')
       THEN {_get("doc", "status")} ELSE 'FAILED' END AS new_status,
  CASE WHEN doc IS NULL THEN 'Invalid JSON'
       WHEN {_get("doc", "orderId")} IS NULL OR {_get("doc", "status")} IS NULL THEN 'Invalid status update message'
       WHEN NOT regexp_matches({_get("doc", "orderId")}, '{UUID_RE}') THEN 'Invalid UUID format' END AS error_reason
FROM m""")
def q_parse_status_update_mixed(spark, sf_dir):
    return envelope.parse_status_update(_messages(spark, sf_dir)).select("offset", "order_id", "new_status", "error_reason")


@query("validate_inventory_request_mixed", BASE + f"""
SELECT "offset", {_get("own", "orderId")} AS order_id, items,
  CASE WHEN own IS NULL THEN 'Invalid JSON' WHEN items <= 0 THEN 'Invalid items count' END AS error_reason
FROM (SELECT *, coalesce(TRY_CAST({_get("own", "items")} AS INTEGER), 1) AS items FROM m)""")
def q_validate_inventory_request_mixed(spark, sf_dir):
    return envelope.validate_inventory_request(_messages(spark, sf_dir)).select("offset", "order_id", "items", "error_reason")


@query("validate_shipping_request_mixed", BASE + f"""
SELECT "offset", {_get("own", "orderId")} AS order_id, {_get("own", "address")} AS address,
  CASE WHEN own IS NULL THEN 'Invalid JSON'
       WHEN {_blank(_get("own", "address"))} OR {_get("own", "address")} = 'UNKNOWN' THEN 'Invalid address' END AS error_reason
FROM m""")
def q_validate_shipping_request_mixed(spark, sf_dir):
    return envelope.validate_shipping_request(_messages(spark, sf_dir)).select("offset", "order_id", "address", "error_reason")


@query("parse_order_created_mixed", BASE + f"""
SELECT "offset", {_get("own", "orderId")} AS order_id, coalesce(TRY_CAST({_get("own", "total")} AS DOUBLE), 0.0) AS total,
  coalesce({_get("own", "currency")}, 'USD') AS currency, coalesce({_get("own", "customerId")}, 'N/A') AS customer_id,
  CASE WHEN own IS NULL THEN 'Failed to parse order.created' WHEN {_blank(_get("own", "orderId"))} THEN 'Missing orderId' END AS error_reason
FROM m""")
def q_parse_order_created_mixed(spark, sf_dir):
    p = envelope.parse_order_created(_messages(spark, sf_dir))
    return p.select("offset", "order_id", "total", "currency", "customer_id", "error_reason")


@query("validate_create_order_mixed", BASE + f"""
SELECT "offset", nullif(concat_ws('; ', CASE WHEN {_blank("customer_id")} THEN 'customerId must not be blank' END,
  CASE WHEN {_blank("currency")} THEN 'currency must not be blank' END,
  CASE WHEN total IS NULL OR total < 0.01 THEN 'total must be >= 0.01' END), '') AS error_reason
FROM (SELECT "offset", {_get("own", "customerId")} AS customer_id, {_get("own", "currency")} AS currency,
             TRY_CAST({_get("own", "total")} AS DOUBLE) AS total FROM m)""")
def q_validate_create_order_mixed(spark, sf_dir):
    """Orders as the messages give them, before any default."""
    x = _messages(spark, sf_dir)
    own = envelope._with_unwrapped(x, "value", ["customerId", "currency", "total"]).select(
        "offset", F.col("_b.customerId").alias("customer_id"), F.col("_b.currency").alias("currency"),
        F.col("_b.total").try_cast("double").alias("total"))
    return envelope.validate_create_order(own).select("offset", "error_reason")
