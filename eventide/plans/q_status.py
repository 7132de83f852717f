"""Queries: payment-status topology and burn rates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import status_counts as sc
from ..sources import driver_tables as dt
from .registry import query
from .sql_inputs import PAYMENT_RECORDS, PAYMENT_STATUS, with_


def _records(spark, sf_dir):
    return dt.payment_result_records(dt.table(spark, sf_dir, "events"))


@query("payment_status", with_(PAYMENT_RECORDS) + f"""
SELECT key, {PAYMENT_STATUS} AS status FROM payment_records""")
def q_payment_status(spark, sf_dir):
    return sc.with_payment_status(_records(spark, sf_dir)).select("key", "status")


@query("status_count", with_(PAYMENT_RECORDS) + f"""
SELECT status, count(*) AS cnt FROM (SELECT {PAYMENT_STATUS} AS status FROM payment_records) GROUP BY status""")
def q_status_count(spark, sf_dir):
    return sc.status_count(_records(spark, sf_dir))


def _window_sql(interval: str) -> str:
    return with_(PAYMENT_RECORDS) + f"""
SELECT time_bucket(INTERVAL '{interval}', "timestamp") AS window_start,
       time_bucket(INTERVAL '{interval}', "timestamp") + INTERVAL '{interval}' AS window_end,
       {PAYMENT_STATUS} AS status, count(*) AS cnt
FROM payment_records GROUP BY 1, 2, 3"""


@query("status_count_1h", _window_sql("1 hour"))
def q_status_count_1h(spark, sf_dir):
    return sc.status_count_window(_records(spark, sf_dir), "1 hour")


@query("status_count_6h", _window_sql("6 hours"))
def q_status_count_6h(spark, sf_dir):
    return sc.status_count_window(_records(spark, sf_dir), "6 hours")


def _burn_sql(interval: str) -> str:
    return f"""WITH counts AS ({_window_sql(interval)})
SELECT window_start, window_end,
       CAST(coalesce(sum(cnt) FILTER (WHERE status = 'CHARGED'), 0) AS BIGINT) AS charged,
       CAST(coalesce(sum(cnt) FILTER (WHERE status = 'CHARGE_FAILED'), 0) AS BIGINT) AS charge_failed,
       CAST(CASE WHEN coalesce(sum(cnt) FILTER (WHERE status IN ('CHARGED', 'CHARGE_FAILED')), 0) = 0 THEN 0
            ELSE (coalesce(sum(cnt) FILTER (WHERE status = 'CHARGE_FAILED'), 0) * 100)
                 // sum(cnt) FILTER (WHERE status IN ('CHARGED', 'CHARGE_FAILED')) END AS BIGINT) AS burn_rate
FROM counts GROUP BY 1, 2"""


@query("burn_rate_1h", _burn_sql("1 hour"))
def q_burn_rate_1h(spark, sf_dir):
    return sc.burn_rate_windows(_records(spark, sf_dir), "1 hour")


@query("burn_rate_6h", _burn_sql("6 hours"))
def q_burn_rate_6h(spark, sf_dir):
    return sc.burn_rate_windows(_records(spark, sf_dir), "6 hours")
