"""Queries: remaining projections (envelope build, request validation,
channel merge, status-update parsing) and the streaming twins that run a
Structured Streaming query to completion (SURVEY 2.B/2.F/2.G)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.columns import ntz_as_utc
from ..operators import envelope, listeners, saga
from ..operators.faults import merge_channels
from ..sources import driver_tables as dt
from ..streaming import streams
from ..session import scratch_path
from . import q_listeners, q_saga, q_status
from .registry import query
from .sql_inputs import PAYMENT_RECORDS, PAYMENT_STATUS, TOPIC_RECORDS, with_


@query("build_envelope", q_listeners.BASE + """
SELECT key AS order_id, "offset", value AS envelope FROM cmd_records""")
def q_build_envelope(spark, sf_dir):
    t = q_saga._transitions(spark, sf_dir)
    cmds = saga.compensation_plan(t).withColumn(
        "event_id", F.concat(F.lit("cmd-"), F.col("seq").cast("string"), F.lit("-"), F.col("cmd_order").cast("string")))
    env = envelope.build_envelope(cmds, "order_id", "event_id", "envelope_type", "payload")
    return env.select("order_id", (F.col("seq") * 10 + F.col("cmd_order")).alias("offset"), "envelope")


@query("parse_status_update", q_listeners.BASE + """
SELECT key, "offset", json_extract_string(value, '$.orderId') AS order_id,
  CASE WHEN json_extract_string(value, '$.status') IN ('COMPLETED', 'CANCELLED', 'PAYMENT_FAILED',
       'INVENTORY_FAILED', 'SHIPPING_FAILED') THEN json_extract_string(value, '$.status') ELSE 'FAILED' END AS new_status,
  json_extract_string(value, '$.reason') AS reason,
  CAST(NULL AS VARCHAR) AS error_reason
FROM feed""")
def q_parse_status_update(spark, sf_dir):
    t = q_saga._transitions(spark, sf_dir)
    msgs = q_listeners._status_msgs(t)
    return envelope.parse_status_update(msgs).select("key", "offset", "order_id", "new_status", "reason",
                                                     "error_reason")


PR = with_(PAYMENT_RECORDS)
BODY = "CASE WHEN json_valid(value) THEN json_extract_string(value, '$.payload') END"


@query("validate_inventory_request", PR + f"""
SELECT order_id, 1 AS items, CAST(NULL AS VARCHAR) AS error_reason FROM (
  SELECT json_extract_string({BODY}, '$.orderId') AS order_id, json_extract_string({BODY}, '$.status') AS st
  FROM payment_records WHERE json_valid({BODY}))
WHERE order_id IS NOT NULL AND st = 'CHARGED'""")
def q_validate_inventory_request(spark, sf_dir):
    req, _ = listeners.inventory_request_from_payment(dt.payment_result_records(dt.table(spark, sf_dir, "events")))
    v = envelope.validate_inventory_request(req.select(F.col("value")))
    return v.select("order_id", "items", "error_reason")


@query("validate_shipping_request", q_saga.TRANSITIONS + """
SELECT t.order_id, t.seq, coalesce(CASE WHEN trim(s.shipping_address) <> '' THEN s.shipping_address END,
       'Default Address - Please Update') AS address, CAST(NULL AS VARCHAR) AS error_reason
FROM transitions t LEFT JOIN state s USING (order_id) WHERE t.event_type = 'ShippingRequested'""")
def q_validate_shipping_request(spark, sf_dir):
    t = q_saga._transitions(spark, sf_dir)
    req = saga.enrich_shipping_address(t.where(F.col("event_type") == "ShippingRequested").select("order_id", "seq"),
                                       saga.saga_current_state(t))
    msg = req.select("seq", F.to_json(F.struct(F.col("order_id").alias("orderId"),
                                               F.col("address").alias("address"))).alias("value"))
    v = envelope.validate_shipping_request(msg)
    return v.select("order_id", "seq", "address", "error_reason")


@query("merge_channels", with_(PAYMENT_RECORDS, TOPIC_RECORDS) + """
SELECT key, topic, 'results' AS channel FROM payment_records
UNION ALL SELECT key, topic, 'topics' AS channel FROM topic_records""")
def q_merge_channels(spark, sf_dir):
    """Two record sets, payment results and the other topics, as one."""
    events = dt.table(spark, sf_dir, "events")
    return merge_channels({"results": dt.payment_result_records(events), "topics": dt.topic_records(events)}, ["key", "topic"])


def _fresh(spark, name):
    return scratch_path(spark, "queries", f"{name}-{uuid.uuid4().hex}")


@query("status_count_stream", PR + f"""
SELECT status, count(*) AS cnt FROM (SELECT {PAYMENT_STATUS} AS status FROM payment_records) GROUP BY status""")
def q_status_count_stream(spark, sf_dir):
    """Running count per status computed by a streaming query (update mode,
    changelog sink) over the records written as files; the latest changelog
    row per status is the count."""
    base = _fresh(spark, "status_count_stream")
    recs = q_status._records(spark, sf_dir).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    recs.write.parquet(f"{base}/src")
    src = spark.readStream.schema(recs.schema).option("maxFilesPerTrigger", 4).parquet(f"{base}/src")
    out = streams.run_available_now(streams.running_status_count_stream(src), "scs", mode="update", root=base)
    log = spark.read.parquet(out)
    return log.groupBy("status").agg(F.max_by("cnt", "batch_id").alias("cnt"))


@query("status_count_1h_stream", PR + f"""
SELECT time_bucket(INTERVAL '1 hour', "timestamp") AS window_start, time_bucket(INTERVAL '1 hour', "timestamp") + INTERVAL '1 hour' AS window_end,
       status, count(*) AS cnt FROM (SELECT "timestamp", {PAYMENT_STATUS} AS status FROM payment_records) GROUP BY 1, 2, 3""")
def q_status_count_1h_stream(spark, sf_dir):
    """Tumbling counts by the streaming topology (watermark of 24 h less the
    window; update mode): the latest changelog row of each window and status.
    All files are one micro-batch here, so no record comes late."""
    base = _fresh(spark, "status_count_1h_stream")
    recs = q_status._records(spark, sf_dir).withColumn("timestamp", ntz_as_utc("timestamp"))
    recs.write.parquet(f"{base}/src")
    src = spark.readStream.schema(recs.schema).parquet(f"{base}/src")
    out = streams.run_available_now(streams.status_counts_stream(src, "1 hour"), "sc1h", mode="update", root=base)
    log = spark.read.parquet(out).groupBy("window_start", "window_end", "status").agg(F.max_by("cnt", "batch_id").alias("cnt"))
    utc = lambda c: F.to_timestamp_ntz(F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(c).cast("timestamp_ntz")), "yyyy-MM-dd HH:mm:ss"))
    return log.select(utc("window_start").alias("window_start"), utc("window_end").alias("window_end"), "status", "cnt")


@query("saga_stream", q_saga.TRANSITIONS + """
SELECT order_id, state, failed_state, payment_id, inventory_reservation_id, shipping_id, shipping_address,
       failure_reason, retry_count FROM state""")
def q_saga_stream(spark, sf_dir):
    """Saga state per order from the streaming aggregation (update mode,
    changelog sink, several micro-batches); the latest emitted row per order
    is its current state."""
    base = _fresh(spark, "saga_stream")
    ev = q_saga._events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    ev.write.parquet(f"{base}/src")
    src = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/src")
    out = streams.run_available_now(streams.saga_state_stream(src), "saga", mode="update", root=base)
    rows = spark.read.parquet(out)
    latest = rows.groupBy("order_id").agg(
        F.max_by(F.struct(*[c for c in rows.columns if c not in ("order_id", "batch_id")]), "batch_id").alias("r"))
    return latest.select("order_id", "r.state", "r.failed_state", "r.payment_id", "r.inventory_reservation_id",
                         "r.shipping_id", "r.shipping_address", "r.failure_reason", "r.retry_count")
