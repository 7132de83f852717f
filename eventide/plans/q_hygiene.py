"""Queries: fault injection, envelope parsing, quarantine, de-duplication
(SURVEY 2.A/2.B/2.D/2.G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedup, envelope, faults, metrics
from ..sources import driver_tables as dt
from .registry import query
from .sql_inputs import FAULT_RULES, PAYMENT_RECORDS, TOPIC_RECORDS, faulted_records, with_

FR = with_(TOPIC_RECORDS, faulted_records())


def _rules(spark):
    return spark.createDataFrame(FAULT_RULES, faults.RULES_SCHEMA)


def _records(spark, sf_dir):
    return dt.topic_records(dt.table(spark, sf_dir, "events")).drop("headers")


def _faulted(spark, sf_dir):
    return faults.inject_faults(_records(spark, sf_dir), _rules(spark), seed=42)


@query("inject_faults", FR + "SELECT * FROM faulted")
def q_inject_faults(spark, sf_dir):
    return _faulted(spark, sf_dir)


@query("resolve_fault_rule", with_(TOPIC_RECORDS) + """,
fault_rules AS (""" + " UNION ALL ".join(
    f"SELECT '{k}' AS key, CAST({a} AS DOUBLE) AS p_drop, CAST({b} AS DOUBLE) AS p_dup, "
    f"CAST({c} AS INTEGER) AS max_delay_ms, CAST({d} AS DOUBLE) AS p_corrupt" for k, a, b, c, d in FAULT_RULES) + """)
SELECT t.topic, t."partition", t."offset",
       coalesce(rt.p_drop, ry.p_drop, 0.0) AS p_drop, coalesce(rt.p_dup, ry.p_dup, 0.0) AS p_dup,
       coalesce(rt.max_delay_ms, ry.max_delay_ms, 0) AS max_delay_ms,
       coalesce(rt.p_corrupt, ry.p_corrupt, 0.0) AS p_corrupt
FROM topic_records t
LEFT JOIN fault_rules rt ON rt.key = 'topic:' || t.topic
LEFT JOIN fault_rules ry ON ry.key = 'type:' || json_extract_string(t.value, '$.type')""")
def q_resolve_fault_rule(spark, sf_dir):
    r = faults.resolve_fault_rule(_records(spark, sf_dir), _rules(spark))
    return r.select("topic", "partition", "offset", "rule.*")


PARSED = FR + """,
parsed AS (
  SELECT key, topic, "partition", "offset", copy, "timestamp",
    CASE WHEN json_valid(value) THEN json_extract_string(value, '$.orderId') END AS order_id,
    CASE WHEN json_valid(value) THEN json_extract_string(value, '$.eventId') END AS event_id,
    CASE WHEN json_valid(value) THEN json_extract_string(value, '$.type') END AS type,
    CASE WHEN json_valid(value) THEN coalesce(json_extract_string(value, '$.payload'), '{}') END AS payload,
    CASE WHEN NOT json_valid(value) THEN 'Envelope parse failed' END AS error_reason,
    value
  FROM faulted
)
"""

PARSE_COLS = ["key", "topic", "partition", "offset", "copy", "order_id", "event_id", "type", "payload",
              "error_reason"]


def _parsed(spark, sf_dir):
    return envelope.parse_envelope(_faulted(spark, sf_dir))


@query("parse_envelope", PARSED + 'SELECT key, topic, "partition", "offset", copy, order_id, event_id, type, '
                                  'payload, error_reason FROM parsed')
def q_parse_envelope(spark, sf_dir):
    return _parsed(spark, sf_dir).select(*PARSE_COLS)


@query("split_quarantine", PARSED + 'SELECT key, topic, "partition", "offset", copy, value, error_reason '
                                    'FROM parsed WHERE error_reason IS NOT NULL')
def q_split_quarantine(spark, sf_dir):
    _, bad = envelope.split_quarantine(_parsed(spark, sf_dir))
    return bad.select("key", "topic", "partition", "offset", "copy", "value", "error_reason")


@query("idempotent_consume", PARSED + """
SELECT key, topic, "partition", "offset", copy, "timestamp", order_id, event_id, type, payload FROM (
  SELECT *, row_number() OVER (PARTITION BY topic, event_id ORDER BY "timestamp", copy, "offset") AS rn
  FROM parsed WHERE error_reason IS NULL) WHERE rn = 1""")
def q_idempotent_consume(spark, sf_dir):
    good, _ = envelope.split_quarantine(_parsed(spark, sf_dir))
    cols = ["key", "topic", "partition", "offset", "copy", "timestamp", "order_id", "event_id", "type", "payload"]
    return dedup.dedup_first_seen(good.select(*cols), ["event_id"], ["timestamp", "copy", "offset"], ["topic"])


@query("message_counters", PARSED + """
SELECT topic, count(*) AS received,
       count(DISTINCT CASE WHEN error_reason IS NULL THEN event_id END) AS processed,
       count(CASE WHEN error_reason IS NULL THEN event_id END)
         - count(DISTINCT CASE WHEN error_reason IS NULL THEN event_id END) AS duplicate,
       count(*) FILTER (WHERE error_reason IS NOT NULL) AS failed
FROM parsed GROUP BY topic""")
def q_message_counters(spark, sf_dir):
    p = _parsed(spark, sf_dir)
    return metrics.message_counters(p, "topic", F.col("event_id"), F.col("error_reason").isNotNull())


#: topic -> consumer group that reads it; dead letters have none
CONSUMERS = {"order.created": "orchestrator", "payment.requested": "payment-svc", "inventory.requested": "inventory-svc", "payment.result": "orchestrator-payment"}
STORE_CUT = "2024-01-03 00:00:00"


@query("consumer_counters", PARSED + """,
own AS (SELECT *, CASE topic """ + " ".join(f"WHEN '{t}' THEN '{c}'" for t, c in CONSUMERS.items()) + f""" END AS service FROM parsed),
old AS (SELECT DISTINCT service, key FROM own WHERE "timestamp" < TIMESTAMP '{STORE_CUT}'),
fresh AS (SELECT o.*, row_number() OVER (PARTITION BY o.service, o.key ORDER BY o."timestamp", copy, "offset") = 1 AND old.key IS NULL AS handled
          FROM own o LEFT JOIN old ON old.service = o.service AND old.key = o.key
          WHERE o.service IS NOT NULL AND o."timestamp" >= TIMESTAMP '{STORE_CUT}')
SELECT service, count(*) AS received, count(*) FILTER (WHERE handled AND error_reason IS NULL) AS processed,
       count(*) FILTER (WHERE NOT handled) AS duplicate, count(*) FILTER (WHERE handled AND error_reason IS NOT NULL) AS failed
FROM fresh GROUP BY service""")
def q_consumer_counters(spark, sf_dir):
    """Counters of each idempotent consumer against the keys that an earlier run put into its store."""
    service = F.lit(None).cast("string")
    for topic, name in CONSUMERS.items():
        service = F.when(F.col("topic") == topic, F.lit(name)).otherwise(service)
    own = _parsed(spark, sf_dir).withColumn("service", service).where(F.col("service").isNotNull())
    cut = F.lit(STORE_CUT).cast("timestamp_ntz")
    return metrics.consumer_counters(own.where(F.col("timestamp") >= cut), "service", "key", ["timestamp", "copy", "offset"],
                                     F.col("error_reason").isNotNull(), own.where(F.col("timestamp") < cut))


@query("fault_impact", PARSED + """,
lab AS (
  SELECT *, CASE WHEN "timestamp" < TIMESTAMP '2024-01-10 00:00:00' THEN 'before'
                 WHEN "timestamp" < TIMESTAMP '2024-01-20 00:00:00' THEN 'during' ELSE 'after' END AS period
  FROM parsed
),
m AS (
  SELECT period, 'failed_pct' AS metric,
         round(100.0 * count(*) FILTER (WHERE error_reason IS NOT NULL) / count(*), 6) AS value FROM lab GROUP BY period
  UNION ALL
  SELECT period, 'duplicate_pct', round(100.0 * count(*) FILTER (WHERE copy > 1) / count(*), 6) FROM lab GROUP BY period
  UNION ALL
  SELECT period, 'dlt_pct', round(100.0 * count(*) FILTER (WHERE regexp_matches(topic, '(-dlt|-DLT|\\.DLT|\\.dlt)$'))
         / count(*), 6) FROM lab GROUP BY period
),
b AS (SELECT metric, max(value) FILTER (WHERE period = 'before') AS baseline FROM m GROUP BY metric)
SELECT m.metric, m.period, m.value, b.baseline, round(m.value - b.baseline, 6) AS delta FROM m JOIN b USING (metric)""")
def q_fault_impact(spark, sf_dir):
    from ..functions.columns import is_dlt_topic
    from ..operators import slo

    lab = faults.label_periods(_parsed(spark, sf_dir), "timestamp", "2024-01-10 00:00:00", "2024-01-20 00:00:00")
    n = F.count(F.lit(1))
    # one pass over the input: all three shares per period, then unpivot
    per = lab.groupBy("period").agg(
        F.round(F.lit(100.0) * F.count_if(F.col("error_reason").isNotNull()) / n, 6).alias("failed_pct"),
        F.round(F.lit(100.0) * F.count_if(F.col("copy") > 1) / n, 6).alias("duplicate_pct"),
        F.round(F.lit(100.0) * F.count_if(is_dlt_topic("topic")) / n, 6).alias("dlt_pct"))
    m = per.select("period", F.expr(
        "stack(3, 'failed_pct', failed_pct, 'duplicate_pct', duplicate_pct, 'dlt_pct', dlt_pct) AS (metric, value)"))
    return slo.fault_impact(m).select("metric", "period", "value", "baseline", "delta")


@query("dedup_outbound_ttl", with_(TOPIC_RECORDS) + """,
m AS (SELECT key AS k, {'a': topic, 'b': "partition", 'c': "offset"} AS id, "timestamp" AS ts FROM topic_records),
nxt AS (
  SELECT a.id, arg_min(b.id, {'t': b.ts, 'i': b.id}) AS nid
  FROM m a LEFT JOIN m b ON a.k = b.k AND b.ts >= a.ts + INTERVAL 600 SECOND GROUP BY a.id
),
heads AS (SELECT arg_min(id, {'t': ts, 'i': id}) AS id FROM m GROUP BY k),
chain AS (
  WITH RECURSIVE c(id) AS (
    SELECT id FROM heads
    UNION ALL
    SELECT n.nid FROM c JOIN nxt n ON n.id = c.id WHERE n.nid IS NOT NULL
  ) SELECT id FROM c
)
SELECT key, value, topic, "partition", "offset", "timestamp" FROM topic_records
WHERE key IS NULL OR {'a': topic, 'b': "partition", 'c': "offset"} IN (SELECT id FROM chain)""")
def q_dedup_outbound_ttl(spark, sf_dir):
    return dedup.dedup_outbound_ttl(_records(spark, sf_dir), "key", "timestamp", 600)


@query("result_key", with_(PAYMENT_RECORDS) + """
SELECT key, "offset",
  CASE WHEN json_valid(value) THEN json_extract_string(value, '$.orderId') || '|'
       || md5(coalesce(json_extract_string(value, '$.payload'), '{}')) END AS result_key
FROM payment_records""")
def q_result_key(spark, sf_dir):
    from ..functions.columns import result_key

    r = envelope.parse_envelope(dt.payment_result_records(dt.table(spark, sf_dir, "events")))
    return r.select("key", "offset", F.when(F.col("error_reason").isNull(),
                                            result_key("order_id", "payload")).alias("result_key"))
