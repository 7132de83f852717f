"""Queries: histograms, quantiles, counters, ratios, canary."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codes
from ..functions.json_fields import payment_status
from ..operators import faults, metrics, promql, saga
from ..sources import driver_tables as dt
from . import q_saga
from .registry import query
from .sql_inputs import COUNTER_SAMPLES, LATENCY_SAMPLES, PAYMENT_RECORDS, PAYMENT_STATUS, TOPIC_RECORDS, with_

BOUNDS = metrics.default_bounds()
_BOUNDS_SQL = ", ".join(f"CAST({b} AS DOUBLE)" for b in BOUNDS)


def _latency(spark, sf_dir):
    return dt.latency_samples(dt.table(spark, sf_dir, "lineitem"))


HIST_SQL = with_(LATENCY_SAMPLES) + f""",
bounds AS (SELECT unnest([{_BOUNDS_SQL}]) AS le),
hb AS (
  SELECT service, b.le, count(*) FILTER (WHERE latency_ms <= b.le) AS cnt
  FROM latency_samples, bounds b GROUP BY service, b.le
  UNION ALL
  SELECT service, CAST('inf' AS DOUBLE) AS le, count(latency_ms) AS cnt FROM latency_samples GROUP BY service
)
"""


@query("latency_histogram", HIST_SQL + "SELECT * FROM hb")
def q_latency_histogram(spark, sf_dir):
    return metrics.latency_histogram(_latency(spark, sf_dir), "latency_ms", ["service"], BOUNDS)


def _quantile_sql(q: float) -> str:
    return HIST_SQL + f""",
hx AS (
  SELECT *, lag(le) OVER w AS prev_le, coalesce(lag(cnt) OVER w, 0) AS prev_cnt,
         max(cnt) FILTER (WHERE le = CAST('inf' AS DOUBLE)) OVER (PARTITION BY service) AS total
  FROM hb WINDOW w AS (PARTITION BY service ORDER BY le)
),
hy AS (
  SELECT *, CASE WHEN prev_le IS NULL AND le > 0 THEN 0.0 ELSE prev_le END AS lower FROM hx
),
hit AS (
  SELECT service, le,
    CASE WHEN le = CAST('inf' AS DOUBLE) THEN prev_le
         WHEN prev_le IS NULL AND le <= 0 THEN le
         ELSE lower + (le - lower) * ((CAST({q} AS DOUBLE) * total - prev_cnt) / (cnt - prev_cnt)) END AS v
  FROM hy WHERE cnt >= CAST({q} AS DOUBLE) * total AND total > 0
)
SELECT service, round(arg_min(v, le), 6) AS quantile FROM hit GROUP BY service"""


def _quantile(spark, sf_dir, q):
    h = metrics.latency_histogram(_latency(spark, sf_dir), "latency_ms", ["service"], BOUNDS)
    return metrics.histogram_quantile(h, q, ["service"]).select("service", F.round("quantile", 6).alias("quantile"))


@query("histogram_quantile_p95", _quantile_sql(0.95))
def q_hq95(spark, sf_dir):
    return _quantile(spark, sf_dir, 0.95)


@query("histogram_quantile_p50", _quantile_sql(0.5))
def q_hq50(spark, sf_dir):
    return _quantile(spark, sf_dir, 0.5)


def _rounded(df, col):
    """Results are compared to 6 places; rounding is the last step."""
    return df.withColumn(col, F.round(col, 6))


def _samples(spark, sf_dir):
    return dt.counter_samples(dt.table(spark, sf_dir, "events"))


INCREASE_SQL = with_(COUNTER_SAMPLES) + """,
d AS (
  SELECT *, CASE WHEN lag(value) OVER w IS NULL THEN NULL WHEN value < lag(value) OVER w THEN value
                 ELSE value - lag(value) OVER w END AS delta
  FROM counter_samples WINDOW w AS (PARTITION BY metric, app ORDER BY ts)
),
inc AS (
  SELECT ts, metric, app,
    CASE WHEN count(*) OVER r >= 2 THEN
      coalesce(sum(delta) OVER r, 0) - coalesce(first_value(delta) OVER r, 0) END AS increase
  FROM d WINDOW r AS (PARTITION BY metric, app ORDER BY ts
                      RANGE BETWEEN INTERVAL 899999999 MICROSECONDS PRECEDING AND CURRENT ROW)
)
"""


@query("counter_increase", INCREASE_SQL + "SELECT ts, metric, app, round(increase, 6) AS increase FROM inc")
def q_counter_increase(spark, sf_dir):
    return _rounded(promql.counter_increase(_samples(spark, sf_dir), "15 minutes", ["metric", "app"]), "increase")


@query("counter_rate", INCREASE_SQL + "SELECT ts, metric, app, round(increase / CAST(900.0 AS DOUBLE), 6) AS rate FROM inc")
def q_counter_rate(spark, sf_dir):
    return _rounded(promql.counter_rate(_samples(spark, sf_dir), "15 minutes", ["metric", "app"]), "rate")


@query("counter_rate_by_app", INCREASE_SQL + """
SELECT ts, app, round(sum(increase / CAST(900.0 AS DOUBLE)), 6) AS rate
FROM inc GROUP BY ts, app""")
def q_counter_rate_by_app(spark, sf_dir):
    r = promql.counter_rate(_samples(spark, sf_dir), "15 minutes", ["metric", "app"])
    return _rounded(promql.sum_by(r, "rate", ["app"]), "rate")


@query("latest_points", with_(COUNTER_SAMPLES) + """
SELECT ts, metric, app, value FROM (
  SELECT *, row_number() OVER (PARTITION BY metric, app ORDER BY ts DESC) AS rn FROM counter_samples)
WHERE rn <= 30""")
def q_latest_points(spark, sf_dir):
    return promql.latest_points(_samples(spark, sf_dir), ["metric", "app"], 30)


@query("success_rate", q_saga.TRANSITIONS + """
SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' AS window_end,
       count(*) FILTER (WHERE event_type = 'ShippingCompleted') AS succeeded,
       count(*) FILTER (WHERE failed_state IS NOT NULL) AS failed,
       round(100.0 * count(*) FILTER (WHERE event_type = 'ShippingCompleted')
             / greatest(count(*) FILTER (WHERE event_type = 'ShippingCompleted')
                        + count(*) FILTER (WHERE failed_state IS NOT NULL), 1), 6) AS success_rate_pct
FROM transitions GROUP BY 1, 2""")
def q_success_rate(spark, sf_dir):
    t = q_saga._transitions(spark, sf_dir)
    return metrics.success_rate(t, F.col("event_type") == "ShippingCompleted", F.col("failed_state").isNotNull(),
                                "ts", "1 day")


@query("availability", with_(PAYMENT_RECORDS) + f"""
SELECT time_bucket(INTERVAL '1 minute', "timestamp") AS window_start,
       time_bucket(INTERVAL '1 minute', "timestamp") + INTERVAL '1 minute' AS window_end,
       count(*) FILTER (WHERE status = 'CHARGED') AS successful, count(*) AS total,
       round(100.0 * count(*) FILTER (WHERE status = 'CHARGED') / count(*), 6) AS availability_pct
FROM (SELECT *, {PAYMENT_STATUS} AS status FROM payment_records) GROUP BY 1, 2""")
def q_availability(spark, sf_dir):
    r = dt.payment_result_records(dt.table(spark, sf_dir, "events"))
    return metrics.availability(r, payment_status("value") == codes.PAYMENT_OK, "timestamp", "1 minute")


def _canary(spark, sf_dir):
    r = dt.payment_result_records(dt.table(spark, sf_dir, "events"))
    return faults.canary_split(r, 0.1, "key")


CANARY_SQL = with_(PAYMENT_RECORDS) + f""",
canary AS (
  SELECT *, CASE WHEN CAST(('0x' || substr(md5(key), 1, 8)) AS BIGINT) % 10000 < 1000 THEN 'canary' ELSE 'main' END AS channel,
         {PAYMENT_STATUS} AS status
  FROM payment_records
)
"""


@query("canary_split", CANARY_SQL + """
SELECT key, channel, CASE channel WHEN 'canary' THEN 'payment.requested.canary' ELSE 'payment.requested' END AS target_topic
FROM canary""")
def q_canary_split(spark, sf_dir):
    return _canary(spark, sf_dir).select("key", "channel", "target_topic")


@query("canary_comparison", CANARY_SQL + """,
g AS (
  SELECT time_bucket(INTERVAL '1 hour', "timestamp") AS window_start, channel, count(*) AS requests,
         count(*) FILTER (WHERE status <> 'CHARGED') AS failures
  FROM canary GROUP BY 1, 2
)
SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, channel, requests, failures,
       round(requests / CAST(3600 AS BIGINT), 6) AS rate_per_sec,
       round(100.0 * failures / requests, 6) AS error_rate_pct,
       round(100.0 * requests / sum(requests) OVER (PARTITION BY window_start), 6) AS share_pct
FROM g""")
def q_canary_comparison(spark, sf_dir):
    c = _canary(spark, sf_dir)
    return metrics.canary_comparison(c, "channel", "timestamp", payment_status("value") == codes.PAYMENT_OK, "1 hour")


SLO_AS_OF = "2024-01-15 12:34:00"


@query("slo_summary", q_saga.TRANSITIONS.replace("WITH ", "WITH " + with_(PAYMENT_RECORDS)[5:] + "," + with_(TOPIC_RECORDS)[5:] + ",", 1) + f""",
d AS (SELECT CAST(epoch_us(ts) - epoch_us(created_at) AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS v
      FROM transitions WHERE event_type = 'ShippingCompleted'
        AND ts > TIMESTAMP '{SLO_AS_OF}' - INTERVAL 5 MINUTE AND ts <= TIMESTAMP '{SLO_AS_OF}'),
bounds AS (SELECT unnest([""" + ", ".join(f"CAST({b} AS DOUBLE)" for b in metrics.default_bounds(0, 8)) + f"""]) AS le),
hb AS (
  SELECT b.le, count(*) FILTER (WHERE v <= b.le) AS cnt FROM d, bounds b GROUP BY b.le
  UNION ALL SELECT CAST('inf' AS DOUBLE), count(v) FROM d
),
hx AS (
  SELECT *, lag(le) OVER (ORDER BY le) AS prev_le, coalesce(lag(cnt) OVER (ORDER BY le), 0) AS prev_cnt,
         max(cnt) FILTER (WHERE le = CAST('inf' AS DOUBLE)) OVER () AS total FROM hb
),
hy AS (SELECT *, CASE WHEN prev_le IS NULL AND le > 0 THEN 0.0 ELSE prev_le END AS lower FROM hx),
p95 AS (
  SELECT arg_min(CASE WHEN le = CAST('inf' AS DOUBLE) THEN prev_le
         ELSE lower + (le - lower) * ((CAST(0.95 AS DOUBLE) * total - prev_cnt) / (cnt - prev_cnt)) END, le) AS q
  FROM hy WHERE cnt >= CAST(0.95 AS DOUBLE) * total AND total > 0
),
hour AS (
  SELECT count(*) FILTER (WHERE {PAYMENT_STATUS} = 'CHARGED') AS ok, count(*) FILTER (WHERE {PAYMENT_STATUS} = 'CHARGE_FAILED') AS bad
  FROM payment_records WHERE time_bucket(INTERVAL '1 hour', "timestamp") = time_bucket(INTERVAL '1 hour', TIMESTAMP '{SLO_AS_OF}')
),
dl AS (SELECT count(*) AS n FROM topic_records WHERE regexp_matches(topic, '[-.](dlt|DLT)$'))
SELECT round(coalesce((SELECT q FROM p95), 0.0), 6) AS p95_latency_ms,
       CAST(coalesce((SELECT n FROM dl), 0) AS BIGINT) AS dlt_count,
       CAST((SELECT CASE WHEN ok + bad = 0 THEN 0 ELSE bad * 100 // (ok + bad) END FROM hour) AS BIGINT) AS slo_burn_rate_1h""")
def q_slo_summary(spark, sf_dir):
    """p95 saga time of the last 5 minutes, dead letters in all, burn rate of the current hour."""
    from ..functions.columns import is_dlt_topic
    from ..operators import slo, status_counts

    events = dt.table(spark, sf_dir, "events")
    as_of = F.lit(SLO_AS_OF).cast("timestamp_ntz")
    d = saga.recent_durations(dt.saga_events(events), as_of - F.expr("INTERVAL 5 MINUTES"), as_of)
    h = metrics.latency_histogram(d, "duration_ms", None, metrics.default_bounds(0, 8))
    p95 = metrics.histogram_quantile(h, 0.95).select(F.round("quantile", 6).alias("quantile"))
    dlt = metrics.dlt_totals(dt.topic_records(events), is_dlt_topic("topic"))
    records = status_counts.records_of_windows(dt.payment_result_records(events), "1 hour", SLO_AS_OF, SLO_AS_OF)
    burn = status_counts.burn_rate_at(status_counts.status_count_window(records, "1 hour"), SLO_AS_OF)
    return slo.slo_summary(p95, dlt, burn)


def _hq_sql(src: str, grp: str, q: float, bounds: list[float], name: str) -> str:
    """SQL: histogram_quantile over cumulative buckets of ``src(grp, v)``."""
    b = ", ".join(f"CAST({x} AS DOUBLE)" for x in bounds)
    return f"""
{name}_b AS (SELECT unnest([{b}]) AS le),
{name}_h AS (
  SELECT {grp}, bb.le, count(*) FILTER (WHERE v <= bb.le) AS cnt FROM {src}, {name}_b bb GROUP BY {grp}, bb.le
  UNION ALL SELECT {grp}, CAST('inf' AS DOUBLE), count(v) FROM {src} GROUP BY {grp}
),
{name}_x AS (
  SELECT *, lag(le) OVER w AS prev_le, coalesce(lag(cnt) OVER w, 0) AS prev_cnt,
         max(cnt) FILTER (WHERE le = CAST('inf' AS DOUBLE)) OVER (PARTITION BY {grp}) AS total
  FROM {name}_h WINDOW w AS (PARTITION BY {grp} ORDER BY le)
),
{name}_y AS (SELECT *, CASE WHEN prev_le IS NULL AND le > 0 THEN 0.0 ELSE prev_le END AS lower FROM {name}_x),
{name} AS (
  SELECT {grp}, round(arg_min(CASE WHEN le = CAST('inf' AS DOUBLE) THEN prev_le
         ELSE lower + (le - lower) * ((CAST({q} AS DOUBLE) * total - prev_cnt) / (cnt - prev_cnt)) END, le), 6) AS q
  FROM {name}_y WHERE cnt >= CAST({q} AS DOUBLE) * total AND total > 0 GROUP BY {grp}
)"""


_CB = metrics.default_bounds(0, 8)


@query("canary_latency", q_saga.TRANSITIONS + """,
dur AS (
  SELECT CASE WHEN CAST(('0x' || substr(md5(order_id), 1, 8)) AS BIGINT) % 10000 < 1000 THEN 'canary' ELSE 'main' END
           AS channel,
         CAST(epoch_us(ts) - epoch_us(created_at) AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS v
  FROM transitions WHERE event_type = 'ShippingCompleted'
),""" + _hq_sql("dur", "channel", 0.5, _CB, "p50") + "," + _hq_sql("dur", "channel", 0.95, _CB, "p95") + """
SELECT channel, p50.q AS p50_ms, p95.q AS p95_ms FROM p50 JOIN p95 USING (channel)""")
def q_canary_latency(spark, sf_dir):
    """Saga completion latency p50/p95 per canary channel (bucketed, PromQL style)."""
    d = saga.processing_durations(q_saga._transitions(spark, sf_dir))
    c = faults.canary_split(d, 0.1, "order_id")
    h = metrics.latency_histogram(c, "duration_ms", ["channel"], _CB)
    return _both(metrics.histogram_quantiles(h, P50_P95, ["channel"]), "channel")


P50_P95 = {"p50_ms": 0.5, "p95_ms": 0.95}


def _both(df, *keys):
    return df.select(*keys, *[F.round(c, 6).alias(c) for c in P50_P95])


@query("canary_latency_windows", q_saga.TRANSITIONS + """,
dur AS (
  SELECT {'w': time_bucket(INTERVAL '6 hours', ts),
          'c': CASE WHEN CAST(('0x' || substr(md5(order_id), 1, 8)) AS BIGINT) % 10000 < 1000 THEN 'canary' ELSE 'main' END} AS grp,
         CAST(epoch_us(ts) - epoch_us(created_at) AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS v
  FROM transitions WHERE event_type = 'ShippingCompleted'
),""" + _hq_sql("dur", "grp", 0.5, _CB, "p50") + "," + _hq_sql("dur", "grp", 0.95, _CB, "p95") + """
SELECT grp.w AS window_start, grp.c AS channel, p50.q AS p50_ms, p95.q AS p95_ms FROM p50 JOIN p95 USING (grp)""")
def q_canary_latency_windows(spark, sf_dir):
    """Completion latency p50/p95 per window and channel, both from one histogram pass."""
    d = saga.processing_durations(q_saga._transitions(spark, sf_dir), ("order_id", "ts"))
    c = faults.canary_split(d, 0.1, "order_id").withColumn("window_start", F.window("ts", "6 hours")["start"])
    h = metrics.latency_histogram(c, "duration_ms", ["window_start", "channel"], _CB)
    return _both(metrics.histogram_quantiles(h, P50_P95, ["window_start", "channel"]), "window_start", "channel")


@query("canary_share_5m", CANARY_SQL + """,
m AS (SELECT time_bucket(INTERVAL '1 minute', "timestamp") AS w, channel, count(*) AS n FROM canary GROUP BY 1, 2),
e AS (SELECT w + INTERVAL 1 MINUTE * k AS eval_time, channel, n FROM m, (SELECT unnest(generate_series(1, 5)) AS k))
SELECT eval_time, CAST(coalesce(sum(n) FILTER (WHERE channel = 'main'), 0) AS BIGINT) AS main,
       CAST(coalesce(sum(n) FILTER (WHERE channel = 'canary'), 0) AS BIGINT) AS canary,
       round(coalesce(sum(n) FILTER (WHERE channel = 'main'), 0) / CAST(300 AS DOUBLE), 6) AS main_rate,
       round(coalesce(sum(n) FILTER (WHERE channel = 'canary'), 0) / CAST(300 AS DOUBLE), 6) AS canary_rate,
       round(100.0 * coalesce(sum(n) FILTER (WHERE channel = 'canary'), 0) / CAST(sum(n) AS DOUBLE), 6) AS canary_share_pct
FROM e GROUP BY eval_time""")
def q_canary_share_5m(spark, sf_dir):
    """Request rates of the channels and the canary's share over the last 5 minutes, minute by minute."""
    return metrics.trailing_share(_canary(spark, sf_dir), "channel", "timestamp")


GRID_SQL = INCREASE_SQL.rstrip() + """,
t AS (SELECT unnest(generate_series(date_trunc('day', min(ts)), max(ts) + INTERVAL 2 DAY, INTERVAL 6 HOUR)) AS e FROM d),
grid AS (
  SELECT e AS ts, metric, app, (coalesce(sum(delta), 0) - coalesce(arg_min_null(delta, d.ts), 0)) / CAST(86400.0 AS DOUBLE) AS rate
  FROM t JOIN d ON d.ts > e - INTERVAL 24 HOUR AND d.ts <= e GROUP BY e, metric, app HAVING count(*) >= 2
)
"""


@query("counter_rate_grid", GRID_SQL + "SELECT ts, metric, app, round(rate, 9) AS rate FROM grid")
def q_counter_rate_grid(spark, sf_dir):
    """Daily rates at every sixth hour, the same times for all series."""
    return _grid(spark, sf_dir).withColumn("rate", F.round("rate", 9))


def _grid(spark, sf_dir):
    return promql.counter_rate_grid(_samples(spark, sf_dir), "24 hours", "6 hours", ["metric", "app"])


@query("success_rate_of_rates", GRID_SQL + """,
r AS (SELECT ts, app, max(rate) FILTER (WHERE metric = 'events_purchase_total') AS ok, max(rate) FILTER (WHERE metric = 'events_error_total') AS bad
      FROM grid WHERE metric IN ('events_purchase_total', 'events_error_total') GROUP BY ts, app)
SELECT ts, round(100.0 * sum(ok) / greatest(sum(ok + bad), CAST(1e-9 AS DOUBLE)), 6) AS success_rate_pct
FROM r GROUP BY ts HAVING sum(ok) IS NOT NULL AND sum(ok + bad) IS NOT NULL""")
def q_success_rate_of_rates(spark, sf_dir):
    """The rate form of the success rate, over counter samples, with the floor under the denominator."""
    return _rounded(promql.success_rate_of_rates(_grid(spark, sf_dir), "events_purchase_total", "events_error_total", ["app"]), "success_rate_pct")


_STAGE_CASES = {
    "payment-svc": ("'OrderCreated'", "'PaymentCompleted', 'PaymentFailed'"),
    "inventory-svc": ("'PaymentCompleted', 'InventoryRequested'", "'InventoryReserved', 'InventoryFailed'"),
    "shipping-svc": ("'InventoryReserved', 'ShippingRequested'", "'ShippingCompleted', 'ShippingFailed'"),
}
STAGE_SQL = q_saga.TRANSITIONS + ",\nstage AS (" + " UNION ALL ".join(f"""
  SELECT order_id, seq, '{name}' AS service, CAST(epoch_us(ts) - epoch_us(since) AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS v FROM (
    SELECT *, last_value(CASE WHEN event_type IN ({ask}) THEN ts END IGNORE NULLS)
      OVER (PARTITION BY order_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS since FROM transitions)
  WHERE event_type IN ({answer}) AND since <= ts""" for name, (ask, answer) in _STAGE_CASES.items()) + ")"


@query("stage_durations", STAGE_SQL + "SELECT order_id, seq, service, v AS duration_ms FROM stage")
def q_stage_durations(spark, sf_dir):
    return saga.stage_durations(q_saga._transitions(spark, sf_dir))


@query("message_processing_time", STAGE_SQL + ",\ncounts AS (SELECT service, count(*) AS messages FROM stage GROUP BY service),"
       + _hq_sql("stage", "service", 0.5, _CB, "p50") + "," + _hq_sql("stage", "service", 0.95, _CB, "p95") + """
SELECT service, messages, p50.q AS p50_ms, p95.q AS p95_ms FROM counts JOIN p50 USING (service) JOIN p95 USING (service)""")
def q_message_processing_time(spark, sf_dir):
    """Handling time of each service's messages: their number, p50 and p95 (bucketed), from one histogram."""
    h = metrics.latency_histogram(saga.stage_durations(q_saga._transitions(spark, sf_dir)), "duration_ms", ["service"], _CB)
    counted = metrics.histogram_quantiles(h, P50_P95, ["service"])
    total = h.where(F.col("le") == F.lit(metrics.INF)).select("service", F.col("cnt").alias("messages"))
    return _both(counted.join(total, "service"), "service", "messages")
