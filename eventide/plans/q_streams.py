"""Queries: stored streaming results over several micro-batches.

The input is written block by block (eight days of arrival each) and each block
is one run of the stream, so every query here goes through several
micro-batches and restarts from its checkpoint.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ..functions.columns import ntz_as_utc
from ..functions.json_fields import payment_status
from ..operators import promql
from ..session import scratch_path
from ..sources import driver_tables as tables
from ..streaming.key_store import KeyStore
from ..streaming.layers import UpsertedTable
from ..streaming.metrics_table import MetricsTable
from ..streaming.outbox import OutboxFeed
from ..streaming.saga_timers import saga_timers_stream
from ..streaming.stateful import outbound_ttl_dedup_stream
from ..streaming.window_store import WindowStore
from . import q_fraud, q_hygiene, q_orders, q_saga, q_status
from .q_metrics import _rounded
from .registry import ORACLE, query
from .sql_inputs import PAYMENT_RECORDS, PAYMENT_STATUS, with_

ORIGIN, BLOCK_DAYS, BLOCKS = "2024-01-01 00:00:00", 8, 4


def _fresh(spark, name):
    return scratch_path(spark, "queries", f"{name}-{uuid.uuid4().hex}")


def _block(at, days=BLOCK_DAYS, blocks=BLOCKS):
    """The block that a time of arrival belongs to."""
    passed = F.timestamp_diff("DAY", F.lit(ORIGIN).cast("timestamp_ntz"), at)
    return F.least(F.lit(blocks - 1), F.floor(passed / days)).cast("int")


def _run_blocks(rows, base, block, take, blocks=BLOCKS):
    """Writes block after block; ``take(source)`` gives a started-to-be writer for each run."""
    spark = rows.sparkSession
    placed = rows.withColumn("block", block)
    placed.write.partitionBy("block").parquet(f"{base}/blocks")
    stored = spark.read.schema(placed.schema).parquet(f"{base}/blocks")
    for k in range(blocks):
        stored.where(F.col("block") == k).write.mode("append").parquet(f"{base}/src")
        source = spark.readStream.schema(placed.schema).parquet(f"{base}/src")
        take(source).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()


def _each_batch(rows, base, block, write):
    _run_blocks(rows, base, block, lambda source: source.writeStream.foreachBatch(write))


# ------------------------------------------------------------- window store

_LATER = "CASE WHEN event_id % 50 = 3 THEN 30 WHEN event_id % 50 = 4 THEN 20 ELSE 0 END"
ARRIVED = with_(PAYMENT_RECORDS) + f""",
arrived AS (
  SELECT "timestamp" AS ts, {PAYMENT_STATUS} AS status, "offset" AS event_id,
         least({BLOCKS - 1}, (date_diff('hour', TIMESTAMP '{ORIGIN}', date_trunc('hour', "timestamp" + ({_LATER.replace("event_id", '"offset"')}) * INTERVAL 1 HOUR)) // 24) // {BLOCK_DAYS}) AS block
  FROM payment_records
),
clock AS (SELECT block, max(max(ts)) OVER (ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stream_time FROM arrived GROUP BY block),
win AS (
  SELECT s.size, time_bucket(s.len, ts) AS window_start, time_bucket(s.len, ts) + s.len AS window_end, status, event_id, a.block,
         coalesce(time_bucket(s.len, ts) + INTERVAL 24 HOUR <= stream_time, false) AS late
  FROM arrived a JOIN clock USING (block), (VALUES ('1 hour', INTERVAL 1 HOUR), ('6 hours', INTERVAL 6 HOUR)) s(size, len)
)
"""


def _window_store(spark, sf_dir):
    """Some records arrive 20 hours after their time (within the grace), some 30 (mostly too late)."""
    base = _fresh(spark, "window_store")
    recs = q_status._records(spark, sf_dir).select("key", "value", "offset", "timestamp")
    hours = F.when(F.col("offset") % 50 == 3, 30).when(F.col("offset") % 50 == 4, 20).otherwise(0)
    store = WindowStore(spark, f"{base}/store", max_layers=2)
    arrival = F.expr("timestampadd(HOUR, hours, timestamp)")
    _each_batch(recs.withColumn("hours", hours), base, _block(arrival), lambda batch, k: store.add(batch, k))
    # the last batch is delivered once more
    again = spark.read.parquet(f"{base}/src").where(F.col("block") == BLOCKS - 1)
    if store.add(again, BLOCKS - 1):
        raise RuntimeError("a batch was added twice")
    return store


@query("materialize_windowed_counts", ARRIVED + "SELECT size, window_start, window_end, status, count(*) AS cnt FROM win WHERE NOT late GROUP BY ALL")
def q_materialize_windowed_counts(spark, sf_dir):
    return _window_store(spark, sf_dir).counts()


@query("late_data", ARRIVED + """
SELECT size, window_start, status, event_id AS "offset", CAST(block AS INTEGER) AS block FROM win WHERE late""")
def q_late_data(spark, sf_dir):
    return _window_store(spark, sf_dir).late().select("size", "window_start", "status", "offset", "block")


@query("window_store_fetch", ARRIVED + """
SELECT size, window_start, window_end, status, count(*) AS cnt FROM win WHERE NOT late AND size = '1 hour' AND status = 'CHARGED'
  AND window_start BETWEEN TIMESTAMP '2024-01-10 06:00:00' AND TIMESTAMP '2024-01-11 18:00:00' GROUP BY ALL""")
def q_window_store_fetch(spark, sf_dir):
    return _window_store(spark, sf_dir).fetch("CHARGED", "1 hour", dt.datetime(2024, 1, 10, 6), dt.datetime(2024, 1, 11, 18))


# ------------------------------------------------------- upserted table


@query("upsert_table_stream", """
SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(ts, event_id) AS ts, arg_max(value, event_id) AS value
FROM events GROUP BY user_id""")
def q_upsert_table_stream(spark, sf_dir):
    """The latest event of every user, kept by micro-batches that write only the buckets they touch."""
    base = _fresh(spark, "upsert_table")
    events = tables.table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts", "value")
    kept = UpsertedTable(spark, f"{base}/table", "user_id bigint, event_id bigint, event_type string, ts timestamp_ntz, value double", ["user_id"], ["event_id"], buckets=8, max_layers=2)
    _each_batch(events, base, _block(F.col("ts")), lambda batch, k: kept.upsert(batch.drop("block"), k))
    return kept.read().select("user_id", "event_id", "event_type", "ts", "value")


# ------------------------------------------------------------ key store

_REPLAYED = "SELECT event_id, event_type, least({last}, (date_diff('hour', TIMESTAMP '{origin}', date_trunc('hour', ts)) // 24) // {days}) AS block FROM events".format(
    last=BLOCKS - 1, origin=ORIGIN, days=BLOCK_DAYS)


@query("idempotent_consume_store", f"""
WITH d AS ({_REPLAYED}),
delivered AS (SELECT event_id, event_type, block FROM d UNION ALL SELECT event_id, event_type, {BLOCKS - 1} FROM d WHERE event_id % 7 = 0
              UNION ALL SELECT event_id, event_type, least(block + 1, {BLOCKS - 1}) FROM d WHERE event_id % 11 = 0)
SELECT 'consumer-' || (event_id % 3) AS consumer, 'ev-' || event_id AS message_id, event_type, CAST(min(block) AS INTEGER) AS block
FROM delivered GROUP BY ALL""")
def q_idempotent_consume_store(spark, sf_dir):
    """Messages of which some come again in the next block and some, however old, in the last one."""
    base = _fresh(spark, "key_store")
    events = tables.table(spark, sf_dir, "events")
    first = events.select("event_id", "event_type", _block(F.col("ts")).alias("at"))
    last = F.lit(BLOCKS - 1)
    sent = first.unionByName(first.where(F.col("event_id") % 7 == 0).withColumn("at", last)).unionByName(
        first.where(F.col("event_id") % 11 == 0).withColumn("at", F.least(F.col("at") + 1, last)))
    messages = sent.select(F.concat(F.lit("consumer-"), F.col("event_id") % 3).alias("consumer"), F.concat(F.lit("ev-"), "event_id").alias("message_id"), "event_type", "at")
    store = KeyStore(spark, f"{base}/store", ["consumer", "message_id"], buckets=8, max_layers=2)
    _each_batch(messages, base, F.col("at"), lambda batch, k: store.consume(batch, k, ["event_type"]))
    return store.accepted().select("consumer", "message_id", "event_type", "block")


# ---------------------------------------------------------------- outbox

RUNS = ("2024-01-08 12:00:00", "2024-01-19 06:30:00", "2024-02-03 00:00:00")
_VISIBLE = "occurred_at + CASE WHEN ascii(id) % 4 = 0 THEN INTERVAL 2 HOUR ELSE INTERVAL 0 HOUR END"


@query("outbox_feed_runs", f"""
WITH feed AS ({q_fraud.ORDER_OUTBOX_SQL}),
seen AS (SELECT *, {_VISIBLE} AS visible FROM feed)
SELECT id, aggregate_id AS key, payload AS value, 'order.created' AS topic, occurred_at AS "timestamp",
       CASE {" ".join(f"WHEN visible <= TIMESTAMP '{t}' THEN {k}" for k, t in enumerate(RUNS))} END AS run_id
FROM seen WHERE visible <= TIMESTAMP '{RUNS[-1]}'""")
def q_outbox_feed_runs(spark, sf_dir):
    """Three runs of the change feed over an outbox in which every fourth row or so commits two hours late."""
    base = _fresh(spark, "outbox")
    _, outbox = q_orders._admitted(spark, sf_dir)
    outbox.withColumn("visible", F.expr(_VISIBLE)).write.parquet(f"{base}/outbox")
    stored = spark.read.parquet(f"{base}/outbox")
    feed = OutboxFeed(spark, f"{base}/feed")
    for k, now in enumerate(RUNS):
        feed.publish(stored.where(F.col("visible") <= F.lit(now).cast("timestamp_ntz")).drop("visible"), k)
    header = F.filter("headers", lambda h: h["key"] == "id")[0]["value"].cast("string")
    return feed.records().select(header.alias("id"), "key", "value", "topic", "timestamp", "run_id")


# --------------------------------------------------------------- metrics

METRIC_SQL = with_(PAYMENT_RECORDS) + f""",
r AS (SELECT CAST("partition" AS VARCHAR) AS app, "timestamp" AS ts, {PAYMENT_STATUS} AS status,
        least({BLOCKS - 1}, (date_diff('hour', TIMESTAMP '{ORIGIN}', date_trunc('hour', "timestamp")) // 24) // {BLOCK_DAYS}) AS block FROM payment_records),
t AS (SELECT block, max(ts) AS ts FROM r GROUP BY block),
n AS (SELECT block, app, unnest([{{'metric': 'received', 'n': count(*)}}, {{'metric': 'charged', 'n': count(*) FILTER (WHERE status = 'CHARGED')}},
        {{'metric': 'failed', 'n': count(*) FILTER (WHERE status = 'CHARGE_FAILED')}}, {{'metric': 'unknown', 'n': count(*) FILTER (WHERE status = 'UNKNOWN')}}]) AS m FROM r GROUP BY block, app),
samples AS (SELECT t.ts, m.metric AS metric, app, CAST(sum(m.n) OVER (PARTITION BY m.metric, app ORDER BY n.block) AS DOUBLE) AS value FROM n JOIN t USING (block))
"""


def _metrics(spark, sf_dir):
    base = _fresh(spark, "metrics")
    recs = q_status._records(spark, sf_dir).select(F.col("partition").cast("string").alias("app"), "value", "timestamp")
    kept = MetricsTable(spark, f"{base}/metrics", ["app"], max_layers=2)

    def write(batch, k):
        status = payment_status("value")
        kept.record(batch.withColumn("status", status), k, {
            "received": F.lit(True), "charged": F.col("status") == "CHARGED", "failed": F.col("status") == "CHARGE_FAILED", "unknown": F.col("status") == "UNKNOWN"})

    _each_batch(recs, base, _block(F.col("timestamp")), write)
    return kept.samples()


@query("export_metrics", METRIC_SQL + "SELECT * FROM samples")
def q_export_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir)


@query("exported_counter_rate", METRIC_SQL + """
SELECT ts, metric, app, CASE WHEN lag(ts) OVER w > ts - INTERVAL 10 DAY THEN round((value - lag(value) OVER w) / 864000.0, 6) END AS rate
FROM samples WINDOW w AS (PARTITION BY metric, app ORDER BY ts)""")
def q_exported_counter_rate(spark, sf_dir):
    """Ten-day rates of the exported counters (two samples of eight-day blocks are in range)."""
    return _rounded(promql.counter_rate(_metrics(spark, sf_dir), "10 days", ["metric", "app"]), "rate")


# -------------------------------------------------------------- TTL dedup


@query("dedup_outbound_ttl_stream", "SELECT key AS k, topic, \"partition\", \"offset\", epoch_us(\"timestamp\") AS ts_us FROM (" + ORACLE["dedup_outbound_ttl"] + ")")
def q_dedup_outbound_ttl_stream(spark, sf_dir):
    """The batch operator's result, by keyed state over several micro-batches."""
    base = _fresh(spark, "ttl_dedup")
    recs = q_hygiene._records(spark, sf_dir).select("key", "topic", "partition", "offset", ntz_as_utc("timestamp").alias("at"), "timestamp")

    def take(source):
        return outbound_ttl_dedup_stream(source, "key", "at", 600).writeStream.format("parquet").option("path", f"{base}/out")

    _run_blocks(recs, base, _block(F.col("timestamp")), take)
    return spark.read.parquet(f"{base}/out")


# ------------------------------------------------------------ saga timers

DELAY_MS, HALVES, HALF_DAYS = 60_000, 2, 16
TIMERS_SQL = q_saga.TRANSITIONS.rstrip() + f""",
fin AS (SELECT order_id, min(seq) AS last_seq FROM transitions WHERE state IN ('COMPLETED', 'COMPENSATED') GROUP BY order_id),
tr AS (SELECT t.* FROM transitions t LEFT JOIN fin USING (order_id) WHERE seq <= coalesce(last_seq, seq)),
placed AS (SELECT *, least({HALVES - 1}, (date_diff('hour', TIMESTAMP '{ORIGIN}', date_trunc('hour', ts)) // 24) // {HALF_DAYS}) AS block FROM known),
mark AS (SELECT block, max(epoch_us(max(ts)) // 1000) OVER (ORDER BY block) - {DELAY_MS} AS ms FROM placed GROUP BY block),
s AS (
  SELECT order_id, arg_max(state, seq) AS state, arg_max(seq, seq) AS seq, max(ts) AS ts,
    arg_max_null(failed_state, seq) FILTER (WHERE failed_state IS NOT NULL) AS failed_state,
    arg_max_null(ref_id, seq) FILTER (WHERE event_type = 'PaymentCompleted') AS payment_id,
    arg_max_null(ref_id, seq) FILTER (WHERE event_type = 'InventoryReserved') AS reservation_id,
    arg_max_null(ref_id, seq) FILTER (WHERE event_type = 'ShippingCompleted') AS shipping_id,
    arg_max_null(reason, seq) FILTER (WHERE failed_state IS NOT NULL) AS failure_reason
  FROM tr GROUP BY order_id
),
own AS (
  SELECT s.*, p.block, s.state LIKE '%_PENDING' AS pending,
    CASE WHEN s.state LIKE '%_PENDING' THEN 10 WHEN s.state = 'COMPENSATING' THEN 5 END AS minutes
  FROM s JOIN (SELECT DISTINCT order_id, seq, block FROM placed) p USING (order_id, seq)
),
fired AS (
  SELECT own.*, CASE WHEN minutes IS NULL THEN 0 ELSE ({HALVES - 1} - own.block)
      + CASE WHEN epoch_us(ts) // 1000 + minutes * 60000 + 1 < mark.ms THEN 1 ELSE 0 END END AS fires,
    (SELECT max(ms) FROM mark) AS last_ms
  FROM own JOIN mark USING (block)
),
ended AS (
  SELECT order_id, CASE WHEN fires > 0 THEN 'COMPENSATING' ELSE state END AS state,
    CASE WHEN fires > 0 AND pending THEN replace(state, '_PENDING', '_FAILED') ELSE failed_state END AS failed_state,
    payment_id, reservation_id, shipping_id,
    CASE WHEN fires > 0 AND pending THEN 'Timeout waiting for ' || state || ' response' ELSE failure_reason END AS failure_reason,
    CAST(CASE WHEN pending AND fires > 0 THEN fires - 1 ELSE fires END AS INTEGER) AS retry_count, state AS before, fires, pending,
    CASE WHEN fires > 0 THEN last_ms * 1000 ELSE epoch_us(ts) END AS at_us
  FROM fired
)
"""


def _timers(spark, sf_dir):
    """Each half's sagas meet the sweep at its own end (by the watermark) and that of the later half."""
    base = _fresh(spark, "saga_timers")
    ev = q_saga._events(spark, sf_dir).select("order_id", "seq", "ts", "event_type", "ref_id", "reason")

    def take(source):
        def write(batch, k):
            batch.write.mode("overwrite").parquet(f"{base}/out/batch_id={k}")

        return saga_timers_stream(source, "at").writeStream.outputMode("update").foreachBatch(write)

    _run_blocks(ev.withColumn("at", ntz_as_utc("ts")), base, _block(F.col("ts"), HALF_DAYS, HALVES), take, HALVES)
    return spark.read.parquet(f"{base}/out")


@query("saga_timers_state", TIMERS_SQL + """
SELECT order_id, state, failed_state, payment_id, reservation_id, shipping_id, failure_reason, retry_count, at_us FROM ended""")
def q_saga_timers_state(spark, sf_dir):
    rows = _timers(spark, sf_dir).where(F.col("kind") == "state")
    names = ["state", "failed_state", "payment_id", "reservation_id", "shipping_id", "failure_reason", "retry_count", "at_us"]
    return rows.groupBy("order_id").agg(F.max_by(F.struct(*names), "n").alias("r")).select("order_id", *(f"r.{n}" for n in names))


@query("saga_timers_sent", TIMERS_SQL + """,
sweeps AS (SELECT e.*, unnest(range(1, retry_count + 1)) AS k FROM ended e)
SELECT order_id, 'status' AS kind, NULL AS type, NULL AS ref_id, failed_state AS status, failure_reason FROM ended WHERE fires > 0 AND pending
UNION ALL SELECT order_id, 'command', 'CANCEL', NULL, NULL, failure_reason FROM ended WHERE fires > 0 AND pending
UNION ALL SELECT order_id, 'command', 'REFUND', payment_id, NULL, failure_reason FROM ended
  WHERE fires > 0 AND pending AND before IN ('INVENTORY_PENDING', 'SHIPPING_PENDING') AND payment_id IS NOT NULL
UNION ALL SELECT order_id, 'command', 'RELEASE', reservation_id, NULL, failure_reason FROM ended
  WHERE fires > 0 AND pending AND before = 'SHIPPING_PENDING' AND reservation_id IS NOT NULL
UNION ALL SELECT order_id, 'command', 'CANCEL', NULL, NULL, 'Retry compensation attempt #' || k FROM sweeps
UNION ALL SELECT order_id, 'command', 'REFUND', payment_id, NULL, 'Retry compensation attempt #' || k FROM sweeps WHERE payment_id IS NOT NULL
UNION ALL SELECT order_id, 'command', 'RELEASE', reservation_id, NULL, 'Retry compensation attempt #' || k FROM sweeps WHERE reservation_id IS NOT NULL
UNION ALL SELECT order_id, 'status', NULL, NULL, coalesce(failed_state, CASE state WHEN 'COMPLETED' THEN 'COMPLETED' ELSE 'CANCELLED' END),
  CASE WHEN failed_state IS NOT NULL THEN reason WHEN state = 'COMPENSATED' THEN 'Order cancelled after compensation' END
  FROM tr WHERE failed_state IS NOT NULL OR state IN ('COMPLETED', 'COMPENSATED')""")
def q_saga_timers_sent(spark, sf_dir):
    """Status rows of all changes, and the commands of timers (those of events are compensation_plan's)."""
    rows = _timers(spark, sf_dir)
    timer = F.col("failure_reason").startswith("Timeout waiting") | F.col("failure_reason").startswith("Retry compensation")
    return rows.where((F.col("kind") == "status") | ((F.col("kind") == "command") & timer)).select("order_id", "kind", "type", "ref_id", "status", "failure_reason")
