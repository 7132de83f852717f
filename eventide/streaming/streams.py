"""Structured Streaming forms of the operators.

* ``status_counts_stream`` - the windowed status topology: event-time
  watermark, tumbling window, state in the RocksDB store; one query per
  window size because Spark keeps one watermark per query.  Kafka's implicit
  grace (24 h - window) maps to the watermark delay.
* ``dedup_stream`` - ``dropDuplicatesWithinWatermark`` for the consumer-side
  idempotency keys (state is bounded by the watermark horizon).
* ``pending_timeouts_stream`` - request stream left-outer-joined with the
  response stream within the timeout; unmatched requests come out once the
  watermark passes, which is the streaming form of ``stuck_pending``.
* ``run_available_now`` - run a query over everything available and stop,
  writing to a Parquet folder below the shared checkpoint directory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ntz_as_utc
from ..functions.json_fields import payment_status
from ..session import scratch_path

DAY_SECONDS = 86_400
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": DAY_SECONDS}


def interval_seconds(text: str) -> int:
    """Seconds of an interval such as ``6 hours`` or ``1 hour 30 minutes``."""
    words = text.lower().split()
    if not words or len(words) % 2:
        raise ValueError(f"not an interval: {text!r}")
    return sum(int(n) * UNIT_SECONDS[unit.rstrip("s")] for n, unit in zip(words[::2], words[1::2], strict=True))


def default_grace(size: str) -> str:
    """24 h less the window, and none for windows of a day or more."""
    return f"{max(0, DAY_SECONDS - interval_seconds(size))} seconds"


def event_time(df: DataFrame, ts: str, out: str = "event_time") -> DataFrame:
    """Watermarks need TIMESTAMP (not NTZ); wall-clock NTZ is read as UTC."""
    dtype = dict(df.dtypes)[ts]
    col = ntz_as_utc(ts) if dtype == "timestamp_ntz" else F.col(ts)
    return df.withColumn(out, col)


def status_counts_stream(records: DataFrame, size: str = "1 hour", ts: str = "timestamp",
                         grace: str | None = None) -> DataFrame:
    """Streaming tumbling counts per status (append mode emits closed windows)."""
    x = event_time(records, ts).withColumn("status", payment_status("value"))
    x = x.withWatermark("event_time", grace or default_grace(size))
    return x.groupBy(F.window("event_time", size).alias("w"), "status").agg(F.count(F.lit(1)).alias("cnt")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "status", "cnt")


def running_status_count_stream(records: DataFrame) -> DataFrame:
    """Running count per status (update mode: the changelog)."""
    return records.select(payment_status("value").alias("status")).groupBy("status").agg(
        F.count(F.lit(1)).alias("cnt"))


def saga_state_stream(events: DataFrame) -> DataFrame:
    """Saga state per order as a streaming aggregation (update mode).

    ``operators.saga.saga_state`` is one ``groupBy(order_id)`` of
    ``min_by``/``max_by`` buffers, so it runs unchanged on a stream: the state
    store keeps one aggregation buffer per order and every micro-batch emits
    the orders it touched."""
    from ..operators.saga import saga_state

    return saga_state(events)


def dedup_stream(df: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Drop records whose keys were seen within the watermark ``delay``; records
    later than that are dropped as late, so it must cover the longest replay."""
    x = event_time(df, ts)
    return x.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(keys)


def pending_timeouts_stream(requests: DataFrame, responses: DataFrame, key: str = "order_id",
                            ts: str = "ts", timeout: str = "10 minutes",
                            delay: str = "1 minute") -> DataFrame:
    """Requests without a response within ``timeout`` (left outer interval join).

    Matched requests are dropped; unmatched ones are emitted once the
    watermark passes request time + timeout."""
    rq = event_time(requests, ts, "rq_time").withWatermark("rq_time", delay).alias("rq")
    rs = event_time(responses, ts, "rs_time").select(
        F.col(key).alias("rs_key"), "rs_time").withWatermark("rs_time", delay).alias("rs")
    cond = (F.col(f"rq.{key}") == F.col("rs.rs_key")) & (F.col("rs.rs_time") > F.col("rq.rq_time")) & (
        F.col("rs.rs_time") <= F.col("rq.rq_time") + F.expr(f"INTERVAL {timeout}"))
    j = rq.join(rs, cond, "leftOuter")
    return j.where(F.col("rs_key").isNull()).select("rq.*")


def timeout_failures(unmatched: DataFrame, state: str = "state") -> DataFrame:
    """Unmatched *_PENDING requests -> the failure they turn into (as ``stuck_pending``)."""
    from ..functions import codes
    from ..functions.columns import case_map
    from ..operators.saga import PENDING_TO_FAILED

    return unmatched.drop("failed_state", "failure_reason").select(
        "*", case_map(state, PENDING_TO_FAILED).alias("failed_state"),
        F.format_string(codes.REASON_TIMEOUT, F.col(state)).alias("failure_reason"))


def read_state_store(spark, checkpoint: str, operator_id: int = 0) -> DataFrame:
    """Inspect a streaming query's state (e.g. the window-count store)."""
    return spark.read.format("statestore").option("operatorId", operator_id).load(checkpoint)


def run_available_now(df: DataFrame, name: str, mode: str = "append", fmt: str = "parquet",
                      root: str | None = None) -> str:
    """Run a streaming query over all available input, wait, return the output path."""
    spark = df.sparkSession
    base = root or scratch_path(spark, "streams", name)
    out, ckpt = f"{base}/out", f"{base}/checkpoint"
    if mode in ("update", "complete") and fmt == "parquet":
        # changelog sink: each micro-batch's updated rows land in their own
        # batch folder, so a replayed batch overwrites itself (idempotent)
        def write(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

        q = df.writeStream.foreachBatch(write).outputMode(mode).option(
            "checkpointLocation", ckpt).trigger(availableNow=True).start()
    elif fmt == "memory":
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option(
            "checkpointLocation", ckpt).trigger(availableNow=True).start()
    else:
        q = df.writeStream.format(fmt).outputMode(mode).option("path", out).option(
            "checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    return out
