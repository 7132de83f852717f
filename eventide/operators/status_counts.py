"""Payment-status topology: status extraction, running and tumbling counts,
burn rates.

The reference re-keys every record by status and counts (running, 1 h, 6 h).
In Spark the re-key is the shuffle of ``groupBy``; because the key has only a
handful of values, every hot key is combined map-side first (partial
aggregation in ``HashAggregate``), so only one row per (task, status, window)
crosses the network whatever the input volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.json_fields import payment_status


def with_payment_status(records: DataFrame, value: str = "value") -> DataFrame:
    """Add ``status`` extracted from the envelope in ``value``."""
    return records.withColumn("status", payment_status(value))


def status_count(records: DataFrame, value: str = "value") -> DataFrame:
    """Running count per status (the changelog's latest value per key)."""
    return (
        records.select(payment_status(value).alias("status"))
        .groupBy("status")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def status_count_window(
    records: DataFrame, size: str = "1 hour", ts: str = "timestamp", value: str = "value"
) -> DataFrame:
    """Epoch-aligned tumbling counts per status: window_start, window_end, status, cnt."""
    return (
        records.select(F.window(ts, size).alias("w"), payment_status(value).alias("status"))
        .groupBy("w", "status")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "status",
            "cnt",
        )
    )


def records_of_windows(records: DataFrame, size: str, start, end, ts: str = "timestamp") -> DataFrame:
    """Only the records whose windows of ``size`` can hold or begin at a time in [start, end].

    A range of the time column itself, so it reaches the scan: a window that
    concerns the range begins after ``start - size`` and ends by ``end + size``.
    """
    s, e = (F.lit(x).cast("timestamp_ntz") for x in (start, end))
    step = F.expr(f"INTERVAL {size}")
    return records.where((F.col(ts) > s - step) & (F.col(ts) < e + step))


def burn_rate_expr(ok: str, bad: str) -> Column:
    """bad*100 / (ok+bad) with integer division; 0 when there is no result."""
    return F.expr(
        f"CASE WHEN {ok} + {bad} = 0 THEN CAST(0 AS BIGINT) "
        f"ELSE CAST(({bad} * 100) DIV ({ok} + {bad}) AS BIGINT) END"
    )


def burn_rate(
    counts: DataFrame, ok: str = codes.PAYMENT_OK, bad: str = codes.PAYMENT_BAD
) -> DataFrame:
    """Burn rate per window from (window_start, window_end, status, cnt).

    Conditional sums pivot the two statuses in one aggregation; windows with
    neither status are kept with rate 0, like an empty store fetch.
    """
    agg = counts.groupBy("window_start", "window_end").agg(
        F.coalesce(F.sum(F.when(F.col("status") == ok, F.col("cnt"))), F.lit(0)).cast("bigint").alias("charged"),
        F.coalesce(F.sum(F.when(F.col("status") == bad, F.col("cnt"))), F.lit(0)).cast("bigint").alias("charge_failed"),
    )
    return agg.withColumn("burn_rate", burn_rate_expr("charged", "charge_failed"))


def burn_rate_windows(records: DataFrame, size: str = "1 hour", ts: str = "timestamp") -> DataFrame:
    """Windowed counts and burn rate in one aggregation over raw records."""
    return burn_rate(status_count_window(records, size, ts))


def burn_rate_at(counts: DataFrame, as_of) -> DataFrame:
    """Gauge value: burn rate of the window that contains ``as_of``."""
    t = F.lit(as_of).cast("timestamp_ntz") if not isinstance(as_of, Column) else as_of
    return burn_rate(counts.where((F.col("window_start") <= t) & (t < F.col("window_end"))))


def burn_rate_cumulative(failed: Column, started: Column) -> Column:
    """(failed / started) * 100 truncated to a long; NULL (unchanged) if none started."""
    return F.when(started > 0, (F.lit(100.0) * failed / started).cast("bigint"))


def query_window_store(counts: DataFrame, key: str, start, end) -> DataFrame:
    """Point fetch: windows of ``key`` whose start lies in [start, end]."""
    s = F.lit(start).cast("timestamp_ntz")
    e = F.lit(end).cast("timestamp_ntz")
    return counts.where((F.col("status") == key) & F.col("window_start").between(s, e))
