"""Aggregate metrics over event data: histograms, quantiles, ratios, counters.

The reference exports counters and timers to a metrics backend and queries
them with PromQL.  Here the same numbers are computed from the events with
Spark aggregates.  Everything is a single partial-aggregated ``groupBy``
(map-side combine, so a hot key is reduced before the shuffle); windows run
only on already aggregated rows (one per group x bucket or per series x
scrape), never on raw events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def default_bounds(lo_exp: int = 0, hi_exp: int = 4, steps=(1, 2, 5)) -> list[float]:
    """Histogram upper bounds ``s * 10^k`` for k in [lo_exp, hi_exp] (1-2-5 series)."""
    return [float(s * 10**k) for k in range(lo_exp, hi_exp + 1) for s in steps]


INF = float("inf")


def latency_histogram(
    df: DataFrame, value: str, by: list[str] | None = None, bounds: list[float] | None = None
) -> DataFrame:
    """Cumulative bucket counts ``(by..., le, cnt)`` with a final ``+Inf`` bucket.

    One aggregation pass: one conditional count per bound, so every bucket is
    present for every group and no join or cross product is needed; then the
    per-group array is unpivoted with ``inline``.
    """
    by = by or []
    bounds = sorted(bounds or default_bounds())
    v = F.col(value)
    aggs = [F.count_if(v <= F.lit(b)).alias(f"_b{i}") for i, b in enumerate(bounds)]
    aggs.append(F.count_if(v.isNotNull()).alias("_binf"))
    g = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    arr = F.array(
        *[F.struct(F.lit(b).cast("double").alias("le"), F.col(f"_b{i}").alias("cnt")) for i, b in enumerate(bounds)],
        F.struct(F.lit(INF).cast("double").alias("le"), F.col("_binf").alias("cnt")),
    )
    return g.select(*by, F.inline(arr))


def histogram_quantiles(buckets: DataFrame, quantiles: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """PromQL ``histogram_quantile`` over cumulative buckets ``(by..., le, cnt)``, one column per asked quantile.

    rank = q * count(+Inf); the first bucket whose cumulative count reaches
    the rank is interpolated linearly between its lower bound (previous ``le``,
    0 for the first bucket) and its ``le``.  A rank in the ``+Inf`` bucket
    returns the highest finite bound; an empty histogram gives NULL.
    Works on the aggregated buckets only (a few rows per group), all
    quantiles in one pass over them.
    """
    by = by or []
    # without groups the window spans one histogram: len(bounds) + 1 aggregated rows
    w = Window.partitionBy(*by).orderBy("le") if by else Window.orderBy("le")
    b = (
        buckets.withColumn("_prev_le", F.lag("le").over(w))
        .withColumn("_prev_cnt", F.coalesce(F.lag("cnt").over(w), F.lit(0)))
        .withColumn("_total", F.max(F.when(F.col("le") == F.lit(INF), F.col("cnt"))).over(
            Window.partitionBy(*by) if by else Window.partitionBy()))
        .where(F.col("_total") > 0)
    )
    lower = F.when(F.col("_prev_le").isNull() & (F.col("le") > 0), F.lit(0.0)).otherwise(F.col("_prev_le"))

    def first_hit(q: float) -> Column:
        rank = F.lit(float(q)) * F.col("_total")
        interp = lower + (F.col("le") - lower) * F.try_divide(rank - F.col("_prev_cnt"), F.col("cnt") - F.col("_prev_cnt"))
        val = F.when(F.col("le") == F.lit(INF), F.col("_prev_le")).when(
            F.col("_prev_le").isNull() & (F.col("le") <= 0), F.col("le")).otherwise(interp)
        return F.min_by(val, F.when(F.col("cnt") >= rank, F.col("le")))

    found = [first_hit(q).alias(name) for name, q in quantiles.items()]
    return b.groupBy(*by).agg(*found) if by else b.agg(*found)


def histogram_quantile(buckets: DataFrame, q: float, by: list[str] | None = None) -> DataFrame:
    """One quantile of ``histogram_quantiles``, as column ``quantile``."""
    return histogram_quantiles(buckets, {"quantile": q}, by)


def success_rate(df: DataFrame, ok: Column, bad: Column, ts: str, size: str = "1 day") -> DataFrame:
    """100 * succ / max(succ + fail, 1) per tumbling window."""
    g = df.groupBy(F.window(ts, size).alias("w")).agg(
        F.count_if(ok).alias("succeeded"), F.count_if(bad).alias("failed"))
    return g.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "succeeded", "failed",
        F.round(F.lit(100.0) * F.col("succeeded") / F.greatest(F.col("succeeded") + F.col("failed"), F.lit(1)), 6)
        .alias("success_rate_pct"),
    )


def trailing_success_rate(df: DataFrame, ok: Column, bad: Column, ts: str, hours: int = 24) -> DataFrame:
    """100 * succ / max(succ + fail, 1) over the ``hours`` up to the end of each hour that has rows.

    Counted per hour first (partial aggregate); the trailing sum runs over
    those hourly rows only."""
    g = df.groupBy(F.window(ts, "1 hour").alias("w")).agg(F.count_if(ok).alias("s"), F.count_if(bad).alias("f"))
    at = F.unix_seconds(F.col("w.end").cast("timestamp"))
    trail = Window.orderBy(at).rangeBetween(-(hours - 1) * 3600, 0)
    both = g.select(F.col("w.end").alias("eval_time"), F.sum("s").over(trail).alias("succeeded"), F.sum("f").over(trail).alias("failed"))
    rate = F.lit(100.0) * F.col("succeeded") / F.greatest(F.col("succeeded") + F.col("failed"), F.lit(1))
    return both.withColumn("success_rate_pct", F.round(rate, 6))


def channel_dlt_rate(records: DataFrame, channel: str, is_dead: Column) -> DataFrame:
    """Dead letters, messages and dead-letter share of each channel."""
    g = records.groupBy(channel).agg(F.count_if(is_dead).alias("dead"), F.count(F.lit(1)).alias("messages"))
    return g.withColumn("dlt_rate_pct", F.round(F.lit(100.0) * F.col("dead") / F.col("messages"), 6))


def availability(df: DataFrame, ok: Column, ts: str, size: str = "1 minute") -> DataFrame:
    """100 * successful / total per window."""
    g = df.groupBy(F.window(ts, size).alias("w")).agg(
        F.count_if(ok).alias("successful"), F.count(F.lit(1)).alias("total"))
    return g.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "successful", "total",
        F.round(F.lit(100.0) * F.col("successful") / F.col("total"), 6).alias("availability_pct"),
    )


def dlt_totals(records: DataFrame, is_dead: Column) -> DataFrame:
    """Dead letters, all messages and the dead-letter share (0 when none)."""
    return records.agg(
        F.coalesce(F.count_if(is_dead), F.lit(0)).alias("dlt_total"),
        F.count(F.lit(1)).alias("messages"),
    ).withColumn(
        "dlt_ratio_pct",
        F.when(F.col("messages") > 0, F.round(F.lit(100.0) * F.col("dlt_total") / F.col("messages"), 6))
        .otherwise(F.lit(0.0)),
    )


def message_counters(records: DataFrame, service: str, message_id: Column, failed: Column) -> DataFrame:
    """received / processed / duplicate / failed per service in one pass.

    processed = distinct message ids among parsable records, duplicate = the
    rest of the parsable ones.  ``count(DISTINCT)`` is planned as a two-level
    aggregation (expand + partial aggregates), so nothing is collected.
    """
    ok_id = F.when(~failed, message_id)
    g = records.groupBy(service).agg(
        F.count(F.lit(1)).alias("received"),
        F.count_distinct(ok_id).alias("processed"),
        F.count(ok_id).alias("_ok"),
        F.count_if(failed).alias("failed"),
    )
    return g.select(service, "received", "processed", (F.col("_ok") - F.col("processed")).alias("duplicate"),
                    "failed")


def consumer_counters(records: DataFrame, service: str, key: str, order: list[str], failed: Column, seen: DataFrame | None = None) -> DataFrame:
    """received / processed / duplicate / failed of each idempotent consumer.

    A consumer marks a record's key before it looks at the message: the first
    record of a key (by ``order``) that the store ``seen`` (``service``, ``key``)
    does not know is handled, and is processed or failed; every other record
    of the key is a duplicate, whether or not the first one failed.  Records
    without a key are each handled.

    One partial aggregate per (consumer, key), the store joined to its rows,
    then one per consumer: a key with a third of all records is combined where
    it is read.
    """
    bad = F.coalesce(failed, F.lit(False)).alias("_bad")
    rows = records.select(F.col(service).alias("service"), F.col(key).alias("_key"), bad, *[F.col(c).alias(f"_o{k}") for k, c in enumerate(order)])
    place = F.struct(*[F.col(f"_o{k}") for k in range(len(order))], F.col("_bad"))
    keyed = rows.where(F.col("_key").isNotNull()).groupBy("service", "_key").agg(F.count(F.lit(1)).alias("n"), F.min_by("_bad", place).alias("_bad"))
    if seen is not None:
        store = seen.select(F.col(service).alias("service"), F.col(key).alias("_key")).distinct().withColumn("_old", F.lit(True))
        keyed = keyed.join(store, ["service", "_key"], "left")
    else:
        keyed = keyed.withColumn("_old", F.lit(None).cast("boolean"))
    fresh = F.col("_old").isNull()
    keyed = keyed.select("service", "n", fresh.cast("long").alias("first"), (fresh & F.col("_bad")).cast("long").alias("bad"))
    keyless = rows.where(F.col("_key").isNull()).select("service", F.lit(1).cast("long").alias("n"), F.lit(1).cast("long").alias("first"), F.col("_bad").cast("long").alias("bad"))
    total = keyed.unionByName(keyless).groupBy("service").agg(F.sum("n").alias("received"), F.sum("first").alias("first"), F.sum("bad").alias("failed"))
    return total.select("service", "received", (F.col("first") - F.col("failed")).alias("processed"), (F.col("received") - F.col("first")).alias("duplicate"), "failed")


def consumer_lag(records: DataFrame, committed: DataFrame) -> DataFrame:
    """sum over partitions of max(end offset - committed, 0), by topic.

    ``committed``: (group_id, topic, partition, committed).  End offsets are one
    partial aggregate per (topic, partition).
    """
    ends = records.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))
    j = ends.join(committed, ["topic", "partition"])
    return j.groupBy("group_id", "topic").agg(
        F.sum(F.greatest(F.col("end_offset") - F.col("committed"), F.lit(0))).cast("bigint").alias("lag"))


def canary_comparison(df: DataFrame, channel: str, ts: str, ok: Column, size: str = "1 hour") -> DataFrame:
    """Per window and channel: requests, rate per second, failures, error rate and
    the channel's share of the window's traffic (window over aggregated rows)."""
    g = df.groupBy(F.window(ts, size).alias("w"), channel).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(~ok).alias("failures"))
    secs = F.col("w.end").cast("timestamp").cast("long") - F.col("w.start").cast("timestamp").cast("long")
    total = F.sum("requests").over(Window.partitionBy("w"))
    return g.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), channel,
        "requests", "failures",
        F.round(F.col("requests") / secs, 6).alias("rate_per_sec"),
        F.round(F.lit(100.0) * F.col("failures") / F.col("requests"), 6).alias("error_rate_pct"),
        F.round(F.lit(100.0) * F.col("requests") / total, 6).alias("share_pct"),
    )


def trailing_share(df: DataFrame, channel: str, ts: str, main: str = "main", canary: str = "canary", minutes: int = 5) -> DataFrame:
    """Rates of two channels and the canary's share over the ``minutes`` before each whole minute.

    Counted per minute and channel first; each of those few rows then adds to
    the ``minutes`` evaluation times whose range [t - minutes, t) holds it.  So
    there is no window over a channel's whole history.  Evaluation times whose
    range is empty give no row.
    """
    per_minute = df.groupBy(F.window(ts, "1 minute").alias("w"), F.col(channel).alias("c")).agg(F.count(F.lit(1)).alias("n"))
    times = F.array(*[F.col("w.start") + F.expr(f"INTERVAL {k} MINUTES") for k in range(1, minutes + 1)])
    spread = per_minute.select(F.explode(times).alias("eval_time"), "c", "n")

    def total(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("c") == name, F.col("n"))), F.lit(0))

    g = spread.groupBy("eval_time").agg(total(main).alias("main"), total(canary).alias("canary"))
    secs = F.lit(minutes * 60)
    return g.select("eval_time", "main", "canary", F.round(F.col("main") / secs, 6).alias("main_rate"), F.round(F.col("canary") / secs, 6).alias("canary_rate"),
                    F.round(F.try_divide(F.lit(100.0) * F.col("canary"), F.col("main") + F.col("canary")), 6).alias("canary_share_pct"))


def observe_counters(df: DataFrame, name: str, failed: Column) -> DataFrame:
    """Attach received/failed counters to a DataFrame (``DataFrame.observe``).

    The counts are computed as a side effect of whatever action runs on the
    result (no extra pass); read them from the returned ``Observation`` or,
    in streaming, from ``StreamingQueryProgress.observedMetrics``."""
    return df.observe(name, F.count(F.lit(1)).alias("received"), F.count_if(failed).alias("failed"))
