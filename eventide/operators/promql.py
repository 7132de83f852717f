"""Counter arithmetic over scraped samples ``(ts, <series labels>, value)``.

``counter_increase`` / ``counter_rate`` follow PromQL's range-vector
semantics without the boundary extrapolation: at each sample time ``t`` the
samples in ``(t - w, t]`` are taken, a drop in value is a counter reset (the
post-reset value counts as the increase), and the result is the sum of the
deltas after the first sample in the range; fewer than two samples give NULL.

A series is cut into time blocks of BLOCK windows.  A block also gets the
samples of the last window before it, as ghosts: the frame of any sample lies
within its block and the ghosts, and the only delta of a frame that would need
an earlier sample is the first one, which the increase leaves out.  So a
series with a third of all samples is many window groups, and a reset at the
end of a block is seen like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import epoch_micros


def _interval_us(window: str) -> int:
    n, unit = window.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(n) * mult * 1_000_000


#: windows in a block of a series; one more comes along as ghosts
BLOCK = 8


def counter_increase(
    samples: DataFrame, window: str, series: list[str], ts: str = "ts", value: str = "value"
) -> DataFrame:
    """``increase(c[window])`` evaluated at every sample: (ts, series..., increase)."""
    us = _interval_us(window)
    placed = _deltas(samples, us, series, ts, value)
    frame = Window.partitionBy(*series, "_block").orderBy("_us").rangeBetween(-(us - 1), 0)
    n = F.count(F.lit(1)).over(frame)
    inc = F.coalesce(F.sum("_delta").over(frame), F.lit(0.0)) - F.coalesce(F.first("_delta").over(frame), F.lit(0.0))
    found = placed.withColumn("increase", F.when(n >= 2, inc)).where(F.col("_block") == F.col("_own"))
    return found.select(ts, *series, "increase")


def _deltas(samples: DataFrame, us: int, series: list[str], ts: str, value: str) -> DataFrame:
    """The samples in their blocks (ghosts included) with what each adds to the counter.

    Right for every sample whose predecessor is within a window; any other is
    the first of each range that holds it, where its delta does not count."""
    placed = samples.withColumn("_us", epoch_micros(samples, ts))
    own = F.floor(F.col("_us") / F.lit(BLOCK * us)).cast("bigint")
    last = F.pmod(F.col("_us"), F.lit(BLOCK * us)) >= F.lit((BLOCK - 1) * us)
    placed = placed.withColumn("_own", own).withColumn("_block", F.explode(F.when(last, F.array(own, own + 1)).otherwise(F.array(own))))
    before = F.lag(value).over(Window.partitionBy(*series, "_block").orderBy("_us"))
    delta = F.when(F.col(value) < before, F.col(value)).otherwise(F.col(value) - before).cast("double")
    return placed.withColumn("_delta", delta)


def counter_rate_grid(
    samples: DataFrame, window: str, step: str, series: list[str], ts: str = "ts", value: str = "value"
) -> DataFrame:
    """``rate(c[window])`` evaluated at every whole ``step``, whenever the series were sampled.

    Series that are scraped at different times meet at the same evaluation
    times, so that rates can be added and divided.  A sample adds to the
    window / step evaluation times t whose range (t - window, t] holds it; a
    range with fewer than two samples gives no row."""
    us = _interval_us(window)
    own = _deltas(samples, us, series, ts, value).where(F.col("_block") == F.col("_own"))
    # tumbling ranges hold their begin, PromQL's hold their end
    held = own.withColumn("_w", F.window(F.col(ts) - F.expr("INTERVAL 1 MICROSECOND"), window, step))
    first = F.min_by(F.struct(F.coalesce("_delta", F.lit(0.0)).alias("d")), "_us")["d"]
    g = held.groupBy(*series, F.col("_w.end").alias(ts)).agg(
        F.count(F.lit(1)).alias("_n"), (F.coalesce(F.sum("_delta"), F.lit(0.0)) - first).alias("_inc")).where("_n >= 2")
    return g.select(ts, *series, (F.col("_inc") / F.lit(us / 1_000_000)).alias("rate"))


def counter_rate(
    samples: DataFrame, window: str, series: list[str], ts: str = "ts", value: str = "value"
) -> DataFrame:
    """``rate(c[window])``: increase per second of the window."""
    secs = _interval_us(window) / 1_000_000
    inc = counter_increase(samples, window, series, ts, value)
    return inc.select(ts, *series, (F.col("increase") / F.lit(float(secs))).alias("rate"))


def sum_by(df: DataFrame, value: str, by: list[str], ts: str = "ts") -> DataFrame:
    """``sum by (labels) (...)`` at each evaluation time."""
    return df.groupBy(ts, *by).agg(F.sum(value).alias(value))


def success_rate_of_rates(rates: DataFrame, ok: str, bad: str, by: list[str], ts: str = "ts", floor: float = 1e-9) -> DataFrame:
    """``100 * sum(rate(ok)) / clamp_min(sum(rate(ok) + rate(bad)), floor)`` at each evaluation time.

    ``rates``: (ts, metric, labels, rate).  As in PromQL, ``+`` adds only series
    whose labels (``by``) exist on both sides; without any, or without an
    ``ok`` series, there is no result at that time."""
    def of(metric: str):
        return F.max(F.when(F.col("metric") == metric, F.col("rate")))

    each = rates.where(F.col("metric").isin(ok, bad)).groupBy(ts, *by).agg(of(ok).alias("_ok"), of(bad).alias("_bad"))
    total = each.groupBy(ts).agg(F.sum("_ok").alias("_ok"), F.sum(F.col("_ok") + F.col("_bad")).alias("_both"))
    found = total.where(F.col("_ok").isNotNull() & F.col("_both").isNotNull())
    return found.select(ts, (F.lit(100.0) * F.col("_ok") / F.greatest(F.col("_both"), F.lit(floor))).alias("success_rate_pct"))


def latest_points(samples: DataFrame, series: list[str], n: int = 30, ts: str = "ts") -> DataFrame:
    """Keep the last ``n`` samples per series (the chart's rolling buffer).

    ``row_number() <= n`` is planned with a window group limit, so each task
    keeps at most ``n`` rows per series before the shuffle.
    """
    w = Window.partitionBy(*series).orderBy(F.col(ts).desc())
    return samples.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
