"""SLO summary: p95 latency, dead-letter count and 1 h burn rate in one row.

Each component is a one-row aggregate; a missing or empty component reads 0,
as the reference's API does when a metric query fails.  The three rows are
combined with ``unionByName`` + one aggregate (no join, no cross product).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def slo_summary(p95: DataFrame | None, dlt: DataFrame | None, burn: DataFrame | None) -> DataFrame:
    """Inputs: one-row frames with ``quantile`` / ``dlt_total`` / ``burn_rate``."""
    parts = []
    if p95 is not None:
        parts.append(p95.select(F.col("quantile").cast("double").alias("p95_latency_ms"),
                                F.lit(None).cast("bigint").alias("dlt_count"),
                                F.lit(None).cast("bigint").alias("slo_burn_rate_1h")))
    if dlt is not None:
        parts.append(dlt.select(F.lit(None).cast("double").alias("p95_latency_ms"),
                                F.col("dlt_total").cast("bigint").alias("dlt_count"),
                                F.lit(None).cast("bigint").alias("slo_burn_rate_1h")))
    if burn is not None:
        parts.append(burn.select(F.lit(None).cast("double").alias("p95_latency_ms"),
                                 F.lit(None).cast("bigint").alias("dlt_count"),
                                 F.col("burn_rate").cast("bigint").alias("slo_burn_rate_1h")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(
        F.coalesce(F.max("p95_latency_ms"), F.lit(0.0)).alias("p95_latency_ms"),
        F.coalesce(F.max("dlt_count"), F.lit(0)).cast("bigint").alias("dlt_count"),
        F.coalesce(F.max("slo_burn_rate_1h"), F.lit(0)).cast("bigint").alias("slo_burn_rate_1h"),
    )


def fault_impact(metric_by_period: DataFrame, baseline: str = "before") -> DataFrame:
    """Per period metrics with deltas against the baseline period.

    ``metric_by_period``: (period, metric, value), already aggregated (a few
    rows per metric).  The baseline is a window over each metric's rows, so
    the input is evaluated once (no self-join)."""
    from pyspark.sql import Window

    w = Window.partitionBy("metric")
    return metric_by_period.withColumn(
        "baseline", F.max(F.when(F.col("period") == baseline, F.col("value"))).over(w)).withColumn(
        "delta", F.round(F.col("value") - F.col("baseline"), 6))
